"""Billing days, as-of attributes, charge lines and invoice totals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra import rules as R
from cadastra.functions.dates import billing_day_keys, bills_on
from cadastra.functions.money import line_amount, line_text, zero
from cadastra.operators.intervals import active_on
from cadastra.operators.ledger import running
from cadastra.rules import Rules
from cadastra.schemas import MONEY
from cadastra.session import small

BILLED = [R.WATER, R.LICENCE, R.PROPERTY_TAX, R.GARBAGE, R.PARKS]


#: Billing days that one task makes, about.
TASK_DAYS = 500_000


def billing_days(properties: DataFrame, dates: DataFrame) -> DataFrame:
    """(property_id, op_date) for every operation date that bills the property.

    The dates are a small calendar keyed by the registration days they bill, so this is an equi-join that emits
    billing days only. A short row of a property becomes one for every month of the calendar, so properties are counted
    and dealt out by the days they make, not by their own size.
    """
    keys = small(billing_day_keys(dates.select("op_date").distinct()))
    listed = properties.select(
        "property_id",
        F.dayofmonth("registered_on").alias("day_key"),
        F.greatest("registered_on", F.col("op_date")).alias("_first"),
    )
    tasks = math.ceil(properties.count() * keys.count() / 31 / TASK_DAYS)
    if tasks > 1:
        listed = listed.repartition(tasks, "property_id")
    return listed.join(keys, "day_key").where("op_date >= _first").select("property_id", "op_date")


def properties_due(properties: DataFrame, on: Column) -> DataFrame:
    """Properties billed on one date."""
    return properties.where(bills_on(F.col("registered_on"), on) & (F.col("op_date") <= on))


def invoice_key(property_id: Column, on: Column) -> Column:
    """Deterministic invoice id: property and date, so a re-run yields the same invoice."""
    return F.concat(property_id.cast("string"), F.lit("-"), F.date_format(on, "yyyyMMdd"))


def last_fiscal_change(changes: DataFrame, order: str = "position") -> DataFrame:
    """Last change per (property, date); copies and same-day changes collapse in partial aggregation."""
    return (
        changes.where(F.col("value").isNotNull())
        .groupBy("property_id", "op_date")
        .agg(F.max_by("value", order).alias("value"))
    )


def known_fiscal_changes(changes: DataFrame, properties: DataFrame, order: str = "position") -> DataFrame:
    """Last change per (property, date) of properties listed on or before it; earlier ones change nothing."""
    listed = properties.select("property_id", F.col("op_date").alias("_listed"))
    return (
        last_fiscal_change(changes, order).join(listed, "property_id").where("op_date >= _listed").drop("_listed")
    )


def as_of(requests: DataFrame, changes: DataFrame, key: str = "property_id") -> DataFrame:
    """Add to every request row the latest value of each changed column on or before its date.

    ``requests`` and ``changes`` have one row per (key, op_date); ``changes`` has any other columns, null meaning
    unchanged. Same-day changes count. The window sees at most two rows per key and date.
    """
    values = [c for c in changes.columns if c not in (key, "op_date")]
    events = requests.withColumn("_phase", F.lit(1)).unionByName(
        changes.withColumn("_phase", F.lit(0)), allowMissingColumns=True
    )
    order = running([key], ["op_date", "_phase"])
    latest = {v: F.last(v, True).over(order) for v in values}
    return events.withColumns(latest).where("_phase = 1").drop("_phase")


def merge_changes(*changes: DataFrame, key: str = "property_id") -> DataFrame:
    """Bring several change tables to one row per (key, date) with all their value columns."""
    stacked = changes[0]
    for more in changes[1:]:
        stacked = stacked.unionByName(more, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in (key, "op_date")]
    return stacked.groupBy(key, "op_date").agg(*[F.max(v).alias(v) for v in values])


def billing_facts(
    days: DataFrame, properties: DataFrame, fiscal: DataFrame, balances: DataFrame
) -> DataFrame:
    """Billing days with the property's area and its fiscal value and meter balance as of the day.

    ``fiscal`` is (property_id, op_date, value), ``balances`` is (property_id, op_date, balance). The balance
    starts at 0, the fiscal value at the registered one.
    """
    changes = merge_changes(fiscal.select("property_id", "op_date", "value"), balances)
    start = properties.select("property_id", "area_m2", "fiscal_value")
    return (
        as_of(days.select("property_id", "op_date"), changes)
        .join(start, "property_id")
        .select(
            "property_id",
            "op_date",
            "area_m2",
            F.coalesce("value", "fiscal_value").alias("fiscal"),
            F.coalesce("balance", F.lit(0)).cast("decimal(28,2)").alias("balance"),
        )
    )


def consumption(
    facts: DataFrame, intervals: DataFrame, rules: Rules = Rules(), marks: DataFrame | None = None
) -> DataFrame:
    """Billing facts with ``consumption`` (balance minus the last consumption mark) and the new ``water_mark``.

    The mark is the balance at the latest earlier billing day on which the consumption charge was active, 0 at the
    start; ``water_mark`` is null on days that do not move it. ``marks`` (property_id, water_mark) holds marks from
    before the first day. Everything is keyed by property, so it reuses the placement of the facts.
    """
    span = intervals.where(F.col("charge_id") == rules.consumption_charge_id).select(
        "property_id", "from_date", "to_date"
    )
    moves = F.coalesce(active_on(F.col("op_date")), F.lit(False))
    days = facts.join(span, "property_id", "left").withColumn("water_mark", F.when(moves, F.col("balance")))
    start = F.lit(0)
    if marks is not None:
        earlier = marks.select("property_id", F.col("water_mark").alias("_start"))
        days, start = days.join(earlier, "property_id", "left"), F.coalesce("_start", F.lit(0))
    before = Window.partitionBy("property_id").orderBy("op_date").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.coalesce(F.last("water_mark", True).over(before), start)
    return days.withColumn("consumption", (F.col("balance") - previous).cast("decimal(28,2)")).select(
        *facts.columns, "consumption", "water_mark"
    )


def active_lines(facts: DataFrame, intervals: DataFrame) -> DataFrame:
    """Billing facts with the charges active on the day; a day without any stays, with a null charge.

    A property has one interval per catalogued charge.
    """
    spans = intervals.select(F.col("property_id").alias("_property"), "charge_id", "from_date", "to_date")
    same = (F.col("property_id") == F.col("_property")) & active_on(F.col("op_date"))
    return facts.join(spans, same, "left").drop("_property", "from_date", "to_date")


def price(lines: DataFrame, charges: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Price every active line in one pass over the charge catalog.

    ``lines`` needs charge_id, consumption, fiscal and area_m2. The amount is null for charges without a monthly
    calculator and for days without charges.
    """
    catalog = charges.select(
        "charge_id", "name", "min_amount", "min_m3", "per_m3", "rate", "fixed", "min_m2"
    ).where(F.col("name").isin(BILLED))
    columns = {c: F.col(c) for c in ("min_amount", "min_m3", "per_m3", "rate", "fixed", "min_m2")}
    name = F.col("name")
    return (
        lines.join(catalog, "charge_id", "left")
        .withColumn(
            "amount",
            line_amount(name, F.col("consumption"), F.col("fiscal"), F.col("area_m2"), columns, rules),
        )
        .withColumn("description", line_text(name, F.col("consumption")))
        .drop(*columns)
    )


def priced_lines(
    facts: DataFrame, intervals: DataFrame, charges: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """Facts (with consumption) priced per active charge, unbillable rows included."""
    return price(active_lines(facts, intervals), charges, rules)


def charge_lines(priced: DataFrame) -> DataFrame:
    """The invoice lines among priced rows."""
    return priced.where("amount IS NOT NULL").select("property_id", "op_date", "charge_id", "amount", "description")


def line_totals(lines: DataFrame, *keys: str) -> DataFrame:
    """Sum of line amounts per invoice."""
    return lines.groupBy(*keys).agg(F.sum("amount").cast(MONEY).alias("total"))


def invoices(priced: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Invoice headers with totals from priced rows; a billing day without lines stays at 0."""
    headed = priced.groupBy("property_id", "op_date").agg(
        F.sum("amount").cast(MONEY).alias("total"), F.max("water_mark").alias("water_mark")
    )
    return headed.select(
        "op_date",
        invoice_key(F.col("property_id"), F.col("op_date")).alias("invoice_id"),
        "property_id",
        F.date_add("op_date", rules.due_days).alias("due_date"),
        F.coalesce("total", zero()).alias("original_total"),
        "water_mark",
    )
