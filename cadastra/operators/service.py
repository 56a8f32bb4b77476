"""Water service: who must have water, cut orders, reconnection fees and reconnection orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra import rules as R
from cadastra.functions.dates import next_date_lookup
from cadastra.functions.money import money
from cadastra.operators.intervals import active_on
from cadastra.operators.skew import spread_join
from cadastra.rules import Rules


def water_properties(properties: DataFrame, uses: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Property ids whose use, by name, obliges to water."""
    named = uses.where(F.col("name").isin(*rules.water_uses)).select(F.col("id").alias("use_id"))
    return properties.join(named, "use_id", "left_semi").select("property_id")


def water_intervals(
    properties: DataFrame, uses: DataFrame, intervals: DataFrame, charges: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """(property_id, from_date, to_date) in which the property must have water, one row per water charge.

    Intervals of several water charges may overlap; the rules below only ask whether some interval holds.
    """
    water = charges.where(F.col("name") == R.WATER).select("charge_id")
    return (
        intervals.where("to_date IS NULL OR to_date > from_date")
        .join(water, "charge_id", "left_semi")
        .join(water_properties(properties, uses, rules), "property_id", "left_semi")
        .select("property_id", "from_date", F.coalesce("to_date", F.lit("9999-12-31").cast("date")).alias("to_date"))
    )


def must_have_water(
    properties: DataFrame, uses: DataFrame, intervals: DataFrame, charges: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """Property ids that must have water now: obliging use and a water charge still active."""
    water = charges.where(F.col("name") == R.WATER).select("charge_id")
    active = intervals.where("to_date IS NULL").join(water, "charge_id", "left_semi")
    return water_properties(properties, uses, rules).join(active, "property_id", "left_semi")


def cut_orders_on(pending: DataFrame, water: DataFrame, active_cuts: DataFrame, on: Column, rules: Rules = Rules()) -> DataFrame:
    """Cut orders of one date: the oldest pending invoice past due plus grace, per property without an active cut.

    ``pending``: invoice_id, property_id, invoice_date, due_date. The date test leaves the column bare so it is
    pushed down to the scan.
    """
    late = pending.where(F.col("due_date") < F.date_sub(on, rules.grace_days))
    oldest = late.groupBy("property_id").agg(
        F.min_by("invoice_id", F.struct("invoice_date", "invoice_id")).alias("invoice_id")
    )
    return (
        oldest.join(water.select("property_id"), "property_id", "left_semi")
        .join(active_cuts.select("property_id"), "property_id", "left_anti")
        .select("property_id", "invoice_id", on.alias("op_date"))
    )


def reconnections_on(active_cuts: DataFrame, paid_invoices: DataFrame, reconnections: DataFrame, on: Column) -> DataFrame:
    """Reconnection orders of one date: active cuts whose invoice is paid and that have no order yet."""
    return (
        active_cuts.select("property_id", "invoice_id")
        .join(paid_invoices.select("invoice_id"), "invoice_id", "left_semi")
        .join(reconnections.select("property_id", "invoice_id"), ["property_id", "invoice_id"], "left_anti")
        .select("property_id", "invoice_id", on.alias("op_date"))
    )


def service_steps(
    settled: DataFrame, water: DataFrame, gates: DataFrame, rules: Rules = Rules(), hot: DataFrame | None = None
) -> DataFrame:
    """Dates on which a cut could open (phase 1) or a payment could carry the fee and close it (phase 0).

    * Open: per invoice and water interval, the first gate after due date plus grace, if the invoice is unpaid
      then. Later gates cannot add a cut: while the invoice is unpaid and overdue no fee can close one.
    * Close: a payment on a date with water that leaves no other pending invoice overdue. Due dates grow with the
      rank, so the next invoice decides.

    Per (property, date, phase) only the lowest rank matters: a cut names the oldest invoice, and later payments of
    the date find the cut already closed. One pass over ``settled``, pre-aggregated before the shuffle. ``hot`` are
    the hot properties (``hot_keys`` of the invoices); leave it out for generated invoices, of which a property has
    at most one per date.

    A payment of the desk (``batch`` and ``settled_on`` in ``settled``) comes after the cuts of the operation date the desk
    had seen and before anything of the next one: its steps are of phase 2 of that date.
    """
    if "batch" not in settled.columns:
        settled = settled.withColumn("batch", F.lit(None).cast("string")).withColumn("settled_on", F.col("paid_on"))
    at_desk = F.col("batch").isNotNull()
    calendar, earliest = next_date_lookup(gates, "op_date")
    ready = F.greatest(F.date_add("due_date", rules.grace_days), F.date_sub("from_date", 1), earliest)
    opens = (F.col("next_date") < F.col("to_date")) & (
        F.col("paid_on").isNull()
        | (F.col("settled_on") > F.col("next_date"))
        | (at_desk & (F.col("settled_on") == F.col("next_date")))
    )
    closes = active_on(F.col("settled_on")) & (F.col("next_due").isNull() | (F.col("next_due") >= F.col("paid_on")))
    step = F.array_compact(
        F.array(
            F.when(closes, F.struct(F.col("settled_on").alias("op_date"), F.when(at_desk, 2).otherwise(0).alias("phase"))),
            F.when(opens, F.struct(F.col("next_date").alias("op_date"), F.lit(1).alias("phase"))),
        )
    )
    needed = settled.select("property_id", "invoice_id", "rank", "due_date", "next_due", "paid_on", "settled_on", "batch")
    return (
        spread_join(needed, water, "property_id", "invoice_id", hot)
        .withColumn("day", ready)
        .join(calendar, "day", "left")
        .select("property_id", "invoice_id", "rank", "paid_on", "settled_on", "batch", F.explode(step).alias("_step"))
        .groupBy("property_id", "_step.op_date", "_step.phase")
        .agg(F.min(F.struct("rank", "invoice_id", "paid_on", "settled_on", "batch")).alias("_first"))
        .select("property_id", "op_date", "phase", "_first.*")
    )


def service_cycle(
    settled: DataFrame,
    water: DataFrame,
    gates: DataFrame,
    fee: Column | None,
    rules: Rules = Rules(),
    hot: DataFrame | None = None,
) -> DataFrame:
    """All cuts of the history: (property_id, invoice_id, created_on, closed_on, fee_invoice_id, fee, paid_on).

    A cut opens at the first open step while none is active and closes at the first close step after it. Without a
    fee (``None``) no cut is ever closed. Payments of a date come before its cuts. Also ``settled_on`` and ``batch`` of
    the payment of the cut's invoice, ``closed_after`` and ``closed_batch`` of the payment that closed it.
    """
    steps = service_steps(settled, water, gates, rules, hot)
    if fee is None:
        steps, fee = steps.where("phase = 1"), F.lit(None)
    order = Window.partitionBy("property_id").orderBy("op_date", "phase")
    effective = (
        steps.withColumn("_opens", F.col("phase") == 1)
        .withColumn("_previous", F.coalesce(F.lag("_opens").over(order), F.lit(False)))
        .where("_opens <> _previous")
        .withColumn("closed_on", F.lead("paid_on").over(order))
        .withColumn("closed_after", F.lead("op_date").over(order))
        .withColumn("closed_batch", F.lead("batch").over(order))
        .withColumn("fee_invoice_id", F.lead("invoice_id").over(order))
    )
    return effective.where("phase = 1").select(
        "property_id",
        "invoice_id",
        F.col("op_date").alias("created_on"),
        "closed_on",
        "fee_invoice_id",
        F.when(F.col("closed_on").isNotNull(), money(fee)).alias("fee"),
        "paid_on",
        "settled_on",
        "batch",
        "closed_after",
        "closed_batch",
    )


def closing_payments(settled: DataFrame, water: DataFrame) -> DataFrame:
    """Of a settled day batch, the first payment per property that could carry the fee, where water is due.

    (property_id, fee_invoice_id)
    """
    return (
        settled.where("closes")
        .join(water.select("property_id"), "property_id", "left_semi")
        .groupBy("property_id")
        .agg(F.min_by("invoice_id", "rank").alias("fee_invoice_id"))
    )


def fees(cycle: DataFrame) -> DataFrame:
    """Reconnection fees: (property_id, invoice_id, op_date, fee), one per closed cut."""
    return cycle.where("closed_on IS NOT NULL").select(
        "property_id", F.col("fee_invoice_id").alias("invoice_id"), F.col("closed_on").alias("op_date"), "fee"
    )


def reconnection_orders(cycle: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Reconnection orders: dated when the cut's invoice is paid, unless the cut was closed by then.

    An invoice paid at the desk is found paid on the next of the operation ``dates``.
    """
    if dates is None:
        found = cycle.withColumn("_turn", F.col("settled_on"))
    else:
        calendar, earliest = next_date_lookup(dates, "op_date")
        turn = F.when(F.col("batch").isNull(), F.col("settled_on")).otherwise(F.col("next_date"))
        found = cycle.withColumn("day", F.greatest("settled_on", earliest)).join(calendar, "day", "left").withColumn("_turn", turn)
    later = (F.col("closed_after") > F.col("_turn")) | ((F.col("closed_after") == F.col("_turn")) & F.col("closed_batch").isNotNull())
    return found.where(F.col("_turn").isNotNull() & (F.col("closed_after").isNull() | later)).select(
        "property_id", "invoice_id", F.col("_turn").alias("op_date")
    )
