"""Whole-history replay: every table of the store from the events of all dates, without a loop over days.

Order inside a day: registrations, movements and fiscal values, readings, payments, reconnections, cuts, invoices.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.functions.money import money, zero
from cadastra.operators import billing, intervals, meters, payments, registry, service
from cadastra.rules import Rules
from cadastra.sources.catalog import Catalog
from cadastra.session import placed_by_property, scope, written
from cadastra.sources.operations import all_events, dates_of, duplicate_dates, rejects_of, stored_rows
from cadastra.sources.store import Store

Events = Mapping[str, DataFrame]
Keep = Callable[[str, DataFrame], DataFrame]
Cut = Callable[[DataFrame], DataFrame]


def gate_days(dates: DataFrame, listed: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(op_date, gate): whether cuts run on the date.

    They do when the date lists a property of a gate use, new or not; or always, by rule.
    """
    if rules.cut_gate == "always":
        return dates.select("op_date", F.lit(True).alias("gate"))
    lists = listed.groupBy("op_date").agg((F.count_if(F.col("use_id").isin(*rules.gate_use_ids)) > 0).alias("gate"))
    return dates.select("op_date").join(lists, "op_date", "left").select(
        "op_date", F.coalesce("gate", F.lit(False)).alias("gate")
    )


def charge_log(spans: DataFrame) -> DataFrame:
    """Charge intervals as dated opens and closes."""
    steps = F.array(
        F.struct(F.col("from_date").alias("op_date"), F.lit(intervals.OPEN).alias("action")),
        F.struct(F.col("to_date").alias("op_date"), F.lit(intervals.CLOSE).alias("action")),
    )
    return (
        spans.select("property_id", "charge_id", F.explode(steps).alias("_step"))
        .select("property_id", "charge_id", "_step.*")
        .where("op_date IS NOT NULL")
    )


def paid_rows(settled: DataFrame, fees: DataFrame) -> DataFrame:
    """Payment rows: amount is original total plus interest plus fee. Those of the desk keep ``batch`` and ``seen``."""
    made = [F.col("batch"), F.col("settled_on").alias("seen")] if "batch" in settled.columns else []
    charged = fees.select("invoice_id", "fee")
    return (
        settled.where("paid_on IS NOT NULL")
        .join(charged, "invoice_id", "left")
        .withColumn("fee", F.coalesce("fee", zero()))
        .select(
            F.col("paid_on").alias("op_date"),
            "invoice_id",
            "property_id",
            "method_id",
            "reference",
            "interest",
            "fee",
            money(F.col("original_total") + F.col("interest") + F.col("fee")).alias("amount"),
            *made,
        )
    )


def payment_lines(paid: DataFrame, charges: DataFrame) -> DataFrame:
    """Interest and fee lines added by payments, each only when positive. Those of the desk keep ``batch`` and ``seen``."""
    made = [c for c in ("batch", "seen") if c in paid.columns]
    ids = charges.where(F.col("name").isin(R.LATE_INTEREST, R.RECONNECTION)).select("name", "charge_id")
    extras = F.array(
        F.struct(F.lit(R.LATE_INTEREST).alias("name"), F.col("interest").alias("amount"), F.lit(R.INTEREST_TEXT).alias("description")),
        F.struct(F.lit(R.RECONNECTION).alias("name"), F.col("fee").alias("amount"), F.lit(R.RECONNECTION_TEXT).alias("description")),
    )
    return (
        paid.select("op_date", "invoice_id", *made, F.explode(extras).alias("_extra"))
        .select("op_date", "invoice_id", *made, "_extra.*")
        .where("amount > 0")
        .join(ids, "name", "left")
        .select("op_date", "invoice_id", "charge_id", "amount", "description", *made)
    )


def billed_tables(
    facts: DataFrame, spans: DataFrame, charges: DataFrame, rules: Rules, marks: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(invoice, invoice_line) for the billing days in ``facts``.

    ``marks`` (property_id, water_mark) are consumption marks from before the first of these days.
    """
    metered = billing.consumption(facts, spans, rules, marks)
    priced = billing.priced_lines(metered, spans, charges, rules)
    key = billing.invoice_key(F.col("property_id"), F.col("op_date")).alias("invoice_id")
    lines = billing.charge_lines(priced).select("op_date", key, "charge_id", "amount", "description")
    return billing.invoices(priced, rules), lines


def replay_tables(
    events: Events,
    dates: DataFrame,
    catalog: Catalog,
    rules: Rules = Rules(),
    keep: Keep = lambda name, df: df,
    cut: Cut = lambda df: df,
    rejects: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables of the store. ``keep(name, df)`` may write a table and return it read back; ``cut`` may
    do the same for the two shared intermediate results (settled invoices and the cut cycle). ``rejects`` are what
    the load of the events could not read. ``events`` may have the desk's attempts as ``desk`` (``payments.DESK_ATTEMPT``);
    their results are tables of their own, ``desk/payment`` and so on, with ``batch`` and ``seen``."""
    t: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        t[name] = keep(name, df)
        return t[name]

    first = ["op_date", "position"]
    persons = put("person", registry.first_by_key(events["person"], "document", first, registry.PERSON_COLUMNS))
    listed = put(
        "property", registry.first_by_key(events["property"], "property_id", first, registry.PROPERTY_COLUMNS)
    )
    days = gate_days(dates, events["property"], rules)

    owned = intervals.known_ownership(events["ownership"], listed, persons)
    put("ownership_log", intervals.ownership_transitions(owned))

    moved = intervals.known_charges(events["charge"], listed, catalog.charges)
    automatic = registry.automatic_charges(listed).withColumn("action", F.lit(intervals.OPEN))
    log = put("charge_log", charge_log(intervals.charge_intervals(moved.unionByName(automatic))))
    spans = intervals.charge_intervals(log)

    fiscal = put("fiscal_log", billing.known_fiscal_changes(events["fiscal"], listed))
    put("reading", events["reading"])
    balances = put("balance_log", meters.property_balances(events["reading"], listed))

    billed = billing.billing_days(listed, dates)
    facts = billing.billing_facts(billed, listed, fiscal, balances)
    invoice, base_lines = billed_tables(facts, spans, catalog.charges, rules)
    with placed_by_property(invoice.sparkSession):
        invoice = put("invoice", invoice)

    # The date names an invoice inside its property and is shorter than the id, which is put on where rows are few.
    named = lambda date: billing.invoice_key(F.col("property_id"), F.col(date))
    issued = invoice.select(F.col("op_date").alias("invoice_date"), "property_id", "due_date", "original_total")
    settled, unmatched = payments.settle(issued, events["payment"], rules, events.get("desk"), daily=True)
    settled = cut(settled)
    water = service.water_intervals(listed, catalog.uses, spans, catalog.charges, rules)
    gates = days.where("gate").select("op_date")
    by_date = settled.withColumn("invoice_id", F.col("invoice_date"))
    cycle = service.service_cycle(by_date, water, gates, catalog.reconnection_fee(), rules)
    with placed_by_property(invoice.sparkSession):
        cycle = cut(cycle.withColumns({c: named(c) for c in ("invoice_id", "fee_invoice_id")}))
    put("cut_open", cycle.select(F.col("created_on").alias("op_date"), "property_id", "invoice_id"))
    closed = cycle.where("closed_on IS NOT NULL").select(
        F.col("closed_on").alias("op_date"), "property_id", "invoice_id", F.col("closed_batch").alias("batch"), F.col("closed_after").alias("seen")
    )
    paid = paid_rows(settled.withColumn("invoice_id", named("invoice_date")), service.fees(cycle))
    if "desk" in events:
        paid = cut(paid)
        put("reconnection", service.reconnection_orders(cycle, days))
        refused = payments.payment_rejects(unmatched, "batch", F.col("settled_on").alias("seen"))
        refused = refused.unionByName(payments.incomplete_attempts(events["desk"], "batch", "seen"))
        mine = {"payment": paid, "cut_close": closed, "invoice_line": payment_lines(paid, catalog.charges), "reject": refused}
        for name, rows in mine.items():
            put(f"desk/{name}", rows.where("batch IS NOT NULL"))
        paid, closed, unmatched = (df.where("batch IS NULL") for df in (paid, closed, unmatched))
    else:
        put("reconnection", service.reconnection_orders(cycle))
    put("cut_close", closed.drop("batch", "seen"))
    paid = put("payment", paid.drop("batch", "seen"))
    put("invoice_line", base_lines.unionByName(payment_lines(paid, catalog.charges)))
    put(
        "reject",
        all_rejects(unmatched, events["payment"], rejects),
    )
    put("op_day", days)
    return t


def all_rejects(unmatched: DataFrame, attempts: DataFrame, rejects: DataFrame | None) -> DataFrame:
    """Payments that found nothing pending, incomplete ones, and what the load could not read."""
    found = payments.payment_rejects(unmatched).unionByName(payments.incomplete_attempts(attempts))
    return found if rejects is None else found.unionByName(rejects)


def check_load(rejects: DataFrame | None, rules: Rules) -> None:
    """With a strict load, the first unreadable input stops it."""
    if rules.strict_load and rejects is not None and (first := rejects.first()) is not None:
        raise ValueError(f"unreadable input: {first['step']} {first['key']}: {first['reason']} (code {first['code']})")


def replay(
    store: Store,
    events: Events,
    dates: DataFrame,
    catalog: Catalog,
    rules: Rules = Rules(),
    rejects: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Replay into a new run of ``store``, which is published when all its tables are there.

    Each table is written once and read back by the steps after it; a replay that fails leaves the published run as it
    was. Attempts of the desk's batches take part, each after the operation date its desk had seen; a commit made while the
    replay runs, of the desk or another, makes it fail with ``Conflict`` instead of being lost. ``dates`` has one row per date element; a date that occurs twice stops the load. Undated rows are passed over.
    """
    check_load(rejects, rules)
    dates = dates.where("op_date IS NOT NULL")
    twice = duplicate_dates(dates).limit(10).collect()
    if twice:
        raise ValueError(f"operation dates listed more than once: {sorted(str(r['op_date']) for r in twice)}")
    run = store.new_run()
    desk = store.desk_attempts(run.based_on + 1)
    if desk is not None:
        events = {**events, "desk": desk}
    with scope(store.spark):
        tables = replay_tables(events, dates, catalog, rules, run.write_all, written, rejects)
        store.publish(run)
    return tables


def replay_documents(store: Store, documents: DataFrame, catalog: Catalog, rules: Rules = Rules()) -> dict[str, DataFrame]:
    """Replay operations documents, which are parsed once; what cannot be read goes to ``reject``, or stops the load by rule."""
    with scope(documents.sparkSession):
        rows = stored_rows(documents)
        return replay(store, all_events(rows), dates_of(rows), catalog, rules, rejects_of(rows))
