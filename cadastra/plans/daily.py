"""One operation date on top of the stored state, for incremental runs. Re-running a date replaces its rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators import billing, intervals, meters, payments, registry, service
from cadastra.plans import state
from cadastra.plans.replay import Events, all_rejects, billed_tables, charge_log, check_load, gate_days, paid_rows, payment_lines
from cadastra.rules import Rules
from cadastra.sources.catalog import Catalog
from cadastra.sources.commits import Conflict
from cadastra.sources.store import Store


def fee_closings(settled: DataFrame, water: DataFrame, cuts: DataFrame, fee: Column | None) -> DataFrame:
    """Active cuts that a payment of the batch closes: (property_id, cut_id, invoice_id of the payment, fee)."""
    active = cuts.select("property_id", F.col("invoice_id").alias("cut_id"))
    closing = service.closing_payments(settled, water).join(active, "property_id")
    if fee is None:
        closing, fee = closing.limit(0), F.lit(None)
    return closing.select(
        "property_id", "cut_id", F.col("fee_invoice_id").alias("invoice_id"), fee.cast("decimal(19,4)").alias("fee")
    )


def run_day(
    store: Store,
    events: Events,
    day: dt.date,
    catalog: Catalog,
    rules: Rules = Rules(),
    rejects: DataFrame | None = None,
    snapshot_every: int = 8,
) -> dict[str, DataFrame]:
    """Apply the events dated ``day`` and write the date's rows of every table.

    Reads only what was known before the date, so a date that failed half way is simply run again; payments of the desk
    stay. The date counts from its commit on, which fails with ``Conflict`` if anything was committed since the step began:
    then it is run again. Dates must come in order. It reads the last snapshot of the state and at most ``snapshot_every``
    dates after it, whatever the history, and writes the next snapshot when there are that many. ``rejects`` are what the load could not read; those of the date are written with it.
    """
    check_load(rejects, rules)
    begun = store.version()
    last = store.last_day()
    if last is not None and last > day:
        raise ValueError(f"{day} comes before the last complete date {last}")
    past = store.state(before=day)
    today = {kind: df.where(F.col("op_date") == F.lit(day)) for kind, df in events.items()}
    on = F.lit(day)
    written: dict[str, DataFrame] = {}

    def put(table: str, df: DataFrame) -> DataFrame:
        written[table] = store.write_day(table, day, df)
        return written[table]

    first = ["op_date", "position"]
    persons = past["person"].unionByName(
        put("person", registry.new_only(today["person"], past["person"], "document", first, registry.PERSON_COLUMNS))
    )
    added = put(
        "property",
        registry.new_only(today["property"], past["property"], "property_id", first, registry.PROPERTY_COLUMNS),
    )
    listed = past["property"].unionByName(added)

    # Movements: replay the touched pairs from their past, keep what happens today.
    moves = intervals.known_ownership(today["ownership"], listed, persons)
    pairs = moves.select("property_id", "document").distinct()
    past_moves = past["ownership_log"].join(pairs, ["property_id", "document"], "left_semi")
    steps = intervals.ownership_transitions(past_moves.unionByName(moves))
    put("ownership_log", steps.where(F.col("op_date") == on))

    automatic = registry.automatic_charges(added).withColumn("action", F.lit(intervals.OPEN))
    moves = intervals.known_charges(today["charge"], listed, catalog.charges).unionByName(automatic)
    pairs = moves.select("property_id", "charge_id").distinct()
    past_moves = past["charge_log"].join(pairs, ["property_id", "charge_id"], "left_semi")
    steps = charge_log(intervals.charge_intervals(past_moves.unionByName(moves)))
    charge_steps = past["charge_log"].unionByName(put("charge_log", steps.where(F.col("op_date") == on)))
    spans = intervals.charge_intervals(charge_steps)

    changes = billing.known_fiscal_changes(today["fiscal"], listed)
    fiscal = past["fiscal_log"].unionByName(put("fiscal_log", changes))

    put("reading", today["reading"])
    effects = meters.property_effects(today["reading"], listed)
    touched = past["balance_log"].join(effects.select("property_id"), "property_id", "left_semi")
    opening = state.latest(touched, "balance").withColumnRenamed("balance", "_opening")
    moved = effects.join(opening, "property_id", "left").select(
        "property_id",
        "op_date",
        (F.coalesce("base", "_opening", F.lit(0)) + F.col("delta")).cast("decimal(28,2)").alias("balance"),
    )
    balances = past["balance_log"].unionByName(put("balance_log", moved))

    # Payments: pending invoices of the paying properties, oldest first.
    paying = today["payment"].select("property_id").distinct()
    open_invoices = state.pending(past["invoice"], past["payment"]).join(paying, "property_id", "left_semi")
    settled, unmatched = payments.settle_batch(open_invoices, today["payment"], on, rules)
    water = service.water_intervals(listed, catalog.uses, spans, catalog.charges, rules).where(intervals.active_on(on))
    cuts = state.active_cuts(past["cut_open"], past["cut_close"])
    fee = catalog.reconnection_fee()
    closing = fee_closings(settled, water, cuts, fee)
    paid_today = put("payment", paid_rows(settled, closing))
    closed = put("cut_close", closing.select(on.alias("op_date"), "property_id", F.col("cut_id").alias("invoice_id")))
    paid = past["payment"].unionByName(paid_today)
    cuts = state.active_cuts(past["cut_open"], past["cut_close"].unionByName(closed))

    put("reconnection", service.reconnections_on(cuts, paid, past["reconnection"], on))

    gate = gate_days(store.spark.createDataFrame([(day,)], "op_date date"), today["property"], rules)
    late = state.pending(past["invoice"], paid)
    ordered = service.cut_orders_on(late, water, cuts, on, rules).join(gate.where("gate"), "op_date", "left_semi")
    put("cut_open", ordered)

    due = billing.properties_due(listed, on).select("property_id", on.alias("op_date"))
    mine = [df.join(due.select("property_id"), "property_id", "left_semi") for df in (fiscal, balances, past["invoice"])]
    facts = billing.billing_facts(due, listed, mine[0], mine[1])
    marks = state.latest(mine[2], "water_mark")
    invoice, lines = billed_tables(facts, spans, catalog.charges, rules, marks)
    put("invoice", invoice)
    put("invoice_line", lines.unionByName(payment_lines(paid_today, catalog.charges)))
    put(
        "reject",
        all_rejects(unmatched, today["payment"], None if rejects is None else rejects.where(F.col("op_date") == on)),
    )
    put("op_day", gate)
    store.complete_day(day, begun)
    since = store.days_since_snapshot()
    if since is None or since >= snapshot_every:
        write_snapshot(store)
    return written


def write_snapshot(store: Store) -> None:
    """Compact the state after the last complete date; if something else is committed meanwhile, a later date does it."""
    begun = store.version()
    try:
        store.write_snapshot(state.compacted(store.state()), begun)
    except Conflict:
        pass
