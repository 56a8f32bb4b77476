"""Registered queries: one callable per operator, over whole star-schema tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.functions import text
from cadastra.functions.money import days_late, late_interest
from cadastra.operators import arrears, billing, inquiry, meters, payments, registry, service
from cadastra.plans import state
from cadastra.plans.replay import gate_days, replay_tables
from cadastra.rules import Rules
from cadastra.session import work_dir, written
from cadastra.sources import operations
from cadastra.sources.catalog import SUBTYPES, split_subtypes
from cadastra.streaming.meters import MeterStream
from cadastra.suite.star import AS_OF, Star, fee

LATER_CUT_DATE = dt.date(1996, 6, 30)

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    REGISTERED[fn.__name__] = lambda spark, folder: fn(Star(spark, folder))
    return fn


def on_as_of():
    return F.lit(AS_OF)


# -- invoices as of a date --------------------------------------------------------------------


@query
def invoice_list_asof(s: Star) -> DataFrame:
    return inquiry.invoice_list(s.invoices, s.payments, s.water_now, s.active_cuts, on_as_of(), fee())


def headers(s: Star) -> DataFrame:
    return inquiry.invoice_headers(
        s.invoices, s.payments, s.properties, s.uses, s.zones, s.water_now, s.active_cuts, on_as_of(), fee()
    )


@query
def invoice_detail_header(s: Star) -> DataFrame:
    return headers(s)


def priced(s: Star) -> DataFrame:
    return arrears.simulated(s.invoices, s.water_now, s.active_cuts, on_as_of(), fee(), "detail")


@query
def invoice_detail_lines(s: Star) -> DataFrame:
    return inquiry.invoice_lines(s.lines, priced(s), s.charges)


@query
def line_totals(s: Star) -> DataFrame:
    return billing.line_totals(s.lines, "invoice_id")


@query
def late_interest_asof(s: Star) -> DataFrame:
    due = F.col("due_date")
    return s.invoices.select(
        "invoice_id",
        days_late(due, on_as_of()).alias("days_late"),
        late_interest(F.col("original_total"), due, on_as_of()).alias("interest"),
    )


REGISTERED["late_interest"] = REGISTERED.pop("late_interest_asof")


@query
def oldest_pending(s: Star) -> DataFrame:
    return arrears.oldest_pending(s.invoices, "due_date", "original_total")


@query
def pending_paid_summary(s: Star) -> DataFrame:
    return inquiry.account_summary(s.invoices)


@query
def payment_simulation(s: Star) -> DataFrame:
    return inquiry.payment_simulation(headers(s), s.invoices)


@query
def payment_reference(s: Star) -> DataFrame:
    oldest = arrears.oldest_pending(s.invoices)
    reference = text.payment_reference(F.col("property_id"), F.col("invoice_date"))
    return oldest.select("property_id", reference.alias("reference"))


@query
def last_overdue_flag(s: Star) -> DataFrame:
    return arrears.last_overdue(s.invoices.where("state = 1"), on_as_of()).select("invoice_id", "last_overdue")


@query
def must_have_water_flag(s: Star) -> DataFrame:
    water = s.water_now.withColumn("must_have_water", F.lit(True))
    return s.properties.join(water, "property_id", "left").select(
        "property_id", F.coalesce("must_have_water", F.lit(False)).alias("must_have_water")
    )


def simulated_fee(s: Star, mode: str) -> DataFrame:
    charged = arrears.with_fee(s.invoices, s.water_now, s.active_cuts, on_as_of(), fee(), mode)
    return charged.where(arrears.is_pending()).select("property_id", "invoice_id", "fee")


@query
def reconnection_fee_pay(s: Star) -> DataFrame:
    return simulated_fee(s, "pay")


@query
def reconnection_fee_list(s: Star) -> DataFrame:
    return simulated_fee(s, "list")


@query
def reconnection_fee_detail(s: Star) -> DataFrame:
    return simulated_fee(s, "detail")


# -- registration and intervals ---------------------------------------------------------------


@query
def auto_charges(s: Star) -> DataFrame:
    return registry.automatic_charges(s.properties)


@query
def new_only_insert(s: Star) -> DataFrame:
    incoming = s.read("orders").select(
        F.col("o_custkey").alias("property_id"), F.col("o_orderdate").cast("date").alias("op_date"),
        F.col("o_orderkey").alias("position"),
    )
    existing = s.properties.where("use_id <= 2").select("property_id")
    return registry.new_only(incoming, existing, "property_id", ["op_date", "position"], [])


@query
def ownership_intervals(s: Star) -> DataFrame:
    return s.ownership


@query
def charge_intervals(s: Star) -> DataFrame:
    return s.assignments


@query
def fiscal_asof(s: Star) -> DataFrame:
    days = s.invoices.select("property_id", F.col("invoice_date").alias("op_date")).distinct()
    values = billing.as_of(days, billing.known_fiscal_changes(s.fiscal_changes, s.properties))
    start = s.properties.select("property_id", "fiscal_value")
    return values.join(start, "property_id").select(
        "property_id", "op_date", F.coalesce("value", "fiscal_value").alias("fiscal")
    )


# -- billing ----------------------------------------------------------------------------------


@query
def billing_days(s: Star) -> DataFrame:
    return billing.billing_days(s.properties, s.op_dates)


def facts(s: Star) -> DataFrame:
    return billing.billing_facts(
        billing.billing_days(s.properties, s.op_dates),
        s.properties,
        billing.known_fiscal_changes(s.fiscal_changes, s.properties),
        meters.property_balances(s.readings, s.properties),
    )


def lines_of(s: Star, name: str) -> DataFrame:
    """Lines of one charge: only its calculator's inputs are computed."""
    only = s.charges.where(F.col("name") == name)
    chosen = s.assignments.join(only.select("charge_id"), "charge_id", "left_semi")
    days = facts(s)
    days = billing.consumption(days, s.assignments) if name == R.WATER else days.withColumn("consumption", F.lit(0))
    lines = billing.charge_lines(billing.priced_lines(days, chosen, only))
    return lines.select("property_id", "op_date", "amount", "description")


@query
def charge_water(s: Star) -> DataFrame:
    return lines_of(s, R.WATER)


@query
def charge_licence(s: Star) -> DataFrame:
    return lines_of(s, R.LICENCE)


@query
def charge_tax(s: Star) -> DataFrame:
    return lines_of(s, R.PROPERTY_TAX)


@query
def charge_garbage(s: Star) -> DataFrame:
    return lines_of(s, R.GARBAGE)


@query
def charge_parks(s: Star) -> DataFrame:
    return lines_of(s, R.PARKS)


@query
def invoice_totals(s: Star) -> DataFrame:
    metered = billing.consumption(facts(s), s.assignments)
    return billing.invoices(billing.priced_lines(metered, s.assignments, s.charges)).drop("water_mark")


@query
def meter_balance(s: Star) -> DataFrame:
    return meters.reading_balances(s.readings).select("meter_id", "op_date", "position", "balance")


@query
def consumption_per_invoice(s: Star) -> DataFrame:
    metered = billing.consumption(facts(s), s.assignments)
    return metered.where("water_mark IS NOT NULL").select("property_id", "op_date", "consumption")


# -- payments ---------------------------------------------------------------------------------


@query
def payment_dedupe(s: Star) -> DataFrame:
    return payments.valid_attempts(s.attempts)


@query
def payment_match_fifo(s: Star) -> DataFrame:
    return s.settled[0].where("paid_on IS NOT NULL").select(
        "property_id", "invoice_id", "paid_on", "method_id", "reference", "interest"
    )


@query
def payment_rejects(s: Star) -> DataFrame:
    return payments.payment_rejects(s.settled[1])


@query
def payment_batch_positional(s: Star) -> DataFrame:
    matched, _ = payments.positional_batch(
        s.invoices.where("state = 1"), payments.valid_attempts(s.attempts)
    )
    return matched.select("property_id", "op_date", "reference", "method_id", "invoice_id", "interest", "amount")


@query
def desk_settlement(s: Star) -> DataFrame:
    """Payments of the documents and of the desk, each in its turn, against the same invoices."""
    paid = s.desk_settled[0].where("paid_on IS NOT NULL")
    return paid.select("property_id", "invoice_id", "paid_on", "settled_on", "method_id", "reference", "batch", "interest")


@query
def desk_rejects(s: Star) -> DataFrame:
    return s.desk_settled[1]


@query
def desk_cuts(s: Star) -> DataFrame:
    """Cuts of the history with payments of the desk, which come after the cuts of the date the desk had seen."""
    cycle = service.service_cycle(s.desk_settled[0], s.water_history, s.gates, fee())
    return cycle.select("property_id", "invoice_id", "created_on", "closed_on", "fee_invoice_id", "closed_batch")


# -- water service ----------------------------------------------------------------------------


@query
def cut_orders_day(s: Star) -> DataFrame:
    return s.active_cuts


@query
def cut_orders_next(s: Star) -> DataFrame:
    """Cut orders of a later date, for properties without an active cut."""
    pending = s.invoices.where("state = 1")
    return service.cut_orders_on(pending, s.water_now, s.active_cuts, F.lit(LATER_CUT_DATE))


@query
def reconnections_day(s: Star) -> DataFrame:
    """Reconnection orders of a date: every third invoice is paid, every second cut has its order already."""
    cuts = s.active_cuts
    paid, ordered = s.invoices.where("invoice_id % 3 = 0"), cuts.where("invoice_id % 2 = 0")
    return service.reconnections_on(cuts, paid, ordered, F.lit(LATER_CUT_DATE))


@query
def cut_orders_bulk(s: Star) -> DataFrame:
    return s.cycle.select("property_id", "invoice_id", "created_on", "closed_on")


@query
def fees_bulk(s: Star) -> DataFrame:
    return service.fees(s.cycle)


@query
def reconnection_orders_bulk(s: Star) -> DataFrame:
    return service.reconnection_orders(s.cycle)


# -- inquiries --------------------------------------------------------------------------------

LISTED = ["property_id", "meter_id", "area_m2", "use_id", "zone_id", "fiscal_value", "registered_on", "owners"]


@query
def property_search_prefix(s: Star) -> DataFrame:
    return inquiry.search_by_prefix(s.properties, s.ownership, "1").select(*LISTED)


@query
def property_search_owner(s: Star) -> DataFrame:
    return inquiry.search_by_owner(s.properties, s.ownership, 3).select(*LISTED)


@query
def property_profile(s: Star) -> DataFrame:
    """The profile's three parts stacked: one row per property, open owner and linked charge."""
    parts = inquiry.property_profile(
        s.properties, s.uses, s.zones, s.ownership, s.persons.drop("op_date"), s.assignments, s.charges
    )
    head = parts["property"].select(
        "property_id", F.lit("property").alias("part"), F.concat_ws("/", "use_name", "zone_name").alias("item"),
        F.col("registered_on").alias("since"),
    )
    owners = parts["owners"].select(
        "property_id", F.lit("owner").alias("part"), F.col("name").alias("item"), F.col("start_date").alias("since")
    )
    linked = parts["charges"].select(
        "property_id", F.lit("charge").alias("part"), F.col("charge_name").alias("item"),
        F.col("from_date").alias("since"),
    )
    return head.unionByName(owners).unionByName(linked)


@query
def owner_list(s: Star) -> DataFrame:
    return inquiry.property_list(s.properties.select("property_id"), s.ownership)


@query
def owner_split(s: Star) -> DataFrame:
    owners = inquiry.property_list(s.properties.select("property_id"), s.ownership)
    split = owners.select("property_id", F.posexplode(text.split_owners(F.col("owners"))).alias("place", "owner"))
    return split


@query
def property_codes(s: Star) -> DataFrame:
    """Result code of an inquiry per event user: 0 when the property exists, else 3."""
    asked = s.read("events").select((F.col("user_id") * 13).alias("property_id")).distinct()
    return inquiry.lookup_codes(asked, s.properties, "property_id", R.PROPERTY_UNKNOWN)


@query
def search_route(s: Star) -> DataFrame:
    """How the search box would route every customer name, order priority style text and key."""
    asked = s.read("customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string"))
        .when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
        .otherwise(F.lit("  "))
        .alias("q"),
    )
    return asked.select(F.col("c_custkey").alias("request_id"), text.search_route(F.col("q")).alias("route"))


# -- catalog rules over table columns ---------------------------------------------------------


def raw_number() -> Column:
    """Catalog-like attribute text from the part table: empty, zero, malformed and valid values."""
    size = F.col("p_size") % 4
    return (
        F.when(size == 0, F.lit(""))
        .when(size == 1, F.lit("0"))
        .when(size == 2, F.col("p_brand"))
        .otherwise(F.col("p_retailprice").cast("decimal(10,2)").cast("string"))
    )


@query
def catalog_normalize(s: Star) -> DataFrame:
    value = text.number_or_null(raw_number(), "decimal(10,2)")
    return s.read("part").select(F.col("p_partkey").alias("item_id"), value.alias("value"))


@query
def param_default(s: Star) -> DataFrame:
    days = F.when(F.col("p_size") % 4 == 2, F.col("p_brand")).when(F.col("p_size") % 4 != 0, F.col("p_size").cast("string"))
    return s.read("part").select(F.col("p_partkey").alias("item_id"), text.int_or_default(days, 15).alias("due_days"))


@query
def charge_subtypes(s: Star) -> DataFrame:
    """The part table read as a wide charge table and split by subtype; columns a subtype lacks are null."""
    names = F.array(*[F.lit(n) for n in SUBTYPES])
    price, size = F.col("p_retailprice"), F.col("p_size")
    wide = s.read("part").select(
        F.col("p_partkey").alias("charge_id"),
        F.element_at(names, (size % 7 + 1).cast("int")).alias("name"),
        price.cast("decimal(19,4)").alias("min_amount"),
        size.alias("min_m3"),
        price.cast("decimal(19,4)").alias("per_m3"),
        size.cast("decimal(10,2)").alias("rate"),
        price.cast("decimal(19,4)").alias("fixed"),
        (size * 2).alias("min_m2"),
        (size * 3).alias("tranche_m2"),
    )
    stacked = None
    for name, part in split_subtypes(wide).items():
        part = part.withColumn("subtype", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


@query
def operation_gates(s: Star) -> DataFrame:
    """Per operation date, whether the cut gate is open: orders stand for listed properties, priority for the use."""
    use = F.substring("o_orderpriority", 1, 1).cast("int")
    listed = s.read("orders").select(F.col("o_orderdate").cast("date").alias("op_date"), use.alias("use_id"))
    return gate_days(s.op_dates, listed, Rules(gate_use_ids=(1,)))


@query
def duplicate_dates(s: Star) -> DataFrame:
    """Operation dates that the order table lists more than once."""
    return operations.duplicate_dates(s.read("orders").select(F.col("o_orderdate").cast("date").alias("op_date")))


@query
def invoice_codes(s: Star) -> DataFrame:
    asked = s.read("lineitem").select((F.col("l_orderkey") * 2).alias("invoice_id")).distinct()
    return inquiry.lookup_codes(asked, s.invoices, "invoice_id", R.INVOICE_UNKNOWN)


@query
def person_codes(s: Star) -> DataFrame:
    asked = s.read("events").select(F.col("user_id").alias("document")).distinct()
    return inquiry.lookup_codes(asked, s.persons, "document", R.PERSON_UNKNOWN)


# -- XML: every row written as a date element, parsed and shredded again ----------------------


def shredded(events: DataFrame, kind: str) -> DataFrame:
    documents = operations.parse_documents(operations.write_documents(events, kind), "document")
    return operations.shred(documents, kind).drop("position")


@query
def xml_roundtrip(s: Star) -> DataFrame:
    """Payments through XML."""
    return shredded(s.attempts, "payment")


@query
def xml_persons(s: Star) -> DataFrame:
    people = s.read("supplier").select(
        F.lit("2024-01-01").cast("date").alias("op_date"),
        F.col("s_suppkey").alias("document"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("a&b<"), F.col("s_suppkey"), F.lit('>"@x.cr')).alias("email"),
        F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("phone"),
    )
    return shredded(people, "person")


@query
def xml_properties(s: Star) -> DataFrame:
    return shredded(s.properties, "property")


@query
def xml_ownership(s: Star) -> DataFrame:
    return shredded(s.ownership_moves, "ownership")


@query
def xml_charges(s: Star) -> DataFrame:
    return shredded(s.charge_moves, "charge")


@query
def xml_fiscal(s: Star) -> DataFrame:
    return shredded(s.fiscal_changes, "fiscal")


@query
def xml_readings(s: Star) -> DataFrame:
    return shredded(s.readings, "reading")


#: Positions of the events that share an element.
BLOCK = 24_000


@query
def xml_positions(s: Star) -> DataFrame:
    """Readings in elements of several items: the position is the item's place in its element."""
    block = F.floor(F.col("position") / BLOCK)
    documents = operations.parse_documents(operations.write_documents(s.readings, "reading", block), "document")
    return operations.shred(documents, "reading")


def damaged_documents(s: Star) -> DataFrame:
    """Payments as documents, by line number: 1 not well-formed, 2 undated, 3 with an unreadable method, others sound."""
    texts = operations.write_documents(s.attempts, "payment")
    document, line = F.col("document"), F.regexp_extract("document", r'numeroReferencia="[0-9]+-([0-9]+)"', 1).cast("int")
    damaged = (
        F.when(line == 1, F.regexp_replace(document, 'numeroFinca="([^"]*)"', "numeroFinca=$1"))
        .when(line == 2, F.regexp_replace(document, 'fecha="[^"]*"', 'fecha="2025-13-05"'))
        .when(line == 3, F.regexp_replace(document, 'tipoMedioPagoId="[^"]*"', 'tipoMedioPagoId="cash"'))
        .otherwise(document)
    )
    return operations.parse_documents(texts.select(damaged.alias("document")), "document")


@query
def load_rejects(s: Star) -> DataFrame:
    """What a load rejects of documents of which a fixed share is damaged."""
    rejects = operations.load_rejects(damaged_documents(s))
    return rejects.groupBy("op_date", "step", "code", "reason").agg(F.count("*").alias("n"))


@query
def load_survivors(s: Star) -> DataFrame:
    """The payments of the same documents that reach the plans, unreadable attributes null."""
    return operations.shred(damaged_documents(s), "payment").drop("position")


# -- whole replay: generated invoices, payments against them, cuts on every operation date ----


def replayed(s: Star) -> dict[str, DataFrame]:
    events = {
        "person": s.persons.withColumn("position", F.col("document")).withColumns(
            {"email": F.lit(None).cast("string"), "phone": F.lit(None).cast("string")}
        ),
        "property": s.properties.withColumn("position", F.col("property_id")),
        "ownership": s.ownership_moves,
        "charge": s.charge_moves,
        "fiscal": s.fiscal_changes,
        "reading": s.readings,
        "payment": s.attempts,
    }
    # Invoices and their settlement feed several tables: written once instead of planned into each.
    keep = lambda name, df: written(df) if name == "invoice" else df
    return replay_tables(events, s.op_dates, s.catalog, Rules(cut_gate="always"), keep, written)


@query
def replay_invoices(s: Star) -> DataFrame:
    """Final state of every generated invoice."""
    t = replayed(s)
    return state.invoices(t["invoice"], t["payment"]).select(
        "property_id", "invoice_id", "invoice_date", "due_date", "original_total", "final_total", "state"
    )


@query
def replay_cut_orders(s: Star) -> DataFrame:
    t = replayed(s)
    return state.cut_orders(t["cut_open"], t["cut_close"])


@query
def replay_lines(s: Star) -> DataFrame:
    """Line count and sum per charge over all invoices, interest and fee lines included."""
    lines = replayed(s)["invoice_line"]
    return lines.groupBy("charge_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").cast("decimal(38,4)").alias("amount")
    )


@query
def property_balances(s: Star) -> DataFrame:
    return meters.property_balances(s.readings, s.properties)


# -- streaming --------------------------------------------------------------------------------


@query
def stream_meter_balance(s: Star) -> DataFrame:
    """Running balances computed by a stream over the event files (one micro-batch when there is one file)."""
    stream = MeterStream(s.spark, f"{work_dir(s.spark)}/meter-stream-{uuid.uuid4().hex}")
    # A pattern, since a stream takes a plain path for a folder: this one is a file or a folder of part files.
    s.events = s.spark.readStream.schema(s.read("events").schema).parquet(f"{s.folder}/{{events.parquet}}")
    stream.run(s.readings).awaitTermination()
    return stream.read("balance").select("meter_id", "op_date", "position", "balance")


@query
def stream_meter_batches(s: Star) -> DataFrame:
    """The same balances from micro-batches by date, so that each goes on from the state of those before it."""
    stream = MeterStream(s.spark, f"{work_dir(s.spark)}/meter-stream-{uuid.uuid4().hex}", compact=2)
    edges = [dt.date(1900, 1, 1), dt.date(1996, 7, 1), dt.date(1998, 1, 1), dt.date(1999, 7, 1), dt.date(2100, 1, 1)]
    for batch, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
        stream.apply(s.readings.where((F.col("op_date") >= F.lit(start)) & (F.col("op_date") < F.lit(end))), batch)
    return stream.read("balance").select("meter_id", "op_date", "position", "balance")
