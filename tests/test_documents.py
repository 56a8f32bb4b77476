"""Catalog and operations documents, the streaming ingest and the billing desk on top of them."""

from __future__ import annotations

import datetime as dt
import pathlib
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cadastra.api import BillingDesk
from cadastra.operators import payments
from cadastra.plans.daily import run_day
from cadastra.plans.replay import replay, replay_documents
from cadastra.rules import Rules
from cadastra.schemas import LOGS
from cadastra.session import work_dir
from cadastra.sources import operations
from cadastra.sources.catalog import SUBTYPES, read_catalog, split_subtypes
from cadastra.sources.store import Store
from cadastra.streaming.days import apply_batch, ingest_days
from cadastra.streaming.meters import MeterStream
from tests.fixtures import CATALOG, catalog_document

FIRST_DAY = """<FechaOperacion fecha="2025-01-05">
<Personas><Persona valorDocumento="10000005" nombre="Ana" email="a@b.cr" telefono="1"/>
<Persona valorDocumento="10000006" nombre="Luis" email="" telefono="2"/></Personas>
<Propiedades><Propiedad numeroFinca="F-0001" numeroMedidor="M-1" metrosCuadrados="401.00" tipoUsoId="2" tipoZonaId="1" valorFiscal="12000000" fechaRegistro="2025-01-05"/>
<Propiedad numeroFinca="F-0002" numeroMedidor="M-2" metrosCuadrados="90" tipoUsoId="5" tipoZonaId="2" valorFiscal="6000000" fechaRegistro="2025-01-20"/></Propiedades>
<PropiedadPersona><Movimiento numeroFinca="F-0001" valorDocumento="10000005" tipoAsociacionId="1"/>
<Movimiento numeroFinca="F-0001" valorDocumento="99" tipoAsociacionId="1"/></PropiedadPersona>
<CCPropiedad><Movimiento numeroFinca="F-0001" idCC="2" tipoAsociacionId="1"/></CCPropiedad>
<LecturasMedidor><Lectura numeroMedidor="M-1" tipoMovimientoId="1" valor="45.00"/></LecturasMedidor>
</FechaOperacion>"""
CUT_DAY = """<FechaOperacion fecha="2025-02-10">
<Propiedades><Propiedad numeroFinca="F-0001" numeroMedidor="M-9" metrosCuadrados="1" tipoUsoId="3" tipoZonaId="1" valorFiscal="1" fechaRegistro="2025-02-10"/></Propiedades>
<PropiedadCambio><Cambio numeroFinca="F-0002" nuevoValor="bad"/></PropiedadCambio>
</FechaOperacion>"""
PAY_DAY = """<FechaOperacion fecha="2025-02-12">
<Pagos><Pago numeroFinca="F-0002" tipoMedioPagoId="1" numeroReferencia="R1"/></Pagos>
</FechaOperacion>"""


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "catalog.xml"
    path.write_text(CATALOG, encoding="utf-8")
    return read_catalog(spark, str(path))


def test_catalog(spark, catalog):
    charges = {r["name"]: r for r in catalog.charges.collect()}
    assert len(charges) == 7
    assert charges["ConsumoAgua"]["min_m3"] == 30 and charges["ConsumoAgua"]["fixed"] is None
    assert charges["ImpuestoPropiedad"]["rate"] == D("0.01")
    assert {r["id"]: r["name"] for r in catalog.uses.collect()}[4] == "Lote Baldío"
    assert {r["id"]: (r["days"], r["months"]) for r in catalog.periods.collect()}[6] == (30, 1)
    assert catalog.movement_types.count() == 3 and catalog.payment_methods.count() == 2
    assert catalog.zones.count() == 5 and catalog.amount_types.count() == 3
    assert catalog.rules(Rules(due_days=1)).due_days == 15
    assert catalog.reconnection_fee() is not None
    assert {n: df.count() for n, df in split_subtypes(catalog.charges).items()} == dict.fromkeys(SUBTYPES, 1)
    assert catalog.subtype("RecoleccionBasura").columns == ["charge_id", "min_amount", "fixed", "min_m2"]


def test_catalog_with_empty_zero_and_malformed_values(spark, tmp_path):
    bad = catalog_document(grace="x").replace('ValorPorcentual="0.04"', 'ValorPorcentual="abc"')
    bad = bad.replace('ValorFijo="30000"', 'ValorFijo="0"')
    (tmp_path / "c.xml").write_text(bad, encoding="utf-8")
    c = read_catalog(spark, str(tmp_path / "c.xml"))
    assert c.reconnection_fee() is None
    assert c.charges.where("name = 'InteresesMoratorios'").first()["rate"] is None
    assert c.rules().grace_days == 10


def test_operations_document(spark, tmp_path):
    (tmp_path / "o.xml").write_text(f"<Operaciones>{FIRST_DAY}{CUT_DAY}{PAY_DAY}</Operaciones>", encoding="utf-8")
    documents = operations.read_documents(spark, str(tmp_path / "o.xml"))
    events = operations.shred_all(documents)
    counts = {kind: df.count() for kind, df in events.items()}
    assert counts == {"person": 2, "property": 3, "ownership": 2, "charge": 1, "fiscal": 1, "reading": 1, "payment": 1}
    assert events["property"].where("property_id = 'F-0002'").first()["fiscal_value"] == D(6000000)
    assert operations.operation_dates(documents).count() == 3
    assert operations.duplicate_dates(documents.unionAll(documents).transform(operations.dated)).count() == 3
    bad = operations.load_rejects(documents).collect()
    assert [(r["step"], r["reason"]) for r in bad] == [("fiscal", "unreadable value")]


def test_stream_of_days_and_billing_desk(spark, catalog, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    store = Store(spark, str(tmp_path / "store")).create()

    def run():
        ingest_days(spark, str(feed), store, catalog, str(tmp_path / "checkpoint"), files_per_batch=1).awaitTermination()

    (feed / "1.xml").write_text(f"<Operaciones>{FIRST_DAY}</Operaciones>", encoding="utf-8")
    run()
    (feed / "2.xml").write_text(f"<Operaciones>{CUT_DAY}{PAY_DAY}</Operaciones>", encoding="utf-8")
    run()
    assert store.last_day() == dt.date(2025, 2, 12)
    assert store.read("cut_open").count() == 1
    # F-0002 had nothing pending, and its fiscal value was unreadable.
    assert {(r["step"], r["code"]) for r in store.read("reject").collect()} == {("payment", 50014), ("fiscal", 50002)}

    desk = BillingDesk(store, catalog)
    on = dt.date(2025, 2, 14)
    # 5000 + 15 m3 * 1000, licence, tax, garbage, parks
    base = D("20000") + D("25000") + D("10000") + D("450") + D("166.6667")
    interest = ((base * D("0.04") / 30).quantize(D("0.0000000001")) * 25).quantize(D("0.0001"))
    code, answer = desk.invoices("F-0001", on)
    [row] = answer["invoices"].collect()
    assert (code, row["invoice_id"], row["original_total"]) == (0, "F-0001-20250105", base)
    assert row["total"] == base + interest + 30000
    code, detail = desk.simulate_payment("F-0001", on)
    assert code == 0 and detail["header"].first()["computed_total"] == row["total"]
    assert [r["charge_name"] for r in detail["lines"].collect()] == sorted(
        ["ConsumoAgua", "PatenteComercial", "ImpuestoPropiedad", "RecoleccionBasura", "MantenimientoParques", "InteresesMoratorios", "ReconexionAgua"]
    )
    assert desk.simulate_payment("F-0002", on)[0] == 50014
    assert desk.invoices("nope", on)[0] == 3 and desk.profile("nope")[0] == 3
    assert desk.invoice_detail("nope", on)[0] == 40002
    assert [r["owners"] for r in desk.search("10000005")[1]["properties"].collect()] == ["10000005"]
    assert desk.search("555")[0] == 4 and desk.search("")[1]["properties"].count() == 2
    code, profile = desk.profile("F-0001")
    assert profile["property"].first()["use_name"] == "Comercial"
    assert profile["property"].first()["balance"] == D(45) and profile["property"].first()["water_mark"] == D(45)
    assert [r["charge_id"] for r in profile["charges"].collect()] == [1, 2, 3, 4, 5]
    assert [r["name"] for r in profile["owners"].collect()] == ["Ana"]
    summary = desk.summary("F-0001")[1]["summary"].first()
    assert (summary["pending"], summary["paid"], summary["next_reference"]) == (1, 0, "RCTP-202501-F-0001")

    tries = spark.createDataFrame([("F-0001", 2, "RCTP-1"), ("F-0001", 2, "RCTP-2")], "property_id string, method_id int, reference string")
    paid = desk.pay(tries, on)
    assert paid["invoices"].first()["amount"] == row["total"]
    assert paid["lines"].count() == 7 and paid["rejects"].count() == 1
    after = BillingDesk(store, catalog)
    # A repeated call pays nothing more and gives the same answer, also from a new desk.
    for again in (desk, after):
        repeat = again.pay(tries, on)
        assert [repeat[k].count() for k in ("invoices", "lines", "rejects")] == [1, 7, 1]
    assert store.read("payment").count() == 1
    # Running the date's step leaves the payment alone.
    run_day(store, operations.shred_all(parse(spark, PAY_DAY.replace("2025-02-12", "2025-02-14"))), on, catalog)
    assert store.read("payment").count() == 1 and store.read("cut_close").count() == 1
    [row] = after.invoices("F-0001", on)[1]["invoices"].collect()
    assert (row["state"], row["paid_on"], row["total"]) == (2, on, paid["invoices"].first()["amount"])
    assert after.active_cuts.isEmpty()
    assert after.simulate_payment("F-0001", on)[0] == 50014


def parse(spark, *texts):
    return operations.parse_documents(spark.createDataFrame([(t,) for t in texts], "d string"), "d")


def test_late_days_stop_the_batch(spark, catalog, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    apply_batch(store, parse(spark, PAY_DAY), catalog, Rules())
    apply_batch(store, parse(spark, PAY_DAY), catalog, Rules())  # a retried batch
    assert store.read("reject").count() == 1
    with pytest.raises(ValueError, match="comes before"):
        apply_batch(store, parse(spark, CUT_DAY), catalog, Rules())
    with pytest.raises(ValueError, match="more than once"):
        apply_batch(store, parse(spark, PAY_DAY, PAY_DAY), catalog, Rules())


UNDATED = PAY_DAY.replace("2025-02-12", "2025-13-05")
BROKEN = PAY_DAY.replace('numeroFinca="F-0002"', "numeroFinca=F-0002")
UNREADABLE = PAY_DAY.replace("2025-02-12", "2025-02-13").replace('PagoId="1"', 'PagoId="cash"')
LOST = {
    ("document", None, "unreadable element"),
    ("document", None, "element without a readable date"),
    ("payment", None, "in an element without a readable date"),
    ("payment", dt.date(2025, 2, 13), "unreadable method_id"),
    ("payment", dt.date(2025, 2, 13), "payment without property, date, method or reference"),
    ("payment", dt.date(2025, 2, 12), "nothing pending"),
}


def rejected(store):
    return sorted(((r["step"], r["op_date"], r["reason"]) for r in store.read("reject").collect()), key=repr)


@pytest.mark.parametrize("source", ["column", "file"])
def test_no_input_is_lost(spark, catalog, tmp_path, source):
    texts = [PAY_DAY, UNDATED, BROKEN, UNREADABLE]
    if source == "file":
        (tmp_path / "o.xml").write_text(f"<Operaciones>{''.join(texts[:2] + texts[3:])}</Operaciones>", encoding="utf-8")
        (tmp_path / "p.xml").write_text(f"<Operaciones>{BROKEN}</Operaciones>", encoding="utf-8")
        documents = operations.read_documents(spark, str(tmp_path / "*.xml"))
    else:
        documents = parse(spark, *texts)
    bulk = Store(spark, str(tmp_path / "bulk")).create()
    replay_documents(bulk, documents, catalog)
    assert rejected(bulk) == sorted(LOST, key=repr)
    days = Store(spark, str(tmp_path / "days")).create()
    for _ in range(2):  # a retried batch adds nothing
        apply_batch(days, documents, catalog, Rules())
        assert rejected(days) == sorted(LOST, key=repr)
    with pytest.raises(ValueError, match="unreadable input"):
        replay_documents(bulk, documents, catalog, Rules(strict_load=True))
    with pytest.raises(ValueError, match="unreadable input"):
        apply_batch(days, documents, catalog, Rules(strict_load=True))


def test_documents_are_parsed_once(spark, catalog, tmp_path):
    parsed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    texts = spark.createDataFrame([(t,) for t in (FIRST_DAY, CUT_DAY, PAY_DAY, UNREADABLE, BROKEN)], "d string")
    documents = operations.parse_documents(texts.mapInArrow(count, "d string"), "d")
    store = Store(spark, str(tmp_path / "store")).create()
    replay_documents(store, documents, catalog)
    assert parsed.value == 5
    assert store.read("person").count() == 2
    left = [p.name for p in pathlib.Path(work_dir(spark).removeprefix("file:")).glob("scope-*")]
    assert left == []


def test_rows_of_a_load_add_up(spark):
    """Every item is an event or, without a date, a reject; sections are read apart from each other."""
    documents = parse(spark, FIRST_DAY, CUT_DAY, PAY_DAY, UNDATED, UNREADABLE, BROKEN)
    rows = operations.stored_rows(documents)
    items = rows.where("kind <> 'document'").count()
    events = operations.all_events(rows)
    lost = operations.rejects_of(rows).where("op_date IS NULL AND step <> 'document'").count()
    assert items == sum(df.count() for df in events.values()) + lost
    assert (rows.where("kind = 'document'").count(), operations.dates_of(rows).count()) == (6, 4)
    for kind, df in events.items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, operations.shred(documents, kind).collect()))
    plan = events["payment"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    empty = operations.stored_rows(documents.limit(0))
    assert (operations.rejects_of(empty).count(), operations.dates_of(empty).count(), operations.events_of(empty, "charge").count()) == (0, 0, 0)


def test_attempts_are_paid_or_rejected(spark):
    d = [dt.date(2025, 1, i) for i in range(1, 6)]
    bills = [(f"i{k}", "F", d[0], d[4], D(5)) for k in range(2)]
    invoices = spark.createDataFrame(bills, "invoice_id string, property_id string, invoice_date date, due_date date, original_total decimal(19,4)")
    rows = [("F", d[1], 1, "a"), ("F", d[1], 1, "b"), ("F", d[2], 1, "c"), ("F", None, 1, "d"), (None, d[1], 1, "e"), ("F", d[1], None, "f"), ("F", d[1], 1, None), ("G", d[1], 1, "g")]
    tries = spark.createDataFrame(rows, "property_id string, op_date date, method_id int, reference string")
    settled, unmatched = payments.settle(invoices, tries)
    paid = settled.where("paid_on IS NOT NULL").count()
    assert paid + unmatched.count() + payments.incomplete_attempts(tries).count() == len(rows)


def test_failed_replay_leaves_the_published_run(spark, catalog, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    replay_documents(store, parse(spark, FIRST_DAY), catalog)
    before = {name: store.read(name).count() for name in LOGS}
    events = operations.shred_all(parse(spark, CUT_DAY))
    days = operations.dated(parse(spark, CUT_DAY, PAY_DAY)).select("op_date")
    attempts = operations.shred_all(parse(spark, PAY_DAY))["payment"].withColumn("method_id", F.expr("raise_error('lost')").cast("int"))
    with pytest.raises(Exception, match="lost"):
        replay(store, events | {"payment": attempts}, days, catalog)
    assert {name: Store(spark, store.path).read(name).count() for name in LOGS} == before


def test_unfinished_desk_batch_does_not_count(spark, catalog, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store")).create()
    replay_documents(store, parse(spark, FIRST_DAY, CUT_DAY), catalog)
    tries = spark.createDataFrame([("F-0001", 2, "R")], "property_id string, method_id int, reference string")
    with monkeypatch.context() as patch:
        patch.setattr(Store, "complete_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            BillingDesk(store, catalog).pay(tries, dt.date(2025, 2, 14))
    assert store.read("payment").count() == 0 and store.read("invoice_line").where("charge_id > 5").count() == 0
    BillingDesk(store, catalog).pay(tries, dt.date(2025, 2, 14))
    assert store.read("payment").count() == 1 and store.read("cut_close").count() == 1


@pytest.mark.parametrize("compact", [1, 2, 16])
def test_meter_stream(spark, tmp_path, compact):
    stream = MeterStream(spark, str(tmp_path / "meters"), compact)
    schema = "meter_id bigint, op_date date, position bigint, movement int, value decimal(10,2)"
    d = [dt.date(2025, 1, i) for i in range(1, 5)]
    stream.apply(spark.createDataFrame([(1, d[0], 0, 1, D(10)), (1, d[1], 1, 3, D(5)), (2, d[1], 2, 3, D(1))], schema), 0)
    second = spark.createDataFrame([(1, d[2], 3, 2, D(2)), (1, d[0], 4, 1, D(99)), (2, d[1], 5, 3, D(1)), (1, None, 6, 1, D(7))], schema)
    stream.apply(second, 1)
    stream.apply(second, 1)  # a retried batch
    got = {(r["meter_id"], r["position"]): r["balance"] for r in stream.read("balance").collect()}
    assert got == {(1, 0): 10, (1, 1): 15, (2, 2): 1, (1, 3): 13, (2, 5): 2}
    assert sorted(r["position"] for r in stream.read("late").collect()) == [4, 6]
    assert stream.read("closing").where(F.col("batch") == 1).count() == 2
    stream.apply(spark.createDataFrame([(1, d[3], 7, 3, D(1)), (2, d[3], 8, 2, D(1)), (3, d[3], 9, 1, D(4))], schema), 2)
    got = {r["position"]: r["balance"] for r in stream.read("balance").where("batch = 2").collect()}
    assert got == {7: 14, 8: 1, 9: 4}


def test_a_document_is_parsed_once_for_its_events(spark):
    payments = spark.range(50).select(
        F.lit("2025-01-01").cast("date").alias("op_date"),
        F.col("id").cast("string").alias("property_id"),
        F.lit(1).alias("method_id"),
        F.col("id").cast("string").alias("reference"),
    )
    parsed = operations.parse_documents(operations.write_documents(payments, "payment"), "document")
    events = operations.shred(parsed, "payment")
    assert events._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    assert events.count() == 50
