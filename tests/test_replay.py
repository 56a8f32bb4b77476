from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest

from cadastra import schemas
from cadastra.plans import state
from cadastra.plans.daily import run_day
from cadastra.plans.replay import replay, replay_tables
from cadastra.sources.catalog import read_catalog
from cadastra.sources.store import Store
from tests.fixtures import CATALOG
from tests.histories import MONTH_ENDS, random_events, simulate

COLUMNS = {
    "person": "op_date document name",
    "property": "op_date property_id meter_id",
    "ownership_log": "op_date property_id document action",
    "charge_log": "op_date property_id charge_id action",
    "invoice": "op_date invoice_id property_id due_date original_total water_mark",
    "invoice_line": "op_date invoice_id charge_id amount",
    "payment": "op_date invoice_id property_id method_id reference interest fee amount",
    "cut_open": "op_date property_id invoice_id",
    "cut_close": "op_date property_id invoice_id",
    "reconnection": "op_date property_id invoice_id",
    "reject": "op_date key",
    "op_day": "op_date gate",
}


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "catalog.xml"
    path.write_text(CATALOG, encoding="utf-8")
    return read_catalog(spark, str(path))


def frames(spark, ev, dates):
    events = {k: spark.createDataFrame(ev.get(k, []), s) for k, s in schemas.EVENTS.items()}
    return events, spark.createDataFrame([(d,) for d in dates], "op_date date")


def rows(df, columns):
    return Counter(tuple(r) for r in df.select(*columns.split()).collect())


def held(df):
    return df.persist()


@pytest.mark.parametrize("seed", [1, 2])
def test_bulk_equals_day_loop(spark, catalog, seed):
    ev, dates = random_events(n_properties=250, n_dates=220, span=330, seed=seed)
    events, days = frames(spark, ev, dates)
    tables = replay_tables(events, days, catalog, keep=lambda name, df: held(df), cut=held)
    expected = simulate(ev, dates)
    for name, columns in COLUMNS.items():
        want = Counter(expected[name])
        got = rows(tables[name], columns)
        assert got == want, (name, list((got - want).items())[:3], list((want - got).items())[:3])
    # The histories must exercise every branch.
    for name in ("cut_open", "cut_close", "reconnection", "reject", "payment"):
        assert len(expected[name]) > 10, name
    spark.catalog.clearCache()


def test_days_equal_bulk(spark, catalog, tmp_path):
    ev, dates = random_events(n_properties=150, seed=7, dates=MONTH_ENDS, pay=0.5)
    expected = simulate(ev, dates)
    assert all(len(expected[n]) > 2 for n in ("cut_open", "cut_close", "reconnection", "reject", "payment"))
    events, days = frames(spark, ev, dates)
    bulk = replay(Store(spark, str(tmp_path / "bulk")).create(), events, days, catalog)
    for name, columns in COLUMNS.items():
        assert rows(bulk[name], columns) == Counter(expected[name]), name
    store = Store(spark, str(tmp_path / "days")).create()
    for d in dates:
        run_day(store, events, d, catalog, snapshot_every=2)
    assert store.days_since_snapshot() == 0  # the last date's snapshot, after those of the first and third
    run_day(store, events, dates[-1], catalog)  # running a date again changes nothing, and reads the snapshot before it
    for name, columns in COLUMNS.items():
        assert rows(store.read(name), columns) == rows(bulk[name], columns), name
    assert store.last_day() == dates[-1]
    with pytest.raises(ValueError):
        run_day(store, events, dates[0], catalog)


def test_invariants(spark, catalog, tmp_path):
    ev, dates = random_events(n_properties=60, n_dates=30, span=150, seed=11)
    events, days = frames(spark, ev, dates)
    t = replay(Store(spark, str(tmp_path / "s")).create(), events, days, catalog)
    invoices = state.invoices(t["invoice"], t["payment"])
    line_sum = t["invoice_line"].groupBy("invoice_id").sum("amount").withColumnRenamed("sum(amount)", "s")
    assert invoices.join(line_sum, "invoice_id").where("final_total <> s").isEmpty()
    assert t["payment"].groupBy("invoice_id").count().where("count > 1").isEmpty()
    cuts = state.cut_orders(t["cut_open"], t["cut_close"])
    assert cuts.where("state = 1").groupBy("property_id").count().where("count > 1").isEmpty()
    owned = state.ownership(t["ownership_log"]).where("end_date IS NULL")
    assert owned.groupBy("property_id", "document").count().where("count > 1").isEmpty()
    tried = len({(r[0], *r[2:]) for r in ev["payment"] if None not in r})
    lost = sum(1 for r in ev["payment"] if None in r)
    assert t["payment"].count() + t["reject"].count() == tried + lost


def test_duplicate_dates_stop_the_load(spark, catalog, tmp_path):
    ev, dates = random_events(n_properties=2, n_dates=3, span=20, seed=1)
    events, days = frames(spark, ev, [*dates, dates[0]])
    with pytest.raises(ValueError, match=str(dates[0])):
        replay(Store(spark, str(tmp_path / "s")).create(), events, days, catalog)


def test_strict_payments_stop_the_load(spark, catalog, tmp_path):
    from cadastra.rules import Rules

    ev = {"payment": [(dt.date(2024, 1, 1), 0, "F-1", 1, "R")]}
    events, days = frames(spark, ev, [dt.date(2024, 1, 1)])
    with pytest.raises(ValueError, match="50014"):
        replay(Store(spark, str(tmp_path / "s")).create(), events, days, catalog, Rules(strict_payments=True))
