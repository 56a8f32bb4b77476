"""Commits of the store: payments of the desk outlive every load, and of two writers one fails."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadastra.api import BillingDesk
from cadastra.operators import payments, service
from cadastra.plans.daily import run_day
from cadastra.plans.replay import replay
from cadastra.sources.catalog import read_catalog
from cadastra.sources.commits import CommitLog, Conflict
from cadastra.sources.store import Store
from tests.fixtures import CATALOG
from tests.histories import MONTH_ENDS, random_events
from tests.test_replay import COLUMNS, frames, rows

ASKED = "property_id string, method_id int, reference string"


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "catalog.xml"
    path.write_text(CATALOG, encoding="utf-8")
    return read_catalog(spark, str(path))


def state_of(store):
    return {name: rows(store.read(name), columns) for name, columns in COLUMNS.items()}


def test_one_of_two_commits_under_a_number_fails(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path / "log")), CommitLog(spark, str(tmp_path / "log"))
    assert one.entries() == []
    one.append({"action": "a"}, 0)
    with pytest.raises(Conflict):
        two.append({"action": "b"}, 0)
    two.append({"action": "c"}, 1)
    assert one.entries() == two.entries() == [{"action": "a"}, {"action": "c"}]
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if p.suffix == ".json") == [f"{k:020d}.json" for k in (0, 1)]


def test_of_two_publishers_one_fails(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s")).create()
    first, second = store.new_run(), Store(spark, store.path).new_run()
    store.publish(second)
    with pytest.raises(Conflict):
        Store(spark, store.path).publish(first)
    assert Store(spark, store.path).run == second.run


def test_payments_of_the_desk_outlive_a_replay(spark, catalog, tmp_path):
    """Days with desk payments between them, also dated ahead and back; then the same documents replayed as a whole."""
    dates = [*MONTH_ENDS[:3], dt.date(2024, 4, 20), MONTH_ENDS[-1]]
    ev, dates = random_events(n_properties=60, seed=5, dates=dates, pay=0.3)
    events, days = frames(spark, ev, dates)
    store, rnd = Store(spark, str(tmp_path / "days")).create(), random.Random(3)
    for k, day in enumerate(dates):
        run_day(store, events, day, catalog, snapshot_every=2)
        for turn in range(2 if k else 0):
            asked = [(f"F-{rnd.randrange(60):04d}", 1, f"D{rnd.randrange(3)}") for _ in range(25)] + [("F-none", 1, "D"), ("F-0001", None, "D")]
            on = day + dt.timedelta(days=rnd.choice([0, 0, 3, 45, -20]))
            BillingDesk(store, catalog).pay(spark.createDataFrame(asked, ASKED), on, f"{day}-{turn}")
    before = state_of(store)
    paid = store.desk_attempts()
    assert paid.count() > 100 and before["cut_close"] and before["reconnection"]
    late = store.read("payment").where("reference LIKE 'D%'").count()
    assert late > 40

    replay(store, events, days, catalog)
    assert state_of(store) == before
    # A payment after the replay goes on from there, and a replay keeps that as well.
    tries = spark.createDataFrame([(f"F-{k:04d}", 2, "after") for k in range(60)], ASKED)
    answer = BillingDesk(store, catalog).pay(tries, dates[-1])
    n = answer["invoices"].count()
    assert n > 0 and store.read("payment").count() == sum(before["payment"].values()) + n
    after = state_of(store)
    replay(store, events, days, catalog)
    assert state_of(store) == after
    assert store.read("payment").groupBy("invoice_id").count().where("count > 1").isEmpty()


def test_two_desks_do_not_pay_one_invoice_twice(spark, catalog, tmp_path):
    ev, dates = random_events(n_properties=5, seed=5, dates=MONTH_ENDS[:2], pay=0.0)
    events, days = frames(spark, ev, dates)
    store = Store(spark, str(tmp_path / "s")).create()
    replay(store, events, days, catalog)
    one, two = BillingDesk(store, catalog), BillingDesk(Store(spark, store.path), catalog)
    pending = one.invoice_state.where("property_id = 'F-0001'").count()
    ask = lambda reference: spark.createDataFrame([("F-0001", 1, reference)], ASKED)
    first, second = one.pay(ask("x"), dates[-1]), two.pay(ask("y"), dates[-1])
    paid = [r["invoices"].collect()[0]["invoice_id"] for r in (first, second)]
    assert pending >= 2 and len(set(paid)) == 2
    # A replay begun before a payment does not lose it: it fails and is run again.
    run = store.new_run()
    one.pay(ask("z"), dates[-1], "third")
    with pytest.raises(Conflict):
        store.publish(run)
    assert [r["reference"] for r in one.pay(ask("z"), dates[-1], "third")["invoices"].collect()] in (["z"], [])


def test_a_half_written_day_is_not_seen(spark, catalog, tmp_path, monkeypatch):
    ev, dates = random_events(n_properties=5, seed=5, dates=MONTH_ENDS[:3], pay=0.2)
    events, _ = frames(spark, ev, dates)
    store = Store(spark, str(tmp_path / "s")).create()
    run_day(store, events, dates[0], catalog)
    before = state_of(store)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "complete_day", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run_day(store, events, dates[1], catalog)
    assert state_of(store) == before and store.last_day() == dates[0]
    run_day(store, events, dates[1], catalog)
    assert store.last_day() == dates[1]


def test_desk_attempts_take_their_turn(spark):
    """Invoices of days 1, 3 and 5; documents pay on day 2 and 4, the desk after day 3 and, dated back, after day 5."""
    d = [dt.date(2025, 1, k) for k in range(1, 32)]
    bills = [(f"i{k}", "F", d[k], d[k + 10], 100) for k in (1, 3, 5)]
    invoices = spark.createDataFrame(bills, "invoice_id string, property_id string, invoice_date date, due_date date, original_total int")
    invoices = invoices.withColumn("original_total", invoices.original_total.cast("decimal(19,4)"))
    tries = spark.createDataFrame([("F", d[2], 1, "a"), ("F", d[4], 1, "b")], "property_id string, op_date date, method_id int, reference string")
    desk = [("F", d[20], 1, "x", "one", 7, d[3]), ("F", d[2], 1, "y", "two", 9, d[5]), ("F", d[2], 1, "y", "two", 9, d[5]), ("F", d[6], 1, "z", "two", 9, d[5])]
    asked = spark.createDataFrame(desk, "property_id string, op_date date, method_id int, reference string, batch string, number int, seen date")
    settled, refused = payments.settle(invoices, tries, desk=asked)
    got = {r["invoice_id"]: (r["paid_on"], r["reference"], r["batch"], r["settled_on"]) for r in settled.collect()}
    assert got == {"i1": (d[2], "a", None, d[2]), "i3": (d[20], "x", "one", d[3]), "i5": (d[2], "y", "two", d[5])}
    assert {(r["reference"], r["op_date"], r["batch"]) for r in refused.collect()} == {("b", d[4], None), ("z", d[6], "two")}
    gates = spark.createDataFrame([(x,) for x in d], "op_date date")
    water = spark.createDataFrame([("F", d[0], dt.date(9999, 1, 1))], "property_id string, from_date date, to_date date")
    cycle = service.service_cycle(settled, water, gates, None)
    assert service.reconnection_orders(cycle, gates).count() == 0


def test_a_day_reads_one_snapshot_and_the_dates_after_it(spark, catalog, tmp_path):
    ev, dates = random_events(n_properties=8, seed=9, dates=MONTH_ENDS[:4], pay=0.5)
    events, _ = frames(spark, ev, dates)
    store = Store(spark, str(tmp_path / "s")).create()
    for day in dates[:3]:
        run_day(store, events, day, catalog, snapshot_every=1)
    read = {r[0] for df in store.state(before=dates[3]).values() for r in df.select(F.input_file_name()).distinct().collect()}
    assert read and all("/snapshots/" in path for path in read)
    held = {name: df.count() for name, df in store.state().items()}
    whole = {name: store.read(name).count() for name in held}
    assert held["balance_log"] < whole["balance_log"] and held["invoice"] < whole["invoice"] and held["payment"] < whole["payment"]
    # A date that is run again overtakes its snapshot.
    snapshot = store._snapshot()
    assert snapshot[1] == dates[2]
    commits = store.version()
    run_day(store, events, dates[2], catalog, snapshot_every=99)
    assert store._snapshot()[1] == dates[1] and store.version() == commits + 1
