"""Cases worked by hand from the rules."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadastra.functions import dates, money, text
from cadastra.operators import arrears, billing, inquiry, intervals, ledger, meters, payments, registry, service
from cadastra.rules import Rules
from cadastra.session import written


def day(text_value: str) -> dt.date:
    return dt.date.fromisoformat(text_value)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def dec(value):
    return F.col(value).cast("decimal(28,2)")


def test_water(spark):
    df = spark.createDataFrame([("30.00",), ("30.50",), ("45.00",), ("0",), ("12.50",)], "c string")
    amount = money.water_amount(dec("c"), F.lit(D(5000)), F.lit(30), F.lit(D(1000)))
    assert [r[0] for r in values(df, amount)] == [5000, 5500, 20000, 5000, 5000]
    texts = values(df, money.line_text(F.lit("ConsumoAgua"), dec("c")))
    assert texts[4][0] == "ConsumoAgua (12.50 m3)"
    assert texts[0][0] == "ConsumoAgua (30.00 m3)"


def test_garbage(spark):
    df = spark.createDataFrame([("400",), ("401",), ("600",), ("601",)], "a string")
    amount = money.garbage_amount(F.col("a").cast("decimal(10,2)"), F.lit(D(150)), F.lit(400), F.lit(D(300)))
    assert [r[0] for r in values(df, amount)] == [150, 450, 450, 750]
    small_tranche = money.garbage_amount(
        F.col("a").cast("decimal(10,2)"), F.lit(D(150)), F.lit(400), F.lit(D(300)), Rules(garbage_tranche_m2=D(75))
    )
    assert [r[0] for r in values(df, small_tranche)] == [150, 450, 1050, 1050]


def test_fixed_share_charges(spark):
    charges = spark.createDataFrame(
        [(2, "PatenteComercial", D(150000), None), (3, "ImpuestoPropiedad", None, D("0.01")), (5, "MantenimientoParques", D(2000), None)],
        "charge_id int, name string, fixed decimal(19,4), rate decimal(10,2)",
    ).withColumns({c: F.lit(None).cast("decimal(19,4)") for c in ("min_amount", "min_m3", "per_m3", "min_m2")})
    lines = spark.createDataFrame([(c,) for c in (2, 3, 5)], "charge_id int").withColumns(
        {"consumption": F.lit(D(0)), "fiscal": F.lit(D(12000000)).cast("decimal(19,4)"), "area_m2": F.lit(D(100))}
    )
    got = dict(values(billing.price(lines, charges), "charge_id", "amount"))
    assert got == {2: D("25000.0000"), 3: D("10000.0000"), 5: D("166.6667")}


def test_billing_days_clamp_to_month_end(spark):
    df = spark.createDataFrame(
        [(day("2025-01-31"), day(d)) for d in ("2025-01-31", "2025-02-28", "2025-03-31", "2025-04-30", "2025-02-27", "2024-12-31")]
        + [(day("2024-01-31"), day("2024-02-29")), (day("2024-01-31"), day("2024-02-28"))],
        "reg date, d date",
    )
    hits = [r[0] for r in values(df, dates.bills_on(F.col("reg"), F.col("d")))]
    assert hits == [True, True, True, True, False, False, True, False]


def test_billing_days_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(billing, "TASK_DAYS", 1_000)
    day = dt.date(2024, 1, 15)
    properties = spark.range(300).select(F.col("id").alias("property_id"), F.lit(day).alias("registered_on"), F.lit(day).alias("op_date"))
    dates = spark.range(731).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("op_date"))
    made = billing.billing_days(properties.coalesce(1), dates).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 300 * 24
    assert max(r["count"] for r in made) < 300 * 24 / 3


def test_a_task_sorts_about_as_much_whatever_the_input(spark):
    rows = spark.range(16_000_000).select((F.col("id") % 500_000).alias("key"), F.xxhash64("id").alias("value"))
    last = F.row_number().over(Window.partitionBy("key").orderBy("value"))
    dealt = rows.withColumn("n", last).where("n > 0").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in dealt) == 16_000_000
    assert max(r["count"] for r in dealt) < 1_300_000


def test_billing_days_are_sorted_in_tasks_of_bounded_size(spark):
    day = dt.date(2015, 1, 1)
    properties = spark.range(120_000).select(F.col("id").alias("property_id"), F.lit(day).alias("registered_on"), F.lit(day).alias("op_date"))
    dates = spark.range(3_653).select(F.date_add(F.lit(day), F.col("id").cast("int")).alias("op_date"))
    values_known = properties.select("property_id", "op_date", F.lit(1).alias("value"))
    known = billing.as_of(billing.billing_days(properties, dates), values_known).where("value = 1")
    dealt = [r["count"] for r in known.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(dealt) == 120_000 * 120
    assert max(dealt) < 700_000


def test_a_task_reads_a_bounded_part_of_a_table(spark):
    rows = written(spark.range(8_000_000).select(F.xxhash64("id").alias("value")).repartition(4))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        read = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sum(read) == 8_000_000
    assert len(read) > 1


def test_bulk_billing_days_need_registration_and_listing(spark):
    properties = spark.createDataFrame(
        [("A", day("2025-01-31"), day("2025-01-10")), ("B", day("2025-01-31"), day("2025-03-01"))],
        "property_id string, registered_on date, op_date date",
    )
    days = spark.createDataFrame([(day(d),) for d in ("2025-01-31", "2025-02-28", "2025-03-31", "2025-04-01")], "op_date date")
    got = set(values(billing.billing_days(properties, days), "property_id", "op_date"))
    assert got == {("A", day("2025-01-31")), ("A", day("2025-02-28")), ("A", day("2025-03-31")), ("B", day("2025-03-31"))}


def test_late_interest_and_due_date(spark):
    df = spark.createDataFrame([(day("2025-06-23"),), (day("2025-06-16"),)], "paid date")
    due = F.date_add(F.lit(day("2025-06-01")), Rules().due_days)
    got = values(df, money.late_interest(F.lit(D(30000)), due, F.col("paid")), money.days_late(due, F.col("paid")))
    assert got == [(D("280.0000"), 7), (D("0.0000"), 0)]


def test_meter_balances(spark):
    moves = [(1, 10), (3, 5), (2, 2), (1, 20), (3, 1), (9, 7)]
    rows = [("M", day("2025-01-01") + dt.timedelta(days=i // 2), i, m, D(v)) for i, (m, v) in enumerate(moves)]
    df = spark.createDataFrame(rows, "meter_id string, op_date date, position int, movement int, value decimal(10,2)")
    got = [b for _, b in sorted(values(meters.reading_balances(df), "position", "balance"))]
    assert got == [10, 15, 13, 20, 21, 21]
    two = spark.createDataFrame(
        [("A", "M", day("2025-01-01")), ("B", "M", day("2025-01-03"))], "property_id string, meter_id string, op_date date"
    )
    last = meters.property_balances(df, two).groupBy("property_id").agg(F.max_by("balance", "op_date").alias("b"))
    assert dict(values(last, "property_id", "b")) == {"A": D(21), "B": D(1)}


@pytest.mark.parametrize("width", [1, 7, 65_536])
def test_a_hot_meter_day_is_summed_in_blocks(spark, monkeypatch, width):
    """A third of all readings on one meter and date, against a plain loop; no window holds more than a block."""
    monkeypatch.setattr(meters, "BLOCK", width)
    rng = random.Random(width)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        on = day("2025-01-02") if hot else day("2025-01-01") + dt.timedelta(days=rng.randrange(4))
        rows.append(("M" if hot else f"m{rng.randrange(5)}", on, i, rng.choice([1, 2, 3, 3, 2, 9]), D(rng.randrange(1000)) / 4))
    df = spark.createDataFrame(rows, "meter_id string, op_date date, position int, movement int, value decimal(10,2)")
    balances: dict[str, D] = {}
    expected, closing = {}, {}
    for meter, on, i, movement, value in sorted(rows, key=lambda r: (r[1], r[2])):
        before = balances.get(meter, D(0))
        balances[meter] = {1: value, 2: before - value, 3: before + value}.get(movement, before)
        expected[i] = closing[(meter, on)] = balances[meter]
    assert dict(values(meters.reading_balances(df), "position", "balance")) == expected
    one = spark.createDataFrame([(m, m, day("2025-01-01")) for m in balances], "property_id string, meter_id string, op_date date")
    found = {(m, on): b for m, on, b in values(meters.property_balances(df, one), "property_id", "op_date", "balance")}
    assert found == closing
    largest = meters._in_blocks(df, "meter_id").groupBy("meter_id", "op_date", "_block").count().agg(F.max("count")).first()[0]
    assert largest <= width


def test_calendar_with_a_stray_date(spark):
    dates_ = [day(d) for d in ("1995-12-30", "1995-12-31", "1996-01-05", "1999-03-01")]
    df = spark.createDataFrame([(d,) for d in [*dates_, dates_[0], None]], "d date")
    near = dates.next_date_lookup(df, "d")
    far = dates.next_date_lookup(df, "d", max_days=10)
    few = dates.next_date_lookup(df, "d", max_dates=2)
    expected = {(x, min(d for d in dates_ if d > x)) for x in (day("1995-12-29") + dt.timedelta(days=k) for k in range(1158))}
    for calendar, earliest in (near, far, few):
        assert set(values(calendar, "day", "next_date")) == expected
        assert spark.range(1).select(earliest).first()[0] == day("1995-12-29")


def test_many_hot_keys_are_joined_without_a_broadcast(spark, monkeypatch):
    from cadastra.operators import skew

    rows = spark.range(400).select((F.col("id") % 4).alias("k"), "id")
    attributes = spark.range(6).select(F.col("id").alias("k"), (F.col("id") * 10).alias("a"))
    expected = sorted(values(rows.join(attributes, "k"), "k", "id", "a"))
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    hot = skew.hot_keys(rows, "k", 30)
    assert sorted(values(skew.spread_join(rows, attributes, "k", "id", hot), "k", "id", "a")) == expected


def test_automatic_charges(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 4, 5), ("c", 5, 2)], "p string, u int, z int")
    got = {p: set(c) for p, c in values(df, "p", registry.automatic_charge_ids(F.col("u"), F.col("z")))}
    assert got == {"a": {1, 3, 4, 5}, "b": {3, 4, 5}, "c": {3}}


def test_charge_is_never_assigned_again(spark):
    rows = [("P", 1, day("2025-01-01"), 1), ("P", 1, day("2025-02-01"), 2), ("P", 1, day("2025-03-01"), 1), ("P", 2, day("2025-01-05"), 2)]
    df = spark.createDataFrame(rows, "property_id string, charge_id int, op_date date, action int")
    assert values(intervals.charge_intervals(df), "property_id", "charge_id", "from_date", "to_date") == [
        ("P", 1, day("2025-01-01"), day("2025-02-01"))
    ]


def test_ownership_intervals(spark):
    rows = [("P", "X", day(d), a) for d, a in (("2025-01-01", 1), ("2025-01-02", 1), ("2025-01-03", 2), ("2025-01-04", 1))]
    df = spark.createDataFrame(rows, "property_id string, document string, op_date date, action int")
    got = values(intervals.ownership_intervals(intervals.ownership_transitions(df)), "start_date", "end_date")
    assert sorted(got) == [(day("2025-01-01"), day("2025-01-03")), (day("2025-01-04"), None)]


def invoice_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "invoice_id string, property_id string, invoice_date date, due_date date, original_total decimal(19,4), "
        "final_total decimal(19,4), state int",
    )


def test_payment_order_and_rejects(spark):
    days = [day(f"2025-01-0{i}") for i in range(1, 5)]
    invoices = invoice_frame(spark, [(f"I{i}", "P", d, d + dt.timedelta(days=15), D(100), D(100), 1) for i, d in enumerate(days[:2], 1)])
    rows = [("P", d, 1, "R") for d in days] + [("P", days[2], 1, "R"), ("Q", days[3], 1, "R"), ("P", days[3], 1, None)]
    attempts = spark.createDataFrame(rows, "property_id string, op_date date, method_id int, reference string")
    settled, rejects = payments.settle(invoices, attempts)
    paid = values(settled.orderBy("invoice_id"), "invoice_id", "paid_on")
    assert paid == [("I1", days[1]), ("I2", days[2])]
    assert sorted(values(rejects, "property_id", "op_date")) == [("P", days[0]), ("P", days[3]), ("Q", days[3])]
    assert payments.incomplete_attempts(attempts).count() == 1


def test_cut_starts_the_day_after_grace(spark):
    due = day("2025-06-16")
    pending = invoice_frame(spark, [("I", "P", day("2025-06-01"), due, D(1), D(1), 1)])
    water = spark.createDataFrame([("P",)], "property_id string")
    none = water.limit(0)
    assert service.cut_orders_on(pending, water, none, F.lit(day("2025-06-26"))).count() == 0
    assert service.cut_orders_on(pending, water, none, F.lit(day("2025-06-27"))).count() == 1
    assert service.cut_orders_on(pending, water, water, F.lit(day("2025-06-27"))).count() == 0


def cycle(spark, invoice_dates, payment_dates, gate_dates):
    invoices = invoice_frame(spark, [(f"I{i}", "P", day(d), day(d) + dt.timedelta(days=15), D(100), D(100), 1) for i, d in enumerate(invoice_dates)])
    attempts = spark.createDataFrame([("P", day(d), 1, "R") for d in payment_dates], "property_id string, op_date date, method_id int, reference string")
    water = spark.createDataFrame([("P", day("2024-01-01"), day("9999-12-31"))], "property_id string, from_date date, to_date date")
    gates = spark.createDataFrame([(day(d),) for d in gate_dates], "op_date date")
    settled, _ = payments.settle(invoices, attempts)
    return service.service_cycle(settled, water, gates, F.lit(30000))


def test_fee_only_when_nothing_else_is_overdue(spark):
    c = cycle(spark, ["2025-01-01", "2025-02-01"], ["2025-03-10", "2025-03-11"], ["2025-03-01"])
    assert values(c, "invoice_id", "created_on", "closed_on", "fee_invoice_id") == [
        ("I0", day("2025-03-01"), day("2025-03-11"), "I1")
    ]
    # The cut's invoice was paid while the other was still overdue: one reconnection order, cut still active then.
    assert values(service.reconnection_orders(c), "invoice_id", "op_date") == [("I0", day("2025-03-10"))]


def test_no_reconnection_when_the_fee_was_charged(spark):
    c = cycle(spark, ["2025-01-01"], ["2025-03-10"], ["2025-03-01"])
    assert values(service.fees(c), "invoice_id", "op_date", "fee") == [("I0", day("2025-03-10"), D(30000))]
    assert service.reconnection_orders(c).count() == 0


@pytest.mark.parametrize("mode,expected", [("pay", {"I1"}), ("list", {"I1", "I2"}), ("detail", set())])
def test_fee_modes(spark, mode, expected):
    on = F.lit(day("2025-01-10"))
    rows = [("I1", "P", day("2025-01-01"), day("2025-01-16"), D(1), D(1), 1), ("I2", "P", day("2025-01-05"), day("2025-01-20"), D(1), D(1), 1)]
    one = spark.createDataFrame([("P",)], "property_id string")
    got = arrears.with_fee(invoice_frame(spark, rows), one, one, on, F.lit(30000), mode).where("fee > 0")
    assert {r[0] for r in values(got, "invoice_id")} == expected


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("",), ("0",), ("abc",), ("0.04",), (None,)], "v string")
    assert [r[0] for r in values(df, text.number_or_null(F.col("v"), "decimal(10,2)"))] == [None, None, None, D("0.04"), None]
    df = spark.createDataFrame([(None,), ("x",), ("20",)], "v string")
    assert [r[0] for r in values(df, text.int_or_default(F.col("v"), 15))] == [15, 15, 20]


def test_search_and_owner_lists(spark):
    properties = spark.createDataFrame([("F-01",), ("F-02",), ("G-01",)], "property_id string")
    own = spark.createDataFrame(
        [("F-01", "123", None), ("F-01", "9" * 25, None), ("F-02", "123", day("2025-01-01"))],
        "property_id string, document string, end_date date",
    )
    persons = spark.createDataFrame([("123",), ("7",)], "document string")
    ids = lambda q: sorted(values(inquiry.search(properties, own, persons, q)[1], "property_id", "owners"))
    both = ("F-01", "123, " + "9" * 20)
    assert ids("") == [both, ("F-02", None), ("G-01", None)]
    assert ids("F-0") == [both, ("F-02", None)]
    assert ids(" 123 ") == [both]
    assert inquiry.search(properties, own, persons, "555")[0] == 4
    routes = spark.createDataFrame([("",), ("123",), ("F-0",), (None,)], "q string")
    assert [r[0] for r in values(routes, text.search_route(F.col("q")))] == ["all", "document", "prefix", "all"]
    split = spark.createDataFrame([("a, b",), (None,)], "o string")
    assert [r[0] for r in values(split, text.split_owners(F.col("o")))] == [["a", "b"], []]
    ref = split.select(text.payment_reference(F.lit("F-0012"), F.lit(day("2025-06-01")))).first()[0]
    assert ref == "RCTP-202506-F-0012"


def test_hot_keys_are_split_without_changing_results(spark):
    from cadastra.operators.skew import hot_keys, spread_join

    rows = spark.range(1000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"), "id")
    attributes = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    hot = hot_keys(rows, "k", 50)
    assert values(hot, "k", "_parts") == [(7, 7)]
    for how in ("inner", "left"):
        got = sorted(values(spread_join(rows, attributes, "k", "id", hot, how), "k", "id", "a"), key=str)
        assert got == sorted(values(rows.join(attributes, "k", how), "k", "id", "a"), key=str)


def test_cut_cycle_is_the_same_for_hot_properties(spark):
    from cadastra.operators.skew import hot_keys

    first = day("2025-01-01")
    rows = [(f"I{i:03d}", "P" if i % 3 else f"Q{i}", first + dt.timedelta(days=i), first + dt.timedelta(days=i + 15), D(10), D(10), 1) for i in range(60)]
    invoices = invoice_frame(spark, rows)
    tries = [("P", first + dt.timedelta(days=40 + 2 * i), 1, "R") for i in range(50)]
    attempts = spark.createDataFrame(tries, "property_id string, op_date date, method_id int, reference string")
    water = invoices.select("property_id", F.lit(first).alias("from_date"), F.lit("9999-12-31").cast("date").alias("to_date")).distinct()
    gates = spark.createDataFrame([(first + dt.timedelta(days=7 * i),) for i in range(40)], "op_date date")
    settled, _ = payments.settle(invoices, attempts)
    plain = service.service_cycle(settled, water, gates, F.lit(30000))
    hot = service.service_cycle(settled, water, gates, F.lit(30000), hot=hot_keys(invoices, "property_id", 5))
    assert plain.count() > 20
    assert sorted(map(str, plain.collect())) == sorted(map(str, hot.select(*plain.columns).collect()))


def wide_day(spark, rows: int):
    """Two thirds of all attempts on one property and date, the references of all sizes; the rest on other dates."""
    found = spark.range(rows).select(
        F.when(F.col("id") % 3 < 2, "P").otherwise(F.concat(F.lit("Q"), F.col("id") % 50)).alias("property_id"),
        F.when(F.col("id") % 3 < 2, F.lit(day("2025-01-03"))).otherwise(F.date_add(F.lit(day("2025-01-01")), (F.col("id") % 7).cast("int"))).alias("op_date"),
        (1 + F.col("id") % 2).cast("int").alias("method_id"),
        F.concat(F.lit("ref-"), F.conv(F.xxhash64("id").cast("string"), 10, 36)).alias("reference"),
    )
    return payments.valid_attempts(found)


def test_a_wide_group_is_cut_into_even_blocks_of_its_order(spark):
    keys, order = ["property_id", "op_date"], ["reference", "method_id"]
    tries = wide_day(spark, 30_000)
    got = ledger.in_blocks(tries, keys, order, "block", wide_rows=500, shares=64).toPandas()
    assert len(got) == tries.count()
    wide = got[got.property_id == "P"].sort_values(order)
    assert wide.block.is_monotonic_increasing and wide.block.nunique() == wide.block.max() + 1
    assert 20 < wide.block.nunique() < 70 and wide.block.value_counts().max() < 2_000
    assert set(got[got.property_id != "P"].block) == {0}
    assert set(ledger.in_blocks(tries, keys, order, "block").select("block").distinct().toPandas().block) == {0}


@pytest.mark.parametrize("blocks", [(1_000_000, 1024), (300, 64)])
def test_attempts_of_a_wide_day_are_paid_in_order(spark, monkeypatch, blocks):
    """With and without blocks: the k-th attempt pays the k-th invoice, and the rest is rejected."""
    monkeypatch.setattr(ledger, "WIDE_ROWS", blocks[0])
    monkeypatch.setattr(ledger, "SHARES", blocks[1])
    tries = wide_day(spark, 9_000)
    start = day("2020-01-01")
    bills = spark.range(2_500).select(
        F.format_string("I%05d", "id").alias("invoice_id"),
        F.lit("P").alias("property_id"),
        F.date_add(F.lit(start), (F.col("id") % 2_000).cast("int")).alias("invoice_date"),
        F.date_add(F.lit(start), (F.col("id") % 2_000 + 15).cast("int")).alias("due_date"),
        F.lit(D(100)).cast("decimal(19,4)").alias("original_total"),
        F.lit(D(100)).cast("decimal(19,4)").alias("final_total"),
        F.lit(1).alias("state"),
    )
    mine = tries.where("property_id = 'P'").toPandas().sort_values(["reference", "method_id"])
    oldest = bills.toPandas().sort_values(["invoice_date", "invoice_id"]).invoice_id.tolist()
    open_then = [i for i in oldest if (int(i[1:]) % 2_000) < (day("2025-01-03") - start).days]
    expected = dict(zip(open_then, mine.reference))
    settled, rejects = payments.settle(bills, tries)
    assert dict(values(settled.where("paid_on IS NOT NULL"), "invoice_id", "reference")) == expected
    refused = {r for (r,) in values(rejects.where("property_id = 'P'"), "reference")}
    assert refused == set(mine.reference[len(expected):]) and rejects.count() == tries.count() - len(expected)
    matched, unmatched = payments.positional_batch(bills, tries)
    assert dict(values(matched, "invoice_id", "reference")) == dict(zip(oldest, mine.reference))
    assert matched.count() + unmatched.count() == tries.count()
