"""What replays leave on disk on the way."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadastra.operators import ledger, payments
from cadastra.session import written


def shuffle_files(spark) -> int:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.startswith("shuffle_") for folder in folders for _, _, files in os.walk(folder.getPath()) for f in files)


def test_a_written_step_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = written(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count())
    assert shuffle_files(spark) <= before
    assert rows.count() == 1000


def bills_and_tries(spark, seed):
    r, first = random.Random(seed), dt.date(2024, 1, 1)
    days = sorted({(p, first + dt.timedelta(r.randrange(60))) for p in "ABCDEFGH" for _ in range(25)})
    bills = [(f"{p}{d}", p, d, d + dt.timedelta(r.choice([3, 7])), 100 + k) for k, (p, d) in enumerate(days)]
    bills += [("x", None, first, first, 1), ("y", "A", None, first, 1)]
    tries = [
        (r.choice("ABCDEFGZ"), first + dt.timedelta(r.randrange(-3, 70)) if r.random() < 0.95 else None, r.choice([1, 2]), f"r{r.randrange(30)}")
        for _ in range(200)
    ]
    asked = [
        (r.choice("ABCDZ"), first + dt.timedelta(r.randrange(70)), 1, f"d{r.randrange(50)}", f"b{b}", b, first + dt.timedelta(r.randrange(60)))
        for b in range(3)
        for _ in range(40)
    ]
    attempt = "property_id string, op_date date, method_id int, reference string"
    invoices = spark.createDataFrame(bills, "invoice_id string, property_id string, invoice_date date, due_date date, total int")
    return (
        invoices.withColumn("original_total", F.col("total").cast("decimal(19,4)")).drop("total"),
        spark.createDataFrame(tries, attempt),
        spark.createDataFrame(asked, f"{attempt}, batch string, number int, seen date"),
    )


@pytest.mark.parametrize("seed, at_desk", [(1, False), (2, True), (3, True)])
def test_daily_invoices_are_settled_like_any(spark, monkeypatch, seed, at_desk):
    if seed == 3:
        monkeypatch.setattr(ledger, "WIDE_ROWS", 5)
        monkeypatch.setattr(ledger, "SHARES", 8)
    invoices, attempts, desk = bills_and_tries(spark, seed)
    desk = desk if at_desk else None
    for any_, daily in zip(payments.settle(invoices, attempts, desk=desk), payments.settle(invoices, attempts, desk=desk, daily=True)):
        assert daily.dtypes == any_.dtypes
        assert Counter(map(tuple, daily.collect())) == Counter(map(tuple, any_.collect()))
        assert daily.count() > 20


def test_daily_invoices_are_shuffled_once(spark):
    invoices, attempts, _ = bills_and_tries(spark, 1)
    settled, _ = payments.settle(written(invoices), written(attempts), daily=True)
    nodes = settled._sc._jvm.PythonSQLUtils.explainString(settled._jdf.queryExecution(), "formatted").split("\n\n")
    moved = [n for n in nodes if re.match(r"\s*\(\d+\) Exchange", n) and "original_total" in n]
    assert len(moved) == 1, moved
