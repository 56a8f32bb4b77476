from __future__ import annotations

import random
import re
from collections import Counter
from math import comb

import duckdb
import pytest
from pyspark.sql import functions as F

from cadastra.llm import quality_rules as rules
from cadastra.llm import sql
from tests.llm.conftest import frame, words


def plain_counts(text):
    text = text or ""
    found = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    repeated = {k + o for k, w in enumerate(zip(found, found[1:], found[2:], strict=False)) if windows[w] > 1 for o in range(3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    failed = len(found) < 50 or 100 * len(repeated) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_counts(spark, docs, rows):
    found = rules.quality_verdicts(docs, labels_of(spark, [])).collect()
    assert Counter(tuple(r)[:7] for r in found) == Counter((i, *plain_counts(t)) for i, t in rows)
    assert all(r["kept"] is (not r["base_failed"]) for r in found)


def test_repeats(spark):
    texts = ["a b c a b c", "a a a a", "a b c d", "x\nx\n\nx\n \n y", "a b c x a b c y b c x", "", "a a a"]
    rows = list(enumerate(texts))
    found = rules.signals(frame(spark, rows)).select("doc_id", "_signals.*").collect()
    assert {r["doc_id"]: (r["n_words"], r["n_dup_lines"], r["n_repeat_words"]) for r in found} == {k: (c[0], c[3], c[4]) for k, c in ((k, plain_counts(t)) for k, t in rows)}


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.1), (3, 200, 0.02), (1, 1, 0.02), (30, 3000, 0.02), (0, 0, 0.02)])
def test_binomial_tail(spark, k, n, p):
    found = spark.range(1).select(rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    exact = 1.0 if k > n * p else sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
    assert found == pytest.approx(exact, rel=1e-9)


def labelled(rng, n, noisy):
    """Good prose and bad prose full of symbols; of the good ones a share looks odd."""
    rows, marks = [], []
    for k in range(n):
        good = rng.random() < 0.7
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(55))
        if not good or rng.random() < noisy:
            text = text.replace(" ", " % ")
        rows.append((k, text))
        marks.append((k, int(good), 0))
    return rows, marks


def documents(spark, rows, lang):
    return spark.createDataFrame([(i, t, lang) for i, t in rows], "doc_id long, text string, lang string")


def test_cutoffs_hold_the_risk_in_each_stratum(spark):
    rng = random.Random(6)
    clean, clean_marks = labelled(rng, 1200, 0.0)
    odd, odd_marks = labelled(rng, 1200, 0.2)
    few, few_marks = labelled(rng, 60, 0.0)
    shift = lambda part, by: [(r[0] + by, *r[1:]) for r in part]
    docs = documents(spark, clean, "en").union(documents(spark, shift(odd, 10**10), "fr")).union(documents(spark, shift(few, 5000), None))
    marks = labels_of(spark, clean_marks + shift(odd_marks, 10**10) + shift(few_marks, 5000) + [(None, 1, 0), (7, None, 0), (9, 1, 0), (9, 0, 0)])
    kept = docs.select("doc_id", "lang", "text").join(rules.quality_verdicts(docs, marks), "doc_id")
    share = {r["lang"]: r["kept"] for r in kept.where(F.col("text").contains("%")).groupBy("lang").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    # In the clean stratum symbols give bad ones away; in the odd one that would reject a fifth of the good ones; few labels prove nothing.
    assert share == {"en": 0.0, "fr": 1.0, None: 1.0}
    assert kept.where(~F.col("text").contains("%") & ~F.col("kept")).count() == 0


def test_all_labels_count_however_many(spark):
    rows, marks = labelled(random.Random(9), 1200, 0.0)
    others = spark.range(10**6, 6 * 10**6).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    docs = documents(spark, rows, "en")
    found = rules.quality_verdicts(docs, labels_of(spark, marks).union(others))
    kept = {r["doc_id"] for r in found.where("kept").collect()}
    assert kept == {k for k, t in rows if "%" not in t}


def test_every_stratum_can_have_a_level(spark):
    strata = 1050
    ids = spark.range(strata * 2000)
    good = F.floor(F.col("id") / strata) % 10 < 8
    parts = [F.lit(100).alias("n_words"), F.lit(500).alias("word_chars"), F.when(good, 0).otherwise(300).alias("n_symbols")]
    parts += [F.lit(0).alias(c) for c in ("n_dup_lines", "n_lines", "n_repeat_words")] + [F.lit(False).alias("base_failed")]
    measured = ids.select(F.col("id").alias("doc_id"), (F.col("id") % strata).cast("string").alias("stratum"), F.struct(*parts).alias("_signals"))
    marks = ids.select(F.col("id").alias("doc_id"), good.cast("int").alias("quality"))
    assert rules.cutoffs(measured, marks, "stratum").count() == strata


def test_levels_too_many_to_broadcast(spark):
    levels = spark.range(100_001).select(F.col("id").cast("string").alias("stratum"), (F.col("id") % 8).cast("int").alias("level"))
    docs = spark.createDataFrame([(1, "100000"), (2, "3"), (3, "none"), (4, None)], "doc_id long, lang string")
    assert {r["doc_id"]: r["_level"] for r in rules._with_level(docs, levels, "lang").collect()} == {1: 0, 2: 3, 3: -1, 4: -1}


def test_sql_counterpart(spark):
    rng = random.Random(2)
    rows, marks = labelled(rng, 1500, 0.002)
    texts = {k: words(rng, 60) for k in range(0, 1500, 7)}
    rows = [(k, texts.get(k, t)) for k, t in rows] + [(2000, None), (2001, ""), (5, "again")]
    data = [(k, t, rng.choice(["en", "en", "de", None])) for k, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", data)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", marks)
    found = rules.quality_verdicts(docs, labels_of(spark, marks))
    expected = con.execute(f"SELECT {', '.join(found.columns)} FROM ({sql.quality_verdicts()})").fetchall()
    ours = [tuple(r) for r in found.collect()]
    assert Counter(ours) == Counter(expected)
    assert any(not r[-1] and not r[-2] for r in ours)


def test_keep_good(spark, docs, rows, nothing):
    kept = rules.keep_good(docs, labels_of(spark, []))
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(r for r in rows if not plain_counts(r[1])[-1])
    assert rules.keep_good(nothing, labels_of(spark, [])).count() == 0
    assert rules.quality_verdicts(nothing, labels_of(spark, [(1, 1, 1)])).count() == 0
