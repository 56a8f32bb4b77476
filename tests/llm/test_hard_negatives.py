"""Hard negatives against plain integers, and exactness of the residue products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastra.llm import hard_negatives as H
from cadastra.llm import sql

SCHEMA = "vec_id long, embedding array<float>, label int, key string, score int, cell int, positives int, shard string"


def plain(rows, scale=256, every=50, positives=5, negatives=3, low=50, high=95):
    """By the definition, with Python's integers."""
    taking = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taking.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(scale * float(np.float32(x))) for x in vector]))
    found = []
    for anchor, own, q in (r for r in taking if r[0] % every == 0):
        scored = [(sum(a * b for a, b in zip(q, other, strict=False)), vec_id, label) for vec_id, label, other in taking]
        same = sorted((-s, i) for s, i, label in scored if label == own and i != anchor)[:positives]
        for score, positive in ((-s, i) for s, i in same):
            rest = sorted((-s, i) for s, i, label in scored if label != own and low * score <= 100 * s <= high * score)
            found += [(anchor, positive, k, i, score, -s) for k, (s, i) in enumerate(rest[:negatives], 1)]
    return sorted(found)


def vectors(seed, n=400, d=70, size=0.2, ties=False):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        vector = rng.normal(0, size, d).astype(np.float32)
        if ties:
            vector = np.round(vector * 4) / 4
        rows.append((k, vector.tolist(), int(rng.integers(0, 4))))
    return rows


def frame(spark, rows):
    """Vectors with columns that clash with names the operator uses."""
    return spark.createDataFrame([(i, v, label, "k", 1, 2, 3, "s") for i, v, label in rows], SCHEMA).repartition(3)


def answers(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    out = H.hard_negatives(df, label=label)
    assert [c for c, _ in out.dtypes] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.sampled_from([3, 300, 60_000, 2**26]), st.integers(0, 2**31))
def test_scores_are_exact(dimension, largest, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-largest, largest + 1, (9, dimension)), rng.integers(-largest, largest + 1, (11, dimension))
    bound = float(max((a.astype(object) ** 2).sum(axis=1).max(), (b.astype(object) ** 2).sum(axis=1).max()))
    primes = H.primes_for(1.001 * bound)
    expected = (a.astype(object) @ b.T.astype(object)).tolist()
    assert H.scores(H.residues(a, primes), H.residues(b, primes), primes).astype(object).tolist() == expected


def test_extreme_residues_stay_exact():
    for p in H.primes_for(2.0**61):
        half = (p - 1) // 2
        a = np.full((3, 64 * 5), half, np.int64)
        got = H._product(*(H.residues(m, [p])[0] for m in (a, -a)), p)
        assert ((got.astype(np.int64) + 64 * 5 * half * half) % p == 0).all()


def test_against_plain_integers(spark):
    rows = vectors(1)
    assert answers(frame(spark, rows)) == plain(rows)
    assert plain(rows)


def test_ties_repeats_and_odd_rows(spark):
    rows = vectors(2, 300, 6, ties=True)
    rows += [rows[50], rows[50], rows[3], (3, rows[4][1], 1), (None, rows[0][1], 1), (600, None, 1), (601, rows[0][1], None)]
    rows += [(650, [1.0, None, 0.5], 1), (700, [float("nan")] * 6, 2), (750, [float("inf")] * 6, 2), (800, [], 3), (850, [0.25, 0.5], 0), (-50, rows[7][1], 2)]
    rows += [(900 + k, rows[10][1], k % 4) for k in range(150)]
    assert answers(frame(spark, rows)) == plain(rows)


def test_large_components_take_more_primes(spark):
    rows = vectors(3, 200, 5, size=3e5) + [(1000, [1e30] * 5, 1)]
    assert answers(frame(spark, rows)) == plain(rows[:-1])


def test_many_cells_and_tiles_give_the_same(spark, monkeypatch):
    rows = vectors(4, 500, 8, ties=True)
    plan = H.plan_for
    monkeypatch.setattr(H, "TILE", 7)
    monkeypatch.setattr(H, "plan_for", lambda df: H.Plan(plan(df).dimension, plan(df).primes, 3, 5))
    assert answers(frame(spark, rows)) == plain(rows)


def test_nothing(spark):
    assert answers(frame(spark, [])) == []
    assert answers(frame(spark, [(50, [0.5], 1)])) == []
    assert answers(frame(spark, vectors(5, 40)[1:])) == []


@pytest.mark.parametrize("ties", [False, True])
def test_sql(spark, tmp_path, ties):
    rows = [*vectors(6, 300, 8, ties=ties), (301, None, 1), (350, [0.1, None], 1)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(con.execute(sql.hard_negatives()).fetchall()) == plain(rows)
