"""The stages over the smallest folder, each against a plain version of what it decides."""

from __future__ import annotations

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cadastra.llm.queries import QUERIES, SQL
from tests.llm.test_near_duplicates import plain_fingerprint, reachable
from tests.llm.test_quality import plain_counts
from tests.llm.test_suffix_dedup import plain

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver tables")


@pytest.fixture(scope="module")
def stages(spark):
    frames = [spark.read.parquet(f"{FOLDER}/documents.parquet").cache()]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], FOLDER).cache())
    return frames


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "suffix-array dedup", "secret scans", "best-fit packing"]
    assert all(frame.columns == stages[0].columns and frame.dtypes == stages[0].dtypes for frame in stages[1:-1])
    assert all(r["n_chars"] == len(r["text"]) for frame in stages[3:5] for r in frame.collect())


def test_quality_stage(stages):
    assert sorted(rows_of(stages[1])) == sorted(r for r in rows_of(stages[0]) if not plain_counts(r[1])[-1])


def test_near_dedup_stage(stages):
    rows = rows_of(stages[1])
    prints = {i: plain_fingerprint(t) for i, t in rows}
    group = reachable(sorted(set(prints.values())), 4)
    least: dict[int, int] = {}
    for i, p in prints.items():
        least[group[p]] = min(i, least.get(group[p], i))
    assert sorted(rows_of(stages[2])) == sorted((i, t) for i, t in rows if least[group[prints[i]]] == i)


def test_passage_stage(stages):
    before, after = rows_of(stages[2]), dict(rows_of(stages[3]))
    removed = {i: n for (i, _, n, _, _) in plain(before)}
    assert set(after) == set(removed)
    for i, text in before:
        kept = len(text.encode()) - len(after[i].encode())
        assert 0 <= removed[i] - kept <= 6 * max(1, removed[i] // 200)
        assert removed[i] or after[i] == text


def test_secret_stage(stages):
    pattern = re.compile(r'(?i)(token = ")[0-9a-f]{40}(")')
    assert {i: pattern.sub(r"\1[SECRET]\2", t) for i, t in rows_of(stages[3])} == dict(rows_of(stages[4]))


def test_packing_stage(stages):
    packed = stages[5].collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in rows_of(stages[4])}
    filled = Counter()
    for r in packed:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 1024


def test_registered(spark):
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= names and set(SQL) <= set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect()} <= set(range(200))
