from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cadastra.llm import suffix_dedup as dedup
from cadastra.llm.difference_cover import BITS, repeated, suffix_order
from tests.llm.conftest import frame, words


def plain(rows):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[p : p + 200] for t in texts for p in range(len(t) - 199))
    found = Counter()
    for (i, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - 199):
            if counts[t[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        found[(i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return found


def result(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def test_suffix_order_is_that_of_sorted_suffixes():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 5, 256):
        data = rng.integers(0, letters, 700).astype(np.uint8)
        raw = data.tobytes()
        order = suffix_order(data, 48)
        assert sorted(order) == list(range(700))
        prefixes = [raw[k : k + 48].ljust(48, b"\0") for k in order]
        assert prefixes == sorted(prefixes)


@pytest.mark.parametrize("length", [8, 31, 200])
def test_repeated_starts(length):
    rng = np.random.default_rng(length)
    passage = rng.integers(0, 256, 500).astype(np.uint8)
    for letters in (1, 2, 256):
        data = np.concatenate([x for _ in range(4) for x in (passage[rng.integers(0, 90) :], rng.integers(0, letters, rng.integers(1, 90)).astype(np.uint8))])
        wanted = np.flatnonzero(rng.random(len(data) - length + 1) < 0.9)
        counts = Counter(data[k : k + length].tobytes() for k in wanted)
        assert repeated(data, wanted, length).tolist() == [counts[data[k : k + length].tobytes()] > 1 for k in wanted]


def test_a_buffer_too_long_is_refused():
    with pytest.raises(ValueError, match="less than"):
        suffix_order(np.zeros(1 << BITS, np.uint8), 8)


def test_table(docs, rows):
    assert result(dedup.deduplicated(docs)) == plain(rows)


def crowd():
    """One passage in many texts at different places, with differing neighbours."""
    rng = random.Random(4)
    passage = words(rng, 60)
    texts = [words(rng, rng.randint(0, 12)) + passage[rng.randint(0, 30) : len(passage) - rng.randint(0, 30)] + words(rng, rng.randint(0, 40)) for _ in range(60)]
    return [(k, t) for k, t in enumerate([*texts, "q" * 2500, "xyz" * 300, "xyz" * 301])]


@pytest.mark.parametrize(("buffer", "rounds"), [(3 << 19, 3), (3000, 2), (600, 0)])
def test_keys_beyond_a_buffer(spark, buffer, rounds, monkeypatch):
    monkeypatch.setattr(dedup.repeated_starts, "__defaults__", ("doc_id", "text", buffer, rounds))
    rows = crowd()
    assert result(dedup.deduplicated(frame(spark, rows), buffer=buffer)) == plain(rows)


def test_long_texts_in_parts(spark, monkeypatch):
    texts = [(words(random.Random(k), 400).encode()) for k in (1, 1, 2)]
    whole = [(k, p + a) for owners, places, parts in dedup._cut(texts) for k, p, x in zip(owners, places, parts, strict=True) for a in range(len(x) - 199)]
    monkeypatch.setattr(dedup, "PART", 300)
    cut = [(k, p + a) for owners, places, parts in dedup._cut(texts) for k, p, x in zip(owners, places, parts, strict=True) for a in range(len(x) - 199)]
    assert cut == whole and len(set(cut)) == len(cut)


def test_texts_keep_whole_characters(spark):
    passage = words(random.Random(8), 60)
    rows = [(1, "ä" + passage + "ö"), (2, "å" + passage + "õ"), (3, None), (4, "other")]
    docs = frame(spark, rows)
    cleaned = dedup.without_repeats(docs)
    assert cleaned.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {1: "äö", 2: "åõ", 3: None, 4: "other"}


def test_nothing(nothing):
    assert dedup.deduplicated(nothing).count() == 0
    assert dedup.without_repeats(nothing).count() == 0
