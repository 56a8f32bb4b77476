from __future__ import annotations

import hashlib
import random
from collections import Counter
from math import log2

import numpy as np

from cadastra.llm import bloom_digest as digest
from tests.llm.conftest import words


def test_entropy_classes_are_those_of_each_window():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(0, k, 150).astype(np.uint8) for k in (1, 2, 20, 256)])
    for at, found in enumerate(digest.entropy_classes(data)):
        counts = Counter(data[at : at + 64].tolist()).values()
        entropy = -sum(c / 64 * log2(c / 64) for c in counts) / 6
        assert abs(found - entropy * 999) <= 1.0


def test_features_do_not_depend_on_the_parts(monkeypatch):
    rng = random.Random(5)
    texts = [words(rng, n).encode() for n in (1, 10, 700, 60, 2000)] + [b"", b"a" * 3000, b"x" * 64]
    rank = digest.ranks(digest.class_counts(texts))
    whole = digest.features(texts, rank)
    counts = digest.class_counts(texts)
    monkeypatch.setattr(digest, "PART", 500)
    assert all(np.array_equal(a, b) for a, b in zip(whole, digest.features(texts, rank), strict=True))
    assert (counts == digest.class_counts(texts)).all()
    assert all(np.array_equal(a, digest.features([t], rank)[0]) for t, a in zip(texts, whole, strict=True))


def test_popularity_by_definition():
    text = words(random.Random(9), 150).encode()
    rank = digest.ranks(digest.class_counts([text]))
    own = rank[digest.entropy_classes(np.frombuffer(text, np.uint8))]
    popular = Counter()
    for at in range(len(own)):
        run = [(own[k], k) for k in range(at, min(at + 64, len(own))) if own[k]]
        if run:
            popular[min(run)[1]] += 1
    windows = [np.frombuffer(text[k : k + 64], np.uint8) for k, n in sorted(popular.items()) if n >= 16]
    assert digest._hashes(np.stack(windows)).tolist() == digest.features([text], rank)[0].tolist()


def test_likeness():
    rng = random.Random(1)
    a, b = words(rng, 2000).encode(), words(rng, 2000).encode()
    rank = digest.ranks(digest.class_counts([a, b]))
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    one, other, mixed, empty = digest.digests([a, b, half, b""], rank)
    assert digest.likeness(one, one) == 1.0 == digest.likeness(empty, empty)
    assert digest.likeness(one, empty) == 0.0
    assert digest.likeness(one, other) < 0.1 < 0.3 < digest.likeness(one, mixed) < 0.9
    assert all(np.bitwise_count(f).sum() <= 160 * 5 for f in one[1])


def test_table(docs, rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = Counter()
    texts = [(t or "") for _, t in order]
    rank = digest.ranks(digest.class_counts([t.encode() for t in texts]))
    own = digest.digests([t.encode() for t in texts], rank)
    for k, (i, _) in enumerate(order):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        edited = (text[: len(text) - len(text) // 2] + following[: len(text) // 2]).encode()
        other = digest.digests([edited], rank)[0]
        near = (digest.likeness(own[k], other), digest.likeness(own[k], own[(k + 1) % len(texts)]))
        expected[(i, len(text), hashlib.sha256(edited).hexdigest(), digest.shown(own[k]), digest.shown(other), *near)] += 1
    assert Counter(tuple(r) for r in digest.fingerprint_documents(docs).collect()) == expected


def test_one_row_and_nothing(spark, nothing):
    assert digest.fingerprint_documents(nothing).count() == 0
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    row = digest.fingerprint_documents(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0
