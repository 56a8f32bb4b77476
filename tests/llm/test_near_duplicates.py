from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadastra.llm import simhash
from cadastra.llm.components import components
from tests.llm.conftest import found


def plain_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints: list[int], distance: int) -> dict[int, int]:
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= distance:
                root[top(a)] = top(b)
    return {p: top(p) for p in prints}


def test_classes(docs, rows):
    prints = {t: plain_fingerprint(t) for _, t in rows}
    group = reachable(sorted(set(prints.values())), 4)
    least: dict[int, int | None] = {}
    for i, t in rows:
        g = group[prints[t]]
        least[g] = i if least.get(g) is None else least[g] if i is None else min(i, least[g])
    expected = [(i, f"{prints[t]:016x}", least[group[prints[t]]]) for i, t in rows]
    assert found(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)


def clustered(seed: int) -> list[int]:
    rng = random.Random(seed)
    prints = {0}
    for centre in [rng.getrandbits(64) for _ in range(4)]:
        for _ in range(12):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
            prints.add(centre ^ rng.getrandbits(8) << rng.choice([0, 8, 40]))
    return sorted(prints)


@pytest.mark.parametrize(("distance", "longest"), [(4, 4096), (4, 8), (7, 40)])
def test_index_finds_the_components_of_all_pairs(spark, distance, longest):
    prints = clustered(distance + longest)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint long").repartition(3)
    links = simhash.linked_fingerprints(frame, distance, longest)
    pairs = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in pairs)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    expected = reachable(prints, distance)
    classes = lambda of: {frozenset(p for p in prints if of(p) == c) for c in map(of, prints)}
    assert classes(lambda p: roots.get(simhash._signed(p), simhash._signed(p))) == classes(expected.get)


def rooted(links: list[tuple[int, int]], n: int) -> list[int]:
    """Least node of each node's component, by plain union-find."""
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    return [top(x) for x in range(n)]


def test_forest_keeps_every_link():
    rng = random.Random(8)
    graphs = [(7, [(0, 6), (1, 2), (2, 3), (3, 4), (4, 5), (4, 6), (5, 6)]), (1, []), (2, [(1, 1)])]
    for _ in range(2000):
        n = rng.randint(2, 30)
        names = rng.sample(range(n), n)
        chain = [(names[k], names[k + 1]) for k in range(n - 1) if rng.random() < 0.8]
        graphs.append((n, [*chain, *((rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 5)))]))
    for n, links in graphs:
        a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
        root = list(range(n))
        for node, own in zip(*simhash.forest(a, b, n), strict=True):
            root[node] = own
        assert root == rooted(links, n), links


def test_chain_through_lower_fingerprints(spark):
    prints = [p << 32 for p in (0x780E0000, 0x80010707, 0xC0000606, 0xE0000006, 0xF0000000, 0xF4000800, 0xF8080000)]
    # Upper and lower halves, so that the chain is met in either order of the bytes.
    for group in (prints, [p >> 32 for p in prints]):
        links = simhash.linked_fingerprints(spark.createDataFrame([(simhash._signed(p),) for p in group], "fingerprint long"), 4)
        roots = {r["node"]: r["root"] for r in components(links).collect()}
        found = {roots.get(simhash._signed(p), simhash._signed(p)) for p in group}
        assert len(found) == len(set(reachable(group, 4).values())) == 1


def test_distance_beyond_the_index():
    with pytest.raises(ValueError, match="0 to 7"):
        simhash.byte_masks(8)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)] + [(7, 7), (200, 7)]
    links = spark.createDataFrame(chain + star, "a long, b long")
    roots = dict(components(links).collect())
    assert roots == {k: 100 for k in range(100, 161)} | {k: 7 for k in [7, *range(200, 260)]}


def test_one_of_each_group_stays(docs, rows):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    classes = found(simhash.near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct(), "doc_id")
    assert sorted({(r["doc_id"],) for r in kept.collect()}, key=repr) == classes
    assert kept.count() == kept.select("doc_id", "text").distinct().count()


def test_one_row_of_a_group_stays_whatever_the_ids(spark):
    a, b, near = "one two three four five six", "seven eight nine ten eleven", "One two three four five six"
    rows = [(0, b), (1, a), (1, b), (2, a), (1, near), (None, a), (None, "alone it is here"), (None, "alone it is here"), (5, None), (4, "")]
    schema = "doc_id long, text string, _text_hash long, _first long, fingerprint string, root long, text_hash long, component_id int"
    df = spark.createDataFrame([(i, t, 1, 2, "x", 3, 4, 5) for i, t in rows], schema).repartition(4)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()), key=repr)
    assert got == sorted([(0, b), (1, a), (None, "alone it is here"), (4, "")], key=repr)
    assert kept.where("_text_hash = 1 AND _first = 2 AND root = 3 AND text_hash = 4 AND component_id = 5").count() == 4


def test_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).count() == 0
