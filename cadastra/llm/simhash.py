"""SimHash near-duplicates over a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most d bits agree in at least m = 8 - d of their 8 positional bytes. The index
therefore has a posting for each fingerprint under every choice of m positions and the bytes there: two fingerprints meet
in a posting list exactly if their tally of shared positional bytes reaches m. What meets is verified by its bits.

Only distinct fingerprints enter the index. A list longer than ``LONGEST_LIST`` is not compared but dealt anew: the bits
its members may still differ in are cut into d + 1 blocks, one of which two members within d bits must share. That repeats
until lists are short; with b bits left a list has 2^b members at most, so it ends. A list gives a forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.components import components
from cadastra.llm.tables import slices, utf8_of
from cadastra.session import written

SEED = 42
LONGEST_LIST = 4096
#: Shingles whose bits are counted at a time.
_BLOCK = 4096

_LINKS = pa.schema([("long", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])
_INDEX = pa.schema([("mask", pa.int64()), ("fingerprint", pa.int64())])


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the shingles of ``shingle`` words (the whole sequence, if shorter); 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and white space is space and 9 to 13
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    size = min(shingle, len(words))
    n, hash_of = len(words) - size + 1, partial(xxhash.xxh64_intdigest, seed=SEED)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        spans = zip(starts[at : min(at + _BLOCK, n)], ends[at + size - 1 :], strict=False)
        hashes = np.array([hash_of(joined[a:b]) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed long) of whole texts; a null text has no words. ``digests`` adds ``text_hash``, xxhash64."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, shingle) for t in utf8_of(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], names=["doc_id", "fingerprint", "text_hash"][: batch.num_columns])

    more = [F.xxhash64(text_col).alias("text_hash")] if digests else []
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    return whole.mapInArrow(each, "doc_id long, fingerprint long" + (", text_hash long" if digests else ""))


def byte_masks(distance: int) -> list[int]:
    """Masks of every choice of the 8 - d byte positions that two linked fingerprints share at least."""
    if not 0 <= distance < 8:
        raise ValueError("the index guarantees a shared byte for distances from 0 to 7")
    return [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(8), 8 - distance)]


def finer_masks(mask: int, distance: int) -> list[int]:
    """The mask with each of d + 1 blocks of its free bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    blocks = [free[k :: distance + 1] for k in range(distance + 1)]
    return [mask | sum(1 << b for b in block) for block in blocks if block] or [mask]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each of n nodes that is not the least of its component to that one."""
    root = np.arange(n)
    while len(a):
        # Both ends are roots here, so no pointer that stands for a dropped link is overwritten.
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    hung = np.flatnonzero(root != np.arange(n))
    return hung, root[hung]


def _verified(mask: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links inside the posting lists of sorted index rows."""
    key, left, right, lag = prints & mask, [], [], 1
    at = np.arange(len(prints))
    while True:
        at = at[at < len(prints) - lag]
        at = at[(mask[at] == mask[at + lag]) & (key[at] == key[at + lag])]
        if not len(at):
            break
        near = at[np.bitwise_count((prints[at] ^ prints[at + lag]).view(np.uint64)) <= distance]
        left.append(near)
        right.append(near + lag)
        lag += 1
    none = np.zeros(0, np.int64)
    return forest(np.concatenate([none, *left]), np.concatenate([none, *right]), len(prints))


def _compared(index: DataFrame, distance: int, longest: int) -> DataFrame:
    """Links (``long`` false) in lists of at most ``longest`` members; rows of longer lists (``long`` true: a is the mask, b the fingerprint)."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(mask: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            key = prints & mask
            firsts = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])) if len(key) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(firsts, len(key)))
            over = np.repeat(sizes > longest, sizes)
            if over.any():
                yield too_long(mask[over], prints[over])
            several = np.repeat((sizes > 1) & (sizes <= longest), sizes)
            mask, prints = mask[several], prints[several]
            a, b = _verified(mask, prints, distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a), bool)), pa.array(prints[a]), pa.array(prints[b])], schema=_LINKS)

        def too_long(mask: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(mask), bool)), pa.array(mask), pa.array(prints)], schema=_LINKS)

        mask, prints, last = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            mask = np.concatenate([mask, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy()])
            if not len(mask):
                continue
            if last is not None:  # a list found too long goes on in this batch
                own = (mask == last[0]) & (prints & last[0] == last[1])
                if own.any():
                    yield too_long(mask[own], prints[own])
                    mask, prints = mask[~own], prints[~own]
                if not len(mask):
                    continue
                last = None
            open_ = (mask == mask[-1]) & (prints & mask == prints[-1] & mask[-1])
            yield from done(mask[~open_], prints[~open_])
            mask, prints = mask[open_], prints[open_]
            if len(mask) > longest:
                last = (mask[-1], prints[-1] & mask[-1])
                yield too_long(mask, prints)
                mask, prints = mask[:0], prints[:0]
        yield from done(mask, prints)

    key = F.col("fingerprint").bitwiseAND(F.col("mask"))
    dealt = index.withColumn("key", key).repartition("mask", "key").sortWithinPartitions("mask", "key", "fingerprint")
    return dealt.select("mask", "fingerprint").mapInArrow(links, "long boolean, a long, b long")


def linked_fingerprints(distinct: DataFrame, distance: int = 4, longest: int = LONGEST_LIST) -> DataFrame:
    """Links ``a, b`` that span the same components as all pairs of ``distinct.fingerprint`` within ``distance`` bits."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array([_signed(m) for m in byte_masks(distance)], np.int64)
        for batch in slices(batches, 4096):
            prints = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(masks, len(prints))), pa.array(np.repeat(prints, len(masks)))], schema=_INDEX)

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            rows = [(_signed(f), p) for m, p in zip(*[c.to_pylist() for c in batch.columns], strict=True) for f in finer_masks(m & (1 << 64) - 1, distance)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], schema=_INDEX)

    index, links = distinct.select("fingerprint").mapInArrow(posted, "mask long, fingerprint long"), None
    while True:
        found = written(_compared(index, distance, longest))
        own = found.where(~F.col("long")).select("a", "b")
        links = own if links is None else links.union(own)
        rest = found.where("long").select(F.col("a").alias("mask"), F.col("b").alias("fingerprint"))
        if rest.isEmpty():
            return links
        index = rest.mapInArrow(finer, "mask long, fingerprint long")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST_LIST) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) ``, component_id`` per row of ``docs``.

    Documents within ``distance`` bits are linked; ``component_id`` is the least id reachable, the own one included. A null
    or wordless text has fingerprint zero and is linked like any other. Repeated rows stay; a null id is never a component's
    id unless all ids of the component are null. Empty table: no rows. Other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle, id_col, text_col))
    own = _groups(prints, distance, longest).select("fingerprint", "component_id")
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(own, "fingerprint").select("doc_id", shown.alias("fingerprint"), "component_id")


def _groups(prints: DataFrame, distance: int, longest: int) -> DataFrame:
    """``fingerprint, component_id, root`` of each distinct fingerprint; ``root`` is one of its component."""
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = components(linked_fingerprints(distinct, distance, longest))
    placed = distinct.join(roots, distinct.fingerprint == roots.node, "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    placed = written(placed)
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(least, "root").select("fingerprint", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST_LIST) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: that of the least id, of several of that id the one of the least text hash.

    An id that is there with unrelated texts is in several groups and stays once for each in which it is the least. Null ids
    are greater than others. Equal rows count once. A null text has no words. Columns keep their names and order, whatever
    these are; an empty table stays empty.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    own_id, own_text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    rows = docs.toDF(*names)
    prints = written(fingerprints(rows, shingle, own_id, own_text, digests=True))
    found = prints.join(_groups(prints, distance, longest), "fingerprint").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = found.groupBy("root", "doc_id").agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash").distinct()
    same = F.col(own_id).cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(own_text) == F.col("text_hash"))
    return rows.join(first, same, "left_semi").dropDuplicates([own_id, own_text]).toDF(*docs.columns)
