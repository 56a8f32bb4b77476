"""Removal of byte strings that start at more than one place of a corpus, by suffix order in difference-cover buffers.

To order all suffixes of a corpus is needless where only strings of ``LENGTH`` bytes count. Two equal strings have the same
rarest gram (the least of their ``GRAM``-byte hashes), so:

1. each document is cut into runs of starts whose strings share that hash (about one run for 85 bytes), and runs meet by hash;
2. a hash met once, and once in its run, marks no repeated string. Runs of the same bytes are repeated as a whole and stand
   for each other; within a task copies are collapsed before they travel;
3. what is left, runs that share the hash but not all bytes, and a copy of each that stands for others, goes into buffers
   by hash. Their suffixes are ordered by the difference-cover method (``difference_cover``): sampled triples are sorted and
   named, names recursed on, the rest merged in, and adjacent prefixes compared;
4. starts found go back to their documents, whose bytes they cover are removed.

A hash whose runs do not fit into a buffer is dealt anew by another hash of each string, and at last by the string's own
digest: no run is dropped. Hash collisions only bring runs together that a later step parts by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.difference_cover import repeated
from cadastra.llm.tables import slices
from cadastra.session import written

LENGTH, GRAM = 200, 64
#: Bytes of documents hashed at a time, and bytes of a buffer that is sorted.
PART, BUFFER = 1 << 20, 3 << 19
#: Copies a task remembers in order to collapse later ones.
REMEMBERED = 200_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Kinds of runs: a whole run is repeated; a part has to be looked at; a sample stands for whole runs among parts.
WHOLE, PARTIAL, SAMPLE = 0, 1, 2
_ID = [("doc_id", pa.int64()), ("text_hash", pa.int64())]
_RUN = pa.schema([("key", pa.int64()), ("same", pa.int64()), *_ID, ("first", pa.int64()), ("last", pa.int64()), ("kind", pa.int8())])
_RUN_SQL = "key long, same long, doc_id long, text_hash long, first long, last long, kind byte"


def _powers(n: int, base: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class _Hasher:
    """Polynomial hashes of all grams of a buffer; tables are kept up to the longest buffer met."""

    def __init__(self):
        self._up = self._down = np.ones(1, np.uint64)

    def grams(self, data: np.ndarray, salt: int) -> np.ndarray:
        if len(self._up) <= len(data):
            self._up, self._down = _powers(2 * len(data), _BASE), _powers(2 * len(data), _INVERSE)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], dtype=np.uint64, out=sums[1:])
        found = (sums[GRAM:] - sums[:-GRAM]) * self._down[: len(data) - GRAM + 1]
        found ^= np.uint64(salt * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ found >> np.uint64(32)


_HASHER = _Hasher()


def _least(values: np.ndarray, width: int, pick: Callable = np.minimum) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values, done = pick(values[:-done], values[done:]), 2 * done
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def runs(parts: list[bytes], salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts in the parts: part, first and last start in it, hash, and whether the hash comes again within the run's strings."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    width = LENGTH - GRAM + 1
    grams = _HASHER.grams(data, salt)
    least = _least(grams, width)  # of each string of LENGTH bytes
    own = np.zeros(len(least), bool)
    begins = np.concatenate([[0], ends[:-1]])
    for a, b in zip(begins, ends, strict=True):
        own[a : max(a, b - LENGTH + 1)] = True
    part_of = np.repeat(np.arange(len(parts)), np.diff(np.concatenate([[0], ends])))[: len(least)]
    edge = np.concatenate([[True], (least[1:] != least[:-1]) | (part_of[1:] != part_of[:-1]) | (own[1:] != own[:-1])])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(least)) - 1
    first, last = first[own[first]], last[own[first]]
    # Places of grams that are the least of a string; a run with two of its own hash may repeat itself.
    zero = np.zeros(width - 1, np.uint64)
    places = np.flatnonzero(grams == _least(np.concatenate([zero, np.where(own, least, np.uint64(0)), zero]), width, np.maximum))
    values, name = np.unique(grams[places], return_inverse=True)
    marked = np.sort(name * len(grams) + places)
    run_name = np.searchsorted(values, least[first]) * len(grams)
    n = np.searchsorted(marked, run_name + last + width - 1, "right") - np.searchsorted(marked, run_name + first, "left")
    k = part_of[first]
    return k, first - begins[k], last - begins[k], least[first], n > 1


def _cut(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of about ``PART`` bytes: index, place in the text and bytes of each part. Each start is in one part."""
    owners, places, parts, size = [], [], [], 0
    for k, text in enumerate(texts):
        for a in range(0, max(len(text) - LENGTH + 1, 0), PART):
            part = text[a : a + PART + LENGTH - 1]
            owners.append(k)
            places.append(a)
            parts.append(part)
            size += len(part)
            if size >= PART:
                yield owners, places, parts
                owners, places, parts, size = [], [], [], 0
    if parts:
        yield owners, places, parts


def _all_runs(docs: DataFrame) -> DataFrame:
    """Runs of all documents. Copies met in the same task are whole at once; one of them goes on and stands for the rest."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copied: set[tuple[int, int]] = set()
        spread = 0
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            ids = [c.to_numpy(zero_copy_only=False) if not c.null_count else np.array(c.to_pylist(), object) for c in batch.columns[:2]]
            for owners, places, parts in _cut(texts):
                part, first, last, key, again = runs(parts)
                same = np.array([xxhash.xxh3_64_intdigest(parts[p][a : b + LENGTH]) for p, a, b in zip(part.tolist(), first.tolist(), last.tolist(), strict=True)], np.uint64)
                kind = np.where(again, PARTIAL, -1).astype(np.int8)
                order = np.lexsort((same, key))
                twin = np.concatenate([[False], (key[order][1:] == key[order][:-1]) & (same[order][1:] == same[order][:-1])]) if len(order) else np.zeros(0, bool)
                following = np.append(twin[1:], False) if len(order) else twin
                whole = np.zeros(len(key), bool)
                whole[order] = twin | following
                leads = np.zeros(len(key), bool)
                leads[order] = following & ~twin
                travels = ~whole | leads
                for k in np.flatnonzero(leads):
                    pair = (int(key[k]), int(same[k]))
                    if pair in copied:
                        travels[k] = False
                    elif len(copied) < REMEMBERED:
                        copied.add(pair)
                kind[whole] = WHOLE
                shown = key.copy()
                # What need not travel to its hash is spread by a number of its own.
                stay = int((~travels).sum())
                shown[~travels] = (np.arange(spread, spread + stay, dtype=np.uint64) ^ np.uint64(TaskContext.get().partitionId() << 40)) * np.uint64(_BASE)
                spread += stay
                resolved = np.where(travels, kind, WHOLE + 8).astype(np.int8)
                owner = np.array(owners)[part]
                at = np.array(places, np.int64)[part]
                columns = [shown.view(np.int64), same.view(np.int64), *[c[owner] for c in ids], first + at, last + at, resolved]
                yield pa.RecordBatch.from_arrays([pa.array(c, t, from_pandas=True) for c, t in zip(columns, _RUN.types, strict=True)], schema=_RUN)

    return docs.mapInArrow(each, _RUN_SQL)


def _judged(found: DataFrame) -> DataFrame:
    """Runs that are repeated or may be, with their kind, next to their equals in key and bytes."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: pa.RecordBatch, before: tuple | None, after: tuple | None) -> pa.RecordBatch:
            key, same, kind = (rows.column(k).to_numpy() for k in (0, 1, 6))
            keys = np.concatenate([[before[0] if before else 0], key, [after[0] if after else 0]])
            sames = np.concatenate([[before[1] if before else 0], same, [after[1] if after else 0]])
            near = keys[1:] == keys[:-1]
            near[0] &= before is not None
            near[-1] &= after is not None
            equal = near & (sames[1:] == sames[:-1])
            whole = equal[:-1] | equal[1:] | (kind == WHOLE) | (kind == WHOLE + 8)
            mixed = (near & ~equal)[:-1] | (near & ~equal)[1:]
            result = np.full(len(key), -1, np.int8)
            result[~whole & (mixed | (kind == PARTIAL))] = PARTIAL
            result[whole] = WHOLE
            result[whole & mixed & (kind != WHOLE + 8)] = SAMPLE
            chosen = pa.array(np.flatnonzero(result >= 0))
            columns = [*rows.columns[:6], pa.array(result)]
            return pa.RecordBatch.from_arrays(columns, schema=_RUN).take(chosen)

        held, before = None, None  # a batch waits for the first row of the next
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield told(held, before, (batch.column(0)[0].as_py(), batch.column(1)[0].as_py()))
                before = (held.column(0)[-1].as_py(), held.column(1)[-1].as_py())
            held = batch
        if held is not None:
            yield told(held, before, None)

    return found.repartition("key").sortWithinPartitions("key", "same").mapInArrow(judge, _RUN_SQL)


_CONTEXT_SQL = "key long, doc_id long, text_hash long, first long, sample boolean, data binary"
_CONTEXT = pa.schema([("key", pa.int64()), *_ID, ("first", pa.int64()), ("sample", pa.bool_()), ("data", pa.binary())])
_STARTS_SQL = "over boolean, key long, doc_id long, text_hash long, first long, last long, sample boolean, data binary"
_STARTS = pa.schema([("over", pa.bool_()), ("key", pa.int64()), *_ID, ("first", pa.int64()), ("last", pa.int64()), ("sample", pa.bool_()), ("data", pa.binary())])


def _start_runs(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of neighbouring numbers."""
    edge = np.flatnonzero(np.diff(found) != 1)
    return found[np.concatenate([[0], edge + 1])], found[np.concatenate([edge, [len(found) - 1]])]


def _compared(contexts: DataFrame, buffer: int) -> DataFrame:
    """Starts repeated in the strings of their key (``over`` false); contexts of keys that fill more than a buffer (``over`` true)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def starts(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            sizes = [len(r[5]) for r in rows]
            begins = np.cumsum([0, *sizes[:-1]])
            wanted = np.concatenate([np.arange(b, b + n - LENGTH + 1) for b, n in zip(begins, sizes, strict=True)])
            hits = wanted[repeated(np.frombuffer(b"".join(r[5] for r in rows), np.uint8), wanted, LENGTH)]
            out = []
            for row, begin, a, b in zip(rows, begins, np.searchsorted(hits, begins), np.searchsorted(hits, begins + sizes), strict=True):
                if b > a and not row[4]:
                    own = hits[a:b] - begin + row[3]
                    out += [(False, row[0], row[1], row[2], int(x), int(y), False, None) for x, y in zip(*_start_runs(own), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _STARTS.types, strict=True)], schema=_STARTS)

        def beyond(rows: list[tuple]) -> pa.RecordBatch:
            out = [(True, r[0], r[1], r[2], r[3], None, r[4], r[5]) for r in rows]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _STARTS.types, strict=True)], schema=_STARTS)

        ready: list[tuple] = []  # whole keys that wait for a full buffer
        current: list[tuple] = []  # the key that is being read
        ready_size, size, over = 0, 0, None
        for batch in slices(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if over is not None and row[0] == over:
                    yield beyond([row])
                    continue
                over = None
                if current and row[0] != current[0][0]:
                    if ready and ready_size + size > buffer:
                        yield from starts(ready)
                        ready, ready_size = [], 0
                    ready, ready_size = ready + current, ready_size + size
                    current, size = [], 0
                current.append(row)
                size += len(row[5])
                if size > buffer:
                    yield beyond(current)
                    current, size, over = [], 0, row[0]
        if ready and ready_size + size > buffer:
            yield from starts(ready)
            ready = []
        if ready or current:
            yield from starts(ready + current)

    dealt = contexts.repartition("key").sortWithinPartitions("key", "doc_id", "text_hash", "first")
    return dealt.mapInArrow(compare, _STARTS_SQL)


def _finer(over: DataFrame, salt: int) -> DataFrame:
    """Contexts cut again, by another hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            for owners, places, parts in _cut([r[5] for r in rows]):
                part, first, last, key, _ = runs(parts, salt)
                out = []
                for p, a, b, k in zip(part.tolist(), first.tolist(), last.tolist(), key.view(np.int64).tolist(), strict=True):
                    row = rows[owners[p]]
                    mixed = xxhash.xxh3_64_intdigest(f"{row[0]} {k}".encode()) - (1 << 63)
                    out.append((mixed, row[1], row[2], row[3] + places[p] + a, row[4], parts[p][a : b + LENGTH]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _CONTEXT.types, strict=True)], schema=_CONTEXT)

    return over.select("key", "doc_id", "text_hash", "first", "sample", "data").mapInArrow(cut, _CONTEXT_SQL)


def _one_by_one(over: DataFrame) -> DataFrame:
    """Repeated starts of contexts by the digest of each string: counts collapse in each task, and only starts travel."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                digests = [hashlib.blake2b(row[3][a : a + LENGTH], digest_size=16).digest() for a in range(len(row[3]) - LENGTH + 1)]
                n = len(digests)
                yield pa.RecordBatch.from_arrays([pa.array(digests), pa.array([row[0]] * n, pa.int64()), pa.array([row[1]] * n, pa.int64()), pa.array(range(row[2], row[2] + n), pa.int64())], names=["digest", "doc_id", "text_hash", "first"])

    strings = over.select("doc_id", "text_hash", "first", "data").mapInArrow(each, "digest binary, doc_id long, text_hash long, first long")
    often = strings.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    return strings.join(often, "digest").select("doc_id", "text_hash", "first", F.col("first").alias("last"))


def _parts_found(contexts: DataFrame, buffer: int, rounds: int) -> DataFrame:
    """``doc_id, text_hash, first, last`` of the repeated starts in the contexts."""
    columns, found = ["doc_id", "text_hash", "first", "last"], None
    for salt in range(1, rounds + 2):
        compared = written(_compared(contexts, buffer))
        own = compared.where("not over").select(*columns)
        found = own if found is None else found.union(own)
        over = compared.where("over")
        if over.isEmpty():
            return found
        contexts = _finer(over, salt)
    return found.union(_one_by_one(over))


def covered(n: int, starts: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that begin at the starts, given as first, last, first, last, ..."""
    spans: list[list[int]] = []
    for a, b in sorted(zip(starts[::2], starts[1::2], strict=True)):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + LENGTH)
        else:
            spans.append([a, b + LENGTH])
    return [(a, min(b, n)) for a, b in spans]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for span in spans for x in span], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buffer: int = BUFFER, rounds: int = 3) -> DataFrame:
    """``doc_id, text_hash, starts``: per document with any, first and last of each run of starts of repeated strings.

    Rows of one id and equal texts share an entry; ``text_hash`` is xxhash64 of the text.
    """
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    judged = written(_judged(_all_runs(whole)))
    wanted = judged.where(F.col("kind") > WHOLE).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("key", "first", "last", "kind")).alias("runs"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for owner, text_hash, own, text in zip(*[c.to_pylist() for c in batch.columns[:3]], batch.column(3).cast(pa.binary()).to_pylist(), strict=True):
                out += [(r["key"], owner, text_hash, r["first"], r["kind"] == SAMPLE, text[r["first"] : r["last"] + LENGTH]) for r in own]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _CONTEXT.types, strict=True)], schema=_CONTEXT)

    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    once = whole.join(wanted, same(whole, wanted)).select(wanted["doc_id"], wanted["text_hash"], "runs", "text")
    parts = _parts_found(once.mapInArrow(contexts, _CONTEXT_SQL), buffer, rounds)
    starts = judged.where(F.col("kind") != PARTIAL).select("doc_id", "text_hash", "first", "last").union(parts)
    return starts.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list(F.array("first", "last"))).alias("starts"))


def _with_starts(docs: DataFrame, starts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = starts.select(F.col("doc_id").alias("_dedup_id"), F.col("text_hash").alias("_dedup_hash"), F.col("starts").alias("_dedup_starts"))
    return docs.join(own, F.col(id_col).cast("long").eqNullSafe(F.col("_dedup_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_dedup_hash")), "left").drop("_dedup_id", "_dedup_hash")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buffer: int = BUFFER) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    A byte goes if a string of ``LENGTH`` bytes covers it that starts anywhere else too, be it in the same document or a copy
    row; strings are those of the input. A null text is empty. Null ids and repeated rows stay; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for owner, text, starts in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = covered(len(text), starts or [])
                kept = kept_bytes(text, spans)
                out.append((owner, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    joined = _with_starts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), repeated_starts(docs, id_col, text_col, buffer), "doc_id", "text")
    whole = joined.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "_dedup_starts")
    return whole.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buffer: int = BUFFER) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the texts; of a character of which bytes would stay, all stay. Null texts stay null."""
    joined = _with_starts(docs, repeated_starts(docs, id_col, text_col, buffer), id_col, text_col)
    place = joined.columns.index(text_col)
    names = [f"c{k}" for k in range(len(joined.columns))]
    schema = joined.drop("_dedup_starts").toDF(*names[:-1]).schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, starts in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(len(names) - 1).to_pylist(), strict=True):
                spans = [_to_characters(text, *span) for span in covered(len(text), starts)] if starts else []
                texts.append(None if text is None else kept_bytes(text, [s for s in spans if s[0] < s[1]]).decode())
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names[:-1])

    return joined.toDF(*names).mapInArrow(clean, schema).toDF(*docs.columns)


def _to_characters(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The span without the parts of characters at its ends."""
    while a < b and a < len(text) and text[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b
