"""Improbable-feature digests: the rarest byte windows of a text in a chain of Bloom filters (after Roussev, 2010).

* A feature is a window of ``FEATURE`` bytes. Its entropy falls into one of ``CLASSES`` classes; how often the whole corpus
  shows a class ranks it, the rarest first. Nearly uniform windows (class under ``WEAKEST``) are never features.
* Each feature is the leftmost rarest of so many of the runs of ``RUN`` features that hold it: its popularity. Features with
  a popularity of ``POPULAR`` are selected; a text without any selects its most popular ones, and a text without windows
  or with weak ones only is one feature itself.
* Selected features, each once, go into filters of ``FILTER_BITS`` bits by five hashes, ``FILTER_FEATURES`` to a filter.
* Likeness: bits that two filters share, less what chance gives, over the most they could share; for each filter of the
  shorter digest the best of the other's, averaged.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.tables import slices, texts_of, utf8_of

FEATURE, RUN, POPULAR = 64, 64, 16
CLASSES, WEAKEST = 1000, 100
FILTER_BITS, FILTER_FEATURES, HASHES = 2048, 160, 5
#: Share of the span between chance and a full match that counts as chance still.
CUTOFF = 0.05
#: Bytes worked on at a time; longer texts go in overlapping parts.
PART = 1 << 20

_SCALE = 1 << 20
_SUMMAND = np.array([round(c * np.log2(max(c, 1)) * _SCALE) for c in range(FEATURE + 1)], np.int64)
_LEAVES = np.append(0, _SUMMAND[1:] - _SUMMAND[:-1])  # of a byte that is there n times
_MOST = _SUMMAND[FEATURE]


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class of the entropy of each window of ``FEATURE`` bytes, in order; exact sums, so equal windows get equal classes."""
    n = len(data) - FEATURE + 1
    if n < 1:
        return np.zeros(0, np.int64)
    earlier, later = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lag in range(1, FEATURE):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        earlier[lag:] += same
        later[:-lag] += same
    total = np.empty(n, np.int64)
    total[0] = _SUMMAND[np.bincount(data[:FEATURE], minlength=256)].sum()
    total[1:] = _LEAVES[earlier[FEATURE:].astype(np.intp) + 1] - _LEAVES[later[: n - 1].astype(np.intp) + 1]
    return (_MOST - np.cumsum(total)) * (CLASSES - 1) // _MOST


def _joined(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int, int, int]], np.ndarray]]:
    """Groups of about ``PART`` bytes: (text, start, first and end of the own windows) of each part of a text, and the bytes.

    Parts of a long text overlap by the bytes that the popularity of a window depends on.
    """
    parts, chunks, size = [], [], 0
    margin = 2 * RUN + FEATURE
    for k, text in enumerate(texts):
        for a in range(0, max(len(text) - FEATURE + 1, 0), PART):
            b = min(a + PART, len(text) - FEATURE + 1)
            low, high = max(a - margin, 0), min(b + margin, len(text))
            parts.append((k, size, size + a - low, size + b - low))
            chunks.append(text[low:high])
            size += high - low
            if size >= PART:
                yield parts, np.frombuffer(b"".join(chunks), np.uint8)
                parts, chunks, size = [], [], 0
    if parts:
        yield parts, np.frombuffer(b"".join(chunks), np.uint8)


def class_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(CLASSES, np.int64)
    for parts, data in _joined(texts):
        classes = entropy_classes(data)
        for _, _, first, end in parts:
            counts += np.bincount(classes[first:end], minlength=CLASSES)
    return counts


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, the rarest 1; 0 for classes that are no features. Of equally frequent ones the lower entropy is rarer."""
    order = np.lexsort((np.arange(CLASSES), counts))
    found = np.empty(CLASSES, np.int64)
    found[order] = np.arange(1, CLASSES + 1)
    found[:WEAKEST] = 0
    return found


def _hashes(windows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of ``FEATURE`` bytes."""
    words, found = np.ascontiguousarray(windows).view("<u8"), np.full(len(windows), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        found = (found ^ words[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ found >> np.uint64(29)


def features(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Hashes of the selected features of each text, in order of their first place, each once."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    never = np.int64(np.iinfo(np.int64).max)
    for parts, data in _joined(texts):
        own = np.zeros(len(data), bool)
        for (_, start, *_), end in zip(parts, [*[p[1] for p in parts[1:]], len(data)], strict=True):
            own[start : end - FEATURE + 1] = True
        place = np.full(len(data), never)
        own_rank = np.zeros(len(data), np.int64)
        own_rank[: len(data) - FEATURE + 1] = rank[entropy_classes(data)]
        at = np.flatnonzero(own & (own_rank > 0))
        place[at] = own_rank[at] << 32 | at
        best, width = place, 1
        while width < RUN:  # least of runs of twice the width
            best, width = np.minimum(best, np.append(best[width:], np.full(width, never))), width * 2
        chosen = best[own & (best != never)] & 0xFFFFFFFF
        popular = np.bincount(chosen, minlength=len(data))
        for k, _, first, end in parts:
            most = popular[first:end].max()
            if most:
                selected = first + np.flatnonzero(popular[first:end] >= min(POPULAR, most))
                found[k].append(_hashes(data[selected[:, None] + np.arange(FEATURE)]))
    every = []
    for text, parts_ in zip(texts, found, strict=True):
        hashes = np.concatenate(parts_) if parts_ else np.array([xxhash.xxh64_intdigest(text)] if text else [], np.uint64)
        _, first = np.unique(hashes, return_index=True)
        every.append(hashes[np.sort(first)])
    return every


def filters(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters, one row of bytes each; none without features."""
    n = len(hashes)
    bits = np.zeros((-(-n // FILTER_FEATURES), FILTER_BITS), np.uint8)
    for k in range(HASHES):
        bits[np.arange(n) // FILTER_FEATURES, (hashes >> np.uint64(11 * k)).astype(np.int64) & FILTER_BITS - 1] = 1
    return np.packbits(bits, axis=1)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 to 1 for two digests (features, filters); 1 for equal ones, two empty ones included."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0
    if not a[0] or not b[0]:
        return 0.0
    (n, short), (m, long_) = (a, b) if len(a[1]) <= len(b[1]) else (b, a)
    n_own = np.minimum(n - FILTER_FEATURES * np.arange(len(short)), FILTER_FEATURES)[:, None]
    m_own = np.minimum(m - FILTER_FEATURES * np.arange(len(long_)), FILTER_FEATURES)[None, :]
    set_short, set_long = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (short, long_))
    shared = np.stack([np.bitwise_count(row & long_).sum(axis=1, dtype=np.int64) for row in short])
    unset = 1 - 1 / FILTER_BITS
    chance = FILTER_BITS * (1 - unset ** (HASHES * n_own) - unset ** (HASHES * m_own) + unset ** (HASHES * (n_own + m_own)))
    most = np.minimum(set_short[:, None], set_long[None, :]).astype(float)
    least = np.minimum(CUTOFF * (most - chance) + chance, most - 1)
    return float(np.clip((shared - least) / (most - least), 0, 1).max(axis=1).mean())


def shown(digest: tuple[int, np.ndarray]) -> str:
    """Number of features and the filters, as text."""
    return f"{digest[0]}:{base64.b64encode(digest[1].tobytes()).decode()}"


def digests(texts: list[bytes], rank: np.ndarray) -> list[tuple[int, np.ndarray]]:
    return [(len(h), filters(h)) for h in features(texts, rank)]


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Ranks from the entropy classes of all windows of all texts; a task reports ``CLASSES`` counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for batch in slices(batches):
            counts += class_counts(utf8_of(batch.column(0)))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["class", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES, np.int64)
    for row in found.collect():  # one row per class
        counts[row["class"]] = row["n"]
    return ranks(counts)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``bucket, borrowed, doc_id, text``: buckets of whole texts that go down from the greatest id, sorted in their tasks.

    Behind the rows of a bucket stands a copy of the next bucket's first row (``borrowed``), behind the last bucket's the
    very first: every text meets its successor, though each travels once. The driver sees a few numbers per bucket. Equal
    ids go by their texts, null ids last.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(ids.where("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n))), reverse=True) if n > 1 else []
    edges = -np.array(bounds, float)

    def bucket_of(column: pa.Array) -> np.ndarray:
        found = np.array([np.inf if x is None else -float(x) for x in column.to_pylist()], float)
        return np.searchsorted(edges, found, "right").astype(np.int64)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch.column(0))), batch.column(0)], names=["bucket", "doc_id"])

    firsts = ids.mapInArrow(numbered, "bucket long, doc_id long").groupBy("bucket").agg(F.max("doc_id").alias("first")).orderBy("bucket").collect()
    lent = {r.first: firsts[k - 1].bucket for k, r in enumerate(firsts)} if firsts else {}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buckets, owners = bucket_of(batch.column(0)), batch.column(0).to_pylist()
            rows = [k for k, x in enumerate(owners) if x in lent]
            take = pa.array([*range(len(owners)), *rows], pa.int64())
            where = pa.array([*buckets.tolist(), *[lent[owners[k]] for k in rows]], pa.int64())
            borrowed = pa.array([False] * len(owners) + [True] * len(rows))
            yield pa.RecordBatch.from_arrays([where, borrowed, batch.column(0).take(take), batch.column(1).take(take)], names=["bucket", "borrowed", "doc_id", "text"])

    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    copies = whole.mapInArrow(dealt, "bucket long, borrowed boolean, doc_id long, text string")
    return copies.repartition(max(1, n // 4), "bucket").sortWithinPartitions("bucket", "borrowed", F.desc_nulls_last("doc_id"), "text")


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) of a text's code points replaced by as many of the following text's first, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row of ``docs``.

    The edited text takes its end from the next document by descending id, after the last the first. A null text is empty:
    no features, fingerprint ``0:``. A single row is its own successor. Equal ids follow each other by their texts.
    Repeated rows stay; an empty table gives none; other columns are ignored.
    """
    rank = corpus_ranks(docs, text_col)
    columns = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    schema = pa.schema([*columns, ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row met, with its digest; it waits for its successor
        for batch in slices(batches, 128):
            texts = texts_of(batch.column(3))
            raw = [t.encode() for t in texts]
            rows = list(zip(*[c.to_pylist() for c in batch.columns[:3]], texts, digests(raw, rank), strict=True))
            pairs = [(a, b) for a, b in zip([held, *rows], rows, strict=False) if a and a[0] == b[0] and not a[1]]
            edited = [edited_text(a[3], b[3]).encode() for a, b in pairs]
            out = []
            for (a, b), e, own in zip(pairs, edited, digests(edited, rank), strict=True):
                sha = hashlib.sha256(e).hexdigest()
                out.append((a[2], len(a[3]), sha, shown(a[4]), shown(own), likeness(a[4], own), likeness(a[4], b[4])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
            held = rows[-1] if rows else held

    types = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, id_col, text_col).mapInArrow(compare, types)
