"""Packing of documents into sequences by minimum bin slack.

Only the length of a piece matters to a bin, and a length is at most the bin's: what the method chooses from is a histogram
of ``size`` counts, whatever the number of documents. Per bin the longest length left opens it, and a subset-sum over
bitsets of reachable fillings finds the fullest combination of the lengths left. It is removed as often as the counts
allow, so one combination stands for many bins and each round uses up a length at least.

Spark counts the histogram and numbers the pieces of each length; the combinations come back as segments of those numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.pieces import on_worker, vocabulary_text
from cadastra.llm.ranked import ranked_on_worker
from cadastra.llm.tables import record, slices, texts_of
from cadastra.session import written

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    + [("shard", pa.int32()), ("nth", pa.int64())]
)
PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, shard int, nth long"


def cut_points(n: int, size: int) -> list[int]:
    """Starts of a document's pieces, and its end: whole pieces of ``size``, the first one shorter if ``size`` does not divide ``n``."""
    first = n % size or min(n, size)
    return [0, *range(first, n + 1, size)]


def token_pieces(docs: DataFrame, vocabulary_path: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, each numbered (``nth``) among those of its length in its task (``shard``)."""
    vocabulary = vocabulary_text(vocabulary_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ranked, shard = on_worker(vocabulary), ranked_on_worker(vocabulary), TaskContext.get().partitionId()
        end, met = np.array([end_id], "<u4").tobytes(), [0] * (size + 1)
        for batch in slices(batches):
            rows = []
            for owner, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids = memoryview((ranked.packed(text) if ranked.takes(text) else encoder.ids(text)) + end)
                points = cut_points(len(ids) // 4, size)
                for k, (a, b) in enumerate(zip(points, points[1:], strict=False)):
                    rows.append((owner, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), shard, met[b - a]))
                    met[b - a] += 1
            yield record(PIECES, *zip(*rows, strict=True))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES_SQL)


def fullest(counts: dict[int, int], size: int) -> list[tuple[int, int]]:
    """(length, times) of the fullest bin that holds the longest length left; of equally full ones that of the longest lengths."""
    longest = max(counts)
    room, mask = size - longest, (1 << (size - longest + 1)) - 1
    parts, reach, states = [], 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        times, step = min(counts[length] - (length == longest), room // length), 1
        while times > 0:  # 1, 2, 4, ... copies, so that every number of copies is a sum
            step = min(step, times)
            parts.append((length, step))
            states.append(reach)
            reach |= (reach << (length * step)) & mask
            times, step = times - step, step * 2
        if reach >> room & 1:
            break
    left, chosen = reach.bit_length() - 1, {longest: 1}
    for (length, step), before in zip(reversed(parts), reversed(states), strict=True):
        if not before >> left & 1:
            chosen[length] = chosen.get(length, 0) + step
            left -= length * step
    return sorted(chosen.items(), reverse=True)


def minimum_slack(histogram: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments (length, first number, end, first sequence, offset) covering every number of every length; number of sequences.

    The pieces of a length are numbered from 0; those of a segment go to consecutive sequences, at the same offset.
    """
    counts, used = {k: v for k, v in histogram.items() if v}, dict.fromkeys(histogram, 0)
    segments, sequences = [], 0
    while counts:
        bin_ = fullest(counts, size)
        copies, offset = min(counts[length] // times for length, times in bin_), 0
        for length, times in bin_:
            for _ in range(times):
                segments.append((length, used[length], used[length] + copies, sequences, offset))
                used[length] += copies
                offset += length
            counts[length] -= times * copies
            if not counts[length]:
                del counts[length]
        sequences += copies
    return segments, sequences


def pack_documents(docs: DataFrame, vocabulary_path: str, end_id: int, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece; sequences hold at most ``size`` tokens.

    Every document ends with ``end_id``; a null or empty text is that id alone. Documents longer than ``size`` are cut,
    no other. Repeated rows, null and repeated ids are packed as they stand. An empty table gives no row.
    """
    pieces = written(token_pieces(docs, vocabulary_path, end_id, size, id_col, text_col))
    classes = pieces.groupBy("shard", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in classes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    segments, _ = minimum_slack(histogram, size)
    length, first, end, sequence, offset = np.array(sorted(segments) or [[0] * 5], np.int64)[: len(segments)].T if segments else np.zeros((5, 0), np.int64)
    by_length = {int(x): slice(*np.searchsorted(length, [x, x + 1])) for x in np.unique(length)}

    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = pieces.join(classes.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), ["shard", "length"])
    schema = pa.schema([*[PIECES.field(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")], ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            ids, at = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            for x in np.unique(own):
                rows, part = np.flatnonzero(own == x), by_length[int(x)]
                k = np.searchsorted(first[part], number[rows], "right") - 1
                ids[rows] = sequence[part][k] + number[rows] - first[part][k]
                at[rows] = offset[part][k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(ids), pa.array(at)], schema=schema)

    wanted = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("number"))
    return wanted.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
