"""Token counts by a map-side lookup in two tiers: no pre-token is shuffled to be counted.

Tier one is a hash table from the corpus's most frequent pieces to their number of tokens, broadcast to all workers. Its
size is bounded by ``TABLE_PIECES`` pieces of at most ``LONGEST_KEPT`` characters. Tier two is a memory of each worker for
the rest, filled by the tokenizers library. Which pieces are in the table changes the speed only, never a count.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.pieces import LONGEST_KEPT, on_worker, vocabulary_text
from cadastra.llm.tables import record, slices, texts_of

#: Pieces in the broadcast table, and pieces each task reports as frequent.
TABLE_PIECES, TASK_PIECES = 65_536, 8_192


def frequent_pieces(docs: DataFrame, vocabulary: str, text_col: str = "text", n: int = TABLE_PIECES) -> dict[str, int]:
    """The ``n`` most frequent pieces of all texts (by summaries of ``TASK_PIECES`` pieces a task) with their tokens.

    Pieces over ``LONGEST_KEPT`` are not counted at all, so that texts without spaces don't fill a task's memory.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = on_worker(vocabulary), Counter()
        top = lambda k: heapq.nlargest(k, seen.items(), key=lambda x: (x[1], x[0]))
        for batch in slices(batches):
            for text in texts_of(batch.column(0)):
                seen.update([p for p in pieces.split(text) if len(p) <= LONGEST_KEPT])
            if len(seen) > 16 * TASK_PIECES:
                seen = Counter(dict(top(4 * TASK_PIECES)))
        found = top(TASK_PIECES)
        yield record(pa.schema([("piece", pa.string()), ("n", pa.int64())]), [p for p, _ in found], [c for _, c in found])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(summary, "piece string, n long")
    rows = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(n).collect()
    pieces = on_worker(vocabulary)
    return {r.piece: len(pieces.packed[r.piece]) // 4 for r in rows}


class TwoTier(dict):
    """The broadcast table; what it lacks comes from the worker's memory and is not added."""

    def __init__(self, frequent: dict[str, int], pieces):
        super().__init__(frequent)
        self._rest = pieces.packed

    def __missing__(self, piece: str) -> int:
        return len(self._rest[piece]) // 4


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``; other columns are dropped.

    Tokens are those of the library for the whole text, without added begin or end; special strings inside a text are
    taken as the library takes them. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows, null ids and
    repeated ids each give their row. An empty table gives none.
    """
    vocabulary = vocabulary_text(vocabulary_path)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, vocabulary, text_col))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = on_worker(vocabulary)
        lookup = TwoTier(frequent.value, pieces).__getitem__
        for batch in slices(batches):
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            tokens = [sum(map(lookup, pieces.split(t))) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(tokens, pa.int64())], schema=schema)

    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = whole.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
