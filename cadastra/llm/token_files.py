"""Token ids on disk in the fewest bits the vocabulary needs.

Format, version 1: a folder of Parquet files whose rows are blocks of whole documents, in ascending order of id:

* ``shard, block``: place of the block; blocks of a shard are numbered from 0, shards ascend with document ids;
* ``width``: bits of an id, the least that hold every id of the vocabulary;
* ``doc_ids, starts``: documents of the block and where each starts, in ids from the block's first; one start more ends it;
* ``shard_start``: ids of the shard before the block; ``n_ids``: ids in the block;
* ``payload``: ids, least significant bit first, without gaps.

Document k of a block has its ids in bits ``starts[k] * width`` to ``starts[k + 1] * width``: one numpy call unpacks any
document or range (``unpack``) and nothing before it is read. Parquet carries the blocks, so any store that Spark reaches will do.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra.llm.pieces import on_worker, vocabulary_text
from cadastra.llm.tables import slices, texts_of
from cadastra.session import work_dir

#: A block ends with the document that brings it to this many ids; a longer document has a block of its own.
BLOCK_IDS = 65_536
#: Pieces, and their words without marks, that a worker remembers in each of two generations. A known piece needs no word,
#: so the memory goes to the pieces.
REMEMBERED, WORDS = 500_000, 100_000

BLOCKS = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))]
    + [("shard_start", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]
)
BLOCKS_SQL = "shard int, block int, width int, doc_ids array<long>, starts array<long>, shard_start long, n_ids long, payload binary"


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids (unsigned 32-bit) in ``width`` bits each."""
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a payload, reading only the bytes that hold them."""
    first, last = start * width // 8, -(-stop * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first), bitorder="little")
    own = bits[start * width - first * 8 :][: (stop - start) * width].reshape(-1, width)
    wide = np.zeros((stop - start, 32), np.uint8)
    wide[:, :width] = own
    return np.packbits(wide.reshape(-1), bitorder="little").view("<u4")


def write_token_files(docs: DataFrame, vocabulary_path: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write them to ``path``, each document followed by ``end_id``.

    Documents go in ascending order of id; nulls first, equal ids in order of their texts. A null text is empty: its
    document holds the end id alone. An empty table gives a folder without blocks. Other columns are ignored.
    """
    vocabulary = vocabulary_text(vocabulary_path)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, shard = on_worker(vocabulary, REMEMBERED, WORDS), TaskContext.get().partitionId()
        width = max(pieces.size - 1, end_id, 1).bit_length()
        end = np.array([end_id], "<u4").tobytes()
        ids, owners, starts, before, block = [], [], [0], 0, 0

        def full() -> pa.RecordBatch:
            row = [shard, block, width, owners, starts, before, starts[-1], pack(np.frombuffer(b"".join(ids), "<u4"), width)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, BLOCKS.types, strict=True)], schema=BLOCKS)

        for batch in slices(batches):
            for owner, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                own = pieces.ids(text) + end
                ids.append(own)
                owners.append(owner)
                starts.append(starts[-1] + len(own) // 4)
                if starts[-1] >= BLOCK_IDS:
                    yield full()
                    ids, owners, starts, before, block = [], [], [0], before + starts[-1], block + 1
        if owners:
            yield full()

    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = whole.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCKS_SQL).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document of the files at ``path``, from the ids in them.

    ``start`` counts the ids of all documents before; the checksum is over the ids as little-endian unsigned 32 bits.
    """
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("own_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for row in batch.to_pylist():
                starts, width = row["starts"], row["width"]
                ids = unpack(row["payload"], width, 0, row["n_ids"])
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
                at = np.array(starts[:-1], np.int64)
                columns = [[row["shard"]] * len(sums), row["doc_ids"], at + row["shard_start"], np.diff(starts), sums]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    blocks = spark.read.schema(BLOCKS_SQL).parquet(path)
    found = blocks.mapInArrow(documents, "shard int, doc_id long, own_start long, n_tokens long, ids_crc32 long")
    # One row per shard: as many as the writer had partitions.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_first"))
    joined = found.join(F.broadcast(shards), "shard")
    return joined.select("doc_id", (F.col("shard_first") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary_path: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the files (to a new folder in the shared folder, unless ``path`` names one) and read them back."""
    spark = docs.sparkSession
    path = path or f"{work_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, vocabulary_path, path, end_id)
    return read_token_files(spark, path)
