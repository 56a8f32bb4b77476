"""The corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All but the last return the columns
of ``documents``, with ``n_chars`` counted anew where the text changed; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.packing import pack_documents
from cadastra.llm.quality_rules import keep_good
from cadastra.llm.queries import BYTE_BPE, END_ID
from cadastra.llm.secret_scan import redact
from cadastra.llm.simhash import keep_one
from cadastra.llm.suffix_dedup import without_repeats
from cadastra.llm.tables import ship, table
from cadastra.session import written


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; that of a null text stays."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document of the least id stays."""
    ship(spark)
    return keep_one(docs, shingle=4, distance=4)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start at more than one place go out of the texts; documents stay."""
    ship(spark)
    return _counted(without_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; documents stay."""
    return _counted(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    ship(spark)
    return pack_documents(docs, public_tokenizers.path(BYTE_BPE), END_ID)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: Stages that train a model, hash with XXH64 or call a tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
