"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import byte_bpe, sql
from cadastra.llm.alignment import align_documents
from cadastra.llm.bloom_digest import fingerprint_documents
from cadastra.llm.hard_negatives import hard_negatives
from cadastra.llm.html_text import extract_pages
from cadastra.llm.packing import pack_documents
from cadastra.llm.quality_rules import quality_verdicts
from cadastra.llm.secret_scan import scan
from cadastra.llm.shared_viterbi import round_trip
from cadastra.llm.simhash import near_duplicates
from cadastra.llm.suffix_dedup import deduplicated
from cadastra.llm.tables import ship, table
from cadastra.llm.token_counts import count_tokens
from cadastra.llm.token_files import token_files

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op7_quality_rules": sql.quality_verdicts(), "op11_hard_negatives": sql.hard_negatives()}


def query(run: Callable[[SparkSession, str], DataFrame]):
    def on_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = on_workers
    return run


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), END_ID)


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), END_ID)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))
