"""Alignment of two tokenizers over the same bytes, each distinct text once.

Documents are shuffled by their full text and counted, copies first within their task; what follows sees each distinct text
once, whatever the number of copies. A text is tokenised by A (byte-level BPE, with a space in front) and by B
(SentencePiece, which adds that space), and the byte offsets where tokens of both end cut them into groups. An A and a B
token whose byte ranges end together are linked.

Two tokens can end together only if the bytes of one end with those of the other. The vocabularies therefore bound the
different id pairs, whatever the corpus, by the number of suffixes of their tokens (``possible_pairs``). That bounded list is
broadcast, a text stores its links as places in it, pairs are counted in an array of that length per task, weighted by the
text's multiplicity, and the corpus-wide counts are broadcast again. Measures reach the documents by the text's SHA-256.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.pieces import vocabulary_text
from cadastra.llm.ranked import Ranked, bytes_of_ids
from cadastra.llm.tables import record, slices
from cadastra.session import written

MARK = "▁"
_WORKER: dict = {}
TEXTS = pa.schema(
    [("digest", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64())]
    + [("links", pa.binary()), ("groups_sha256", pa.string())]
)
TEXTS_SQL = "digest binary, copies long, n_a long, n_b long, n_groups long, links binary, groups_sha256 string"


def bytes_of_b(model: bytes) -> list[bytes]:
    """Bytes of each id of a SentencePiece model: the mark as a space, byte pieces as their byte."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    file = pb.ModelProto()
    file.ParseFromString(model)
    byte = pb.ModelProto.SentencePiece.BYTE
    return [bytes([int(p.piece[1:-1], 16)]) if p.type == byte else p.piece.replace(MARK, " ").encode() for p in file.pieces]


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted ``id of A << 32 | id of B`` of all tokens whose bytes end with the other's; at most one per suffix and spelling."""
    ids_a, ids_b = _by_bytes(a), _by_bytes(b)
    found = {(x, y) for t, xs in ids_a.items() for k in range(len(t)) for y in ids_b.get(t[k:], ()) for x in xs}
    found |= {(x, y) for t, ys in ids_b.items() for k in range(len(t)) for x in ids_a.get(t[k:], ()) for y in ys}
    return np.sort(np.array([x << 32 | y for x, y in found], np.int64))


def _by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
    ids: dict[bytes, list[int]] = {}
    for k, token in enumerate(tokens):
        if token:
            ids.setdefault(token, []).append(k)
    return ids


@dataclass(frozen=True, eq=False)
class Vocabularies:
    """Both vocabularies and their possible pairs, read on the driver and broadcast; their size does not depend on the corpus."""

    key: str
    a: str
    b: bytes
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    pairs: np.ndarray

    @staticmethod
    def read(path_a: str, path_b: str) -> Vocabularies:
        a = vocabulary_text(path_a)
        with open(path_b, "rb") as file:
            b = file.read()
        bytes_a, bytes_b = bytes_of_ids(a), bytes_of_b(b)
        key = hashlib.sha256(a.encode() + b).hexdigest()
        return Vocabularies(key, a, b, bytes_a, bytes_b, possible_pairs(bytes_a, bytes_b))


class Aligner:
    """Both vocabularies in one worker process. A's ids come from its ranks where that is safe (``ranked``), else from its library."""

    def __init__(self, vocabularies: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(vocabularies.a)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._ranked = Ranked(vocabularies.a, special_strings=False)
        self._b = SentencePieceProcessor(model_proto=vocabularies.b)
        self._bytes = vocabularies.bytes_a, vocabularies.bytes_b
        self._size = [np.array([len(t) for t in tokens], np.int64) for tokens in self._bytes]
        self._pairs = vocabularies.pairs
        #: Ids of A before another of A, ids of A at their group's end, the same of B.
        self._shown = [f"{k}{sign}" for ids, signs in zip(self._bytes, (",|", ",;"), strict=True) for sign in signs for k in range(len(ids))]

    def align_all(self, texts: list[str]) -> list[tuple[int, int, int, bytes, str]]:
        """(tokens of A, of B, groups, links as packed places among the possible pairs, digest of the groups) per text."""
        of_a, of_b = self.encode_a([" " + t for t in texts]), self._b.encode(texts, num_threads=1)
        return [self.align(t, a, b) for t, a, b in zip(texts, of_a, of_b, strict=True)]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [self._ranked.ids(t) if self._ranked.takes(t) else self._a.encode(t, add_special_tokens=False).ids for t in texts]

    def align(self, text: str, a: list[int], b: list[int]) -> tuple[int, int, int, bytes, str]:
        whole = (" " + text).encode()
        if not text or any(b"".join(map(tokens.__getitem__, ids)) != whole for tokens, ids in zip(self._bytes, (a, b), strict=True)):
            return 0, 0, 0, b"", ""
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        _, last_a, last_b = np.intersect1d(np.cumsum(self._size[0][ids_a]), np.cumsum(self._size[1][ids_b]), assume_unique=True, return_indices=True)
        links = np.searchsorted(self._pairs, ids_a[last_a] << 32 | ids_b[last_b])
        return len(a), len(b), len(last_a), links.astype("<u4").tobytes(), self._digest(ids_a, ids_b, last_a, last_b)

    def _digest(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``; each id is written with the sign behind it."""
        in_group = [np.diff(last, prepend=-1) for last in (last_a, last_b)]
        before = [np.cumsum(in_group[1]) - in_group[1], np.cumsum(in_group[0])]
        places = [np.arange(len(ids)) + np.repeat(other, own) for ids, own, other in zip((a, b), in_group, before, strict=True)]
        n_a, n_b = map(len, self._size)
        shown = np.empty(len(a) + len(b), np.int64)
        shown[places[0]], shown[places[1]] = a, b + 2 * n_a
        shown[places[0][last_a]] += n_a
        shown[places[1][last_b]] += n_b
        return hashlib.sha256("".join(map(self._shown.__getitem__, shown.tolist()))[:-1].encode()).hexdigest()


def _on_worker(vocabularies: Vocabularies) -> Aligner:
    if vocabularies.key not in _WORKER:
        _WORKER[vocabularies.key] = Aligner(vocabularies)
    return _WORKER[vocabularies.key]


def aligned_texts(docs: DataFrame, vocabularies, text_col: str = "text") -> DataFrame:
    """Each distinct non-empty text once: its digest, number of copies, counts, links and digest of the groups."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _on_worker(vocabularies.value)
        for batch in slices(batches):
            n_a, n_b, groups, links, digests = zip(*aligner.align_all(batch.column(0).to_pylist()), strict=True)
            yield record(TEXTS, batch.column(2), batch.column(1), n_a, n_b, groups, links, digests)

    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text <> ''")
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies"))
    return distinct.select("text", "copies", F.unhex(F.sha2("text", 256)).alias("digest")).mapInArrow(align, TEXTS_SQL)


def pair_counts(aligned: DataFrame, pairs: int) -> DataFrame:
    """``pair, n``: links of each possible pair (by its place) over all copies of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs, np.int64)
        for batch in batches:
            for links, copies in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pair, times = np.unique(np.frombuffer(links, "<u4"), return_counts=True)
                total[pair] += times * copies
        met = np.flatnonzero(total)
        for at in range(0, len(met), 65_536):
            part = met[at : at + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], names=["pair", "n"])

    counted = aligned.select("links", "copies").mapInArrow(count, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``.

    Null and empty texts, and texts that the ids of either tokenizer do not give back, have no tokens: zeros and the empty
    digest; their links count nowhere. Repeated rows, null and repeated ids each give their row and count as copies of
    their text. An empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    vocabularies = Vocabularies.read(path_a, path_b)
    pairs, shared = vocabularies.pairs, spark.sparkContext.broadcast(vocabularies)
    aligned = written(aligned_texts(docs, shared, text_col))

    counted = pair_counts(aligned, len(pairs)).toArrow()  # at most one row per possible pair
    counts = np.zeros(len(pairs), np.int64)
    counts[counted.column("pair").to_numpy()] = counted.column("n").to_numpy()
    of_b = pairs & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, of_b, counts)
    table = spark.sparkContext.broadcast((counts, counts == highest[of_b]))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([("digest", pa.binary()), ("groups_sha256", pa.string()), *[(n, pa.int64()) for n in names]])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = table.value
        for batch in batches:
            links = [np.frombuffer(x, "<u4") for x in batch.column(5).to_pylist()]
            sums = [len(x) for x in links], [int(best[x].sum()) for x in links], [int(n[x].sum()) for x in links]
            yield record(schema, *batch.columns[:5], *sums)

    stored = aligned.select("digest", "groups_sha256", "n_a", "n_b", "n_groups", "links")
    measures = stored.mapInArrow(measure, "digest binary, groups_sha256 string, " + ", ".join(f"{n} long" for n in names))
    digest = F.coalesce(F.unhex(F.sha2(F.col(text_col).cast("string"), 256)), F.unhex(F.md5(F.col(id_col).cast("string"))))  # null texts spread and match nothing
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"))
    zero = [F.coalesce(n, F.lit(0)).alias(n) for n in names]
    return rows.join(measures, "digest", "left").select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
