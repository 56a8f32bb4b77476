"""Byte-level BPE by an automaton of all tokens, with the exact result of the merges, and decoding.

Bytes are mapped to the Latin-1 characters of the same number, so that an Aho-Corasick automaton over characters finds the
longest token at every byte. A sequence of tokens is what the merges give if and only if every two neighbours stay apart
when merged alone; that is remembered for each pair. The words of a batch that no worker memory holds run through the
automaton together, longest match after longest match. Those whose neighbours all stay apart are done; in the others the
search goes back to the next shorter token that fits. A prefix of a word has one valid last token, so an end that led
nowhere is never tried again and the search is linear.

Words are the matches of the splitting pattern. A text is first cut before every space that a non-space follows, which is
always a border of two words, and the worker remembers the ids of such pieces.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.pieces import Memory
from cadastra.llm.pieces import packed as packed_ids
from cadastra.llm.tables import record, slices, texts_of

#: Pieces a worker remembers in each of two generations: a new one costs some twenty times a known one.
REMEMBERED = 800_000
#: A character no byte maps to.
BORDER = "Ā"
_BEFORE_WORD = re.compile(r"(?= \S)")
_WORKER: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks (which are their ids) from a .tiktoken file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@dataclass(frozen=True, eq=False)
class Merges:
    """Tokens by id, and for each its two halves in the merges: -1 for single bytes, -2 where no merges make the token.

    Made on the driver once; its size is that of the vocabulary.
    """

    key: str
    pattern: str
    tokens: list[bytes | None]
    left: list[int]
    right: list[int]

    @staticmethod
    def read(path: str, pattern: str) -> Merges:
        ranks = read_ranks(path)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for every byte")
        tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        made = Merges(hashlib.sha256(repr((pattern, tokens)).encode()).hexdigest(), pattern, tokens, [-2] * len(tokens), [-2] * len(tokens))
        pairs = Pairs(made, ranks)
        for rank in sorted(ranks.values()):
            token = tokens[rank]
            if len(token) == 1:
                made.left[rank] = made.right[rank] = -1
                continue
            for at in range(1, len(token)):
                a, b = ranks.get(token[:at], rank), ranks.get(token[at:], rank)
                if a < rank and b < rank and made.left[a] != -2 and made.left[b] != -2 and pairs.apart(a, b, rank):
                    made.left[rank], made.right[rank] = a, b
                    break
        return made


class Pairs:
    """Which two tokens stay apart."""

    def __init__(self, merges: Merges, ranks: dict[bytes, int]):
        self.tokens, self.left, self.right, self.ranks = merges.tokens, merges.left, merges.right, ranks
        self.known = Memory(lambda pair: self.apart(pair >> 32, pair & 0xFFFFFFFF), 1_000_000)

    def apart(self, a: int, b: int, before: float = float("inf")) -> bool:
        """Whether merges of ranks under ``before`` leave the neighbours ``a`` and ``b`` as they are.

        Their last merges are undone one by one, the latest first, down to the bytes on both sides of the border. Two parts
        that meet there live side by side until the merge undone last; a merge of the two that comes earlier joins them.
        Of equal ranks the leftmost goes first: that of ``a`` before one across the border, that one before ``b``'s.
        """
        tokens, ranks = self.tokens, self.ranks
        while True:
            if ranks.get(tokens[a] + tokens[b], before) < before:
                return False
            whole_a, whole_b = self.left[a] == -1, self.left[b] == -1
            if whole_a and whole_b:
                return True
            if whole_b or (not whole_a and a > b):
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]


class ByteBpe:
    """Encodes and decodes by ``Merges``; one per worker process."""

    def __init__(self, merges: Merges):
        import ahocorasick
        import regex

        self.tokens = [t or b"" for t in merges.tokens]
        self.ranks = {t: k for k, t in enumerate(merges.tokens) if t is not None}
        self.apart = Pairs(merges, self.ranks).known
        self.split = regex.compile(merges.pattern).findall
        made = [k for k, half in enumerate(merges.left) if half != -2]
        latin = {self.tokens[k].decode("latin-1"): k for k in made}
        self.automaton = ahocorasick.Automaton()
        for token, k in latin.items():
            self.automaton.add_word(token, k)
        self.automaton.make_automaton()
        self.packed = [*(struct.pack("<I", k) for k in range(len(self.tokens))), b""]
        self.size = [len(t) for t in self.tokens]
        #: The longest token that a token starts with, itself aside; -1 for single bytes.
        self.shorter = dict.fromkeys(made, -1)
        for token, k in latin.items():
            self.shorter[k] = next((latin[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in latin), -1)
        self.pieces = Memory(lambda piece: self.encode_pieces([piece])[0], REMEMBERED)

    def back_track(self, word: str) -> list[int]:
        """Ids of one word (bytes as Latin-1) from the longest matches, going back where neighbours do not stay apart."""
        size, apart, shorter = self.size, self.apart, self.shorter
        longest = [0] * len(word)
        for end, token in self.automaton.iter(word):
            longest[end + 1 - size[token]] = token  # ends ascend: the longest comes last
        ids: list[int] = []
        dead, at, token = set(), 0, longest[0]
        while True:
            end = at + size[token]
            if end not in dead and (not ids or apart[ids[-1] << 32 | token]):
                ids.append(token)
                if end == len(word):
                    return ids
                at, token = end, longest[end]
                continue
            while (token := shorter[token]) < 0:
                dead.add(at)
                token = ids.pop()
                at -= size[token]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; all of them run through the automaton together."""
        if not words:
            return []
        whole = [self.ranks.get(w, -1) for w in words]  # a word that is a token is that token
        rest = [k for k, rank in enumerate(whole) if rank < 0]
        found = [self.packed[rank] for rank in whole]
        if not rest:
            return found
        latin = [words[k].decode("latin-1") for k in rest]
        matches = np.array(list(self.automaton.iter_long(BORDER.join(latin))), np.int64)
        borders = np.cumsum([len(w) + 1 for w in latin])
        word = np.searchsorted(borders, matches[:, 0], "right")
        ids = matches[:, 1]
        pairs, place = np.unique(ids[:-1] << 32 | ids[1:], return_inverse=True)
        inside = word[:-1] == word[1:]
        asked = np.unique(place[inside])
        fits = np.ones(len(pairs), bool)
        fits[asked] = [self.apart[p] for p in pairs[asked].tolist()]
        wrong = set(word[:-1][inside & ~fits[place]].tolist())
        packed, first = ids.astype("<u4").tobytes(), np.searchsorted(word, np.arange(len(rest) + 1)).tolist()
        for n, k in enumerate(rest):
            found[k] = packed_ids(self.back_track(latin[n])) if n in wrong else packed[4 * first[n] : 4 * first[n + 1]]
        return found

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        split = [[w.encode() for w in self.split(p)] for p in pieces]
        words = list(set().union(*split))
        ids = dict(zip(words, self.encode_words(words), strict=True))
        return [b"".join(map(ids.__getitem__, parts)) for parts in split]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts (little-endian unsigned 32-bit); pieces the worker has not met lately are encoded together."""
        cut = [_BEFORE_WORD.split(t) if t else [] for t in texts]
        latest, older = self.pieces, self.pieces.older
        ids = {p: latest.get(p) or older.get(p) for p in set().union(*cut)}
        new = [p for p, known in ids.items() if known is None]
        ids |= zip(new, self.encode_pieces(new), strict=True)
        for piece, found in ids.items():
            if piece not in latest:
                latest.put(piece, found)
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def on_worker(merges: Merges) -> ByteBpe:
    """One ``ByteBpe`` per vocabulary and worker process, kept from task to task."""
    if merges.key not in _WORKER:
        _WORKER[merges.key] = ByteBpe(merges)
    return _WORKER[merges.key]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 32-bit) per row of ``docs``; a null or empty text has no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Merges.read(path, pattern))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = on_worker(shared.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder.encode_all(texts_of(batch.column(1))), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, content`` (the bytes) per row of packed ids; null ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(Merges.read(path, pattern))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = on_worker(shared.value)
        for batch in slices(batches):
            content = [decoder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], names=["doc_id", "content"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(decode, "doc_id long, content binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row of ``docs``: digests of its ids, and of the bytes decoded from them.

    A null text is empty: no tokens, the digests of nothing. Special strings inside texts are plain text. Repeated rows,
    null and repeated ids each give their row; an empty table gives none; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Merges.read(path, pattern))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = on_worker(shared.value)
        for batch in slices(batches):
            ids = coder.encode_all(texts_of(batch.column(1)))
            digests = [hashlib.sha256(x).hexdigest() for x in ids]
            decoded = [hashlib.sha256(coder.decode(x)).hexdigest() for x in ids]
            yield record(schema, batch.column(0), [len(x) // 4 for x in ids], digests, decoded)

    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return whole.mapInArrow(both, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
