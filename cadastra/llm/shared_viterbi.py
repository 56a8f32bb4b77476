"""SentencePiece encoding with forward states shared between words, and decoding.

White space is marked (U+2581) and no piece holds a mark behind another character, so words that start at a mark are encoded
on their own; a line feed is no part of any piece and stands alone. The distinct words of a batch are sorted, which is the
depth-first order of their trie: the forward states of a word's prefix are those left by the word before it.

* Unigram vocabularies: the state of a prefix is the best sum of scores and the piece that ends there (Viterbi).
* BPE vocabularies, as the public one is: summed scores are not what the library maximises, so the state is the piece that
  ends the prefix's own merge result. Exactly one candidate is admissible after the state before it: the one whose pair with
  it the merges leave apart. (A segmentation is the merge result if and only if each pair of neighbours is.) Pairs are remembered.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.pieces import Memory
from cadastra.llm.tables import slices, texts_of

MARK = "▁"
_WORD = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_WORKER: dict = {}
#: Texts whose new words are sorted together: the more of them, the more prefixes are shared.
BATCH_ROWS = 1024
#: Distinct words a worker remembers in each of two generations: a word met again costs a look-up, a new one its merges.
REMEMBERED_WORDS = 400_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores by id; ``kind`` is bpe or unigram. Byte pieces are None among the pieces."""

    kind: str
    pieces: tuple[str | None, ...]
    scores: tuple[float, ...]
    first_byte: int | None
    unknown: int

    @staticmethod
    def read(path: str) -> Vocabulary:
        """From a .model file; only identity normalisation with a space put in front, as the marks need it."""
        from sentencepiece import sentencepiece_model_pb2 as model

        file = model.ModelProto()
        with open(path, "rb") as source:
            file.ParseFromString(source.read())
        rules, kinds = file.normalizer_spec, model.ModelProto.SentencePiece
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces:
            raise ValueError("only vocabularies without normalisation and with a space in front are supported")
        if any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece or p.type == kinds.USER_DEFINED for p in file.pieces):
            raise ValueError("pieces across words and user-defined pieces are not supported")
        pieces = tuple(p.piece if p.type == kinds.NORMAL else None for p in file.pieces)
        bytes_at = [k for k, p in enumerate(file.pieces) if p.type == kinds.BYTE]
        kind = "bpe" if file.trainer_spec.model_type == model.TrainerSpec.BPE else "unigram"
        unknown = next(k for k, p in enumerate(file.pieces) if p.type == kinds.UNKNOWN)
        return Vocabulary(kind, pieces, tuple(p.score for p in file.pieces), bytes_at[0] if bytes_at else None, unknown)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.of = {p: k for k, p in enumerate(vocabulary.pieces) if p is not None}
        self.vocabulary, self.longest = vocabulary, max(map(len, self.of), default=1)
        #: An unknown character is the state -1 - its code point; it never joins a neighbour.
        self._apart = Memory(lambda pair: self._stay(pair >> 32, pair & 0xFFFFFFFF), 500_000)
        #: When a piece is made: the better its score, the earlier; equal scores at the same time.
        order = {score: k for k, score in enumerate(sorted({vocabulary.scores[k] for k in self.of.values()}, reverse=True))}
        self._made = [order.get(score, -1) for score in vocabulary.scores]
        self._halves: dict[str, tuple[str, str] | None] = {}
        #: Lengths of the pieces of two characters or more, longest first, by their last two characters.
        lengths: dict[str, set[int]] = {}
        for piece in self.of:
            lengths.setdefault(piece[-2:], set()).add(len(piece))
        self._lengths = {end: sorted(n, reverse=True) for end, n in lengths.items() if len(end) == 2}
        self._below = min(vocabulary.scores, default=0.0) - 10.0
        self.words = Memory(lambda word: next(self.encoded([word])), REMEMBERED_WORDS)
        texts = [(p or "").replace(MARK, " ").encode() for p in vocabulary.pieces]
        if vocabulary.first_byte is not None:
            texts[vocabulary.first_byte : vocabulary.first_byte + 256] = [bytes([b]) for b in range(256)]
        texts[vocabulary.unknown] = " ⁇ ".encode()
        self._spelt = texts

    def _text(self, state: int) -> str:
        return chr(-1 - state) if state < 0 else self.vocabulary.pieces[state]

    def merged(self, text: str) -> list[int]:
        """Plain merges of a short text: again and again the neighbours with the best joined score, the leftmost of equals."""
        parts, scores = list(text), self.vocabulary.scores
        while True:
            joined = [(-scores[self.of[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.of]
            if not joined:
                return [self.of.get(p, -1 - ord(p[0])) for p in parts]
            k = min(joined)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts the merges make a piece from last; None for a single character and for what they never make."""
        if len(piece) == 1:
            return None
        if piece not in self._halves:
            made = self._made[self.of[piece]]
            self._halves[piece] = next(
                (
                    (a, b)
                    for a, b in ((piece[:k], piece[k:]) for k in range(1, len(piece)))
                    if all(len(x) == 1 or x in self.of and self._made[self.of[x]] < made and self.halves(x) for x in (a, b)) and self._neighbours(a, b, made)
                ),
                None,
            )
        return self._halves[piece]

    def _neighbours(self, a: str, b: str, before: float = float("inf")) -> bool:
        """Whether merges that come before ``before`` leave the parts ``a`` and ``b`` side by side.

        Their last merges are undone, the latest first, along the border. Two parts that meet there stand until the merge
        undone last, so a merge of the two that comes earlier joins them; of equal ones the leftmost comes first.
        """
        of, made = self.of, self._made
        while True:
            joined = of.get(a + b)
            if joined is not None and made[joined] < before:
                return False
            if len(a) == 1 and len(b) == 1:
                return True
            if len(b) == 1 or len(a) > 1 and made[of[a]] > made[of[b]]:
                before, a = made[of[a]], self.halves(a)[1]
            else:
                before, b = made[of[b]] + 1, self.halves(b)[0]

    def _stay(self, left: int, right: int) -> bool:
        a, b = self._text(left), self._text(right)
        return all(len(x) == 1 or self.halves(x) for x in (a, b)) and self._neighbours(a, b)

    def _extend_merged(self, word: str, i: int, state: list[int], start: list[int], _: list[float]) -> None:
        of, apart = self.of, self._apart
        for n in self._lengths.get(word[i - 2 : i], ()) if i > 1 else ():
            if n <= i:
                a = i - n
                piece = of.get(word[a:i])
                if piece is not None:
                    left = state[a]
                    if self.halves(word[a:i]) if a == 0 else apart[left << 32 | piece] if left >= 0 else self.halves(word[a:i]):
                        state.append(piece)
                        start.append(a)
                        return
        state.append(of.get(word[i - 1], -1 - ord(word[i - 1])))
        start.append(i - 1)

    def _extend_best(self, word: str, i: int, state: list[int], start: list[int], best: list[float]) -> None:
        found = (best[i - 1] + self._below, i - 1, -1 - ord(word[i - 1]))
        for a in range(max(0, i - self.longest), i):
            piece = self.of.get(word[a:i])
            if piece is not None:
                score = best[a] + self.vocabulary.scores[piece]
                if score > found[0] or found[2] < 0 and a == i - 1:
                    found = (score, a, piece)
        best.append(found[0])
        start.append(found[1])
        state.append(found[2])

    def encoded(self, words: list[str]) -> Iterator[bytes]:
        """Ids (little-endian unsigned 32-bit) of each word of a sorted list; forward states go over to the next word."""
        extend: Callable = self._extend_merged if self.vocabulary.kind == "bpe" else self._extend_best
        state, start, best, before = [0], [0], [0.0], ""
        for word in words:
            shared, least = 0, min(len(before), len(word))
            while shared < least and before[shared] == word[shared]:
                shared += 1
            del state[shared + 1 :], start[shared + 1 :], best[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                extend(word, i, state, start, best)
            ids, at = [], len(word)
            while at:
                ids += self._ids(state[at])
                at = start[at]
            yield struct.pack(f"<{len(ids)}I", *reversed(ids))
            before = word

    def _ids(self, state: int) -> list[int]:
        if state >= 0:
            return [state]
        first = self.vocabulary.first_byte
        return [self.vocabulary.unknown] if first is None else [first + b for b in reversed(chr(-1 - state).encode())]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; words the worker has not met lately are sorted and traversed together."""
        split = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.words
        new = sorted({w for w in set().union(*split).difference(known) if w not in known.older})
        for word, ids in zip(new, self.encoded(new), strict=True):
            known.put(word, ids)
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, marks as spaces, without the space in front; bytes that are no text become U+FFFD."""
        text = b"".join(map(self._spelt.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ")


def _on_worker(vocabulary: Vocabulary) -> Encoder:
    key = hash(vocabulary)
    if key not in _WORKER:
        _WORKER[key] = Encoder(vocabulary)
    return _WORKER[key]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 32-bit) per row of ``docs``; a null text is empty and has no ids."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _on_worker(vocabulary.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder.encode_all(texts_of(batch.column(1))), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` per row of ids; null ids give the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _on_worker(vocabulary.value)
        for batch in slices(batches):
            texts = [encoder.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(decode, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, n_chars, decoded_sha256, same`` per row of ``docs``: its ids, and the text read back from them.

    ``same`` is false where the library cannot give a text back either: a text that holds the mark itself. Null text:
    empty, no tokens. Repeated rows and null ids stay; an empty table gives none; other columns are ignored.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("n_chars", pa.int64()), ("decoded_sha256", pa.string()), ("same", pa.bool_())])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _on_worker(vocabulary.value)
        for batch in slices(batches, BATCH_ROWS):
            texts = texts_of(batch.column(1))
            ids = encoder.encode_all(texts)
            back = [encoder.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            columns = [[len(x) // 4 for x in ids], [zlib.crc32(x) for x in ids], [len(t) for t in back], [hashlib.sha256(t.encode()).hexdigest() for t in back]]
            columns.append([a == b for a, b in zip(texts, back, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, schema.types[1:], strict=True)]], schema=schema)

    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return whole.mapInArrow(both, "doc_id long, n_tokens long, ids_crc32 long, n_chars long, decoded_sha256 string, same boolean")
