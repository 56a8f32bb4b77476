from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm.shared_viterbi import Encoder, Vocabulary, decode_documents, encode_documents, round_trip
from tests.llm.conftest import found

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = Encoder(Vocabulary.read(MODEL))


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aethin -=0\n\tß▁")) | st.characters(codec="utf-8"), max_size=30), max_size=6))
def test_ids_and_texts_are_the_librarys(texts):
    for text, ids in zip(texts, ENCODER.encode_all(texts), strict=True):
        assert numbers(ids) == LIBRARY.encode(text)
        assert ENCODER.decode(numbers(ids)) == LIBRARY.decode(numbers(ids))


def test_table(docs, rows):
    expected = []
    for i, text in rows:
        text = text or ""
        ids = LIBRARY.encode(text)
        back = LIBRARY.decode(ids)
        expected.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(back), hashlib.sha256(back.encode()).hexdigest(), back == text))
    assert found(round_trip(docs, MODEL), "doc_id", "n_tokens", "ids_crc32", "n_chars", "decoded_sha256", "same") == sorted(expected, key=repr)
    back = decode_documents(encode_documents(docs, MODEL), MODEL)
    assert found(back, "doc_id", "text") == sorted([(i, LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t in rows], key=repr)


def test_nothing(nothing):
    assert round_trip(nothing, MODEL).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=8))
def test_unigram_scores_are_the_best(words):
    scores = {"a": -3.0, "b": -3.5, "c": -4.0, "ab": -4.1, "bc": -5.0, "abc": -7.3, "ca": -6.9, "▁a": -4.0, "▁": -2.0, "cab": -9.0}
    vocabulary = Vocabulary("unigram", (None, *scores), (0.0, *scores.values()), None, 0)

    def best(word):
        table = [0.0] + [-1e9] * len(word)
        for i in range(1, len(word) + 1):
            table[i] = max(table[a] + scores.get(word[a:i], -1e9) for a in range(i))
        return table[-1]

    for word, ids in zip(sorted(words), Encoder(vocabulary).encoded(sorted("▁" + w for w in words)), strict=True):
        pieces = [vocabulary.pieces[k] for k in numbers(ids)]
        assert "".join(pieces) == "▁" + word
        assert abs(sum(scores[p] for p in pieces) - best("▁" + word)) < 1e-9


def test_words_met_before_half_a_million_others_are_remembered():
    encoder = Encoder(Vocabulary.read(MODEL))
    for k in range(500_000):
        encoder.words.put(f"w{k}", b"")
    assert "w0" in encoder.words or "w0" in encoder.words.older
    assert len(encoder.words) + len(encoder.words.older) <= 800_000
