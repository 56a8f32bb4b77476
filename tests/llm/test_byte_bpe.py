"""Byte-level BPE by the automaton against the library, and the round trip."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm.byte_bpe import ByteBpe, Merges, Pairs, decode_documents, encode_documents, read_ranks, round_trip
from tests.llm.conftest import found

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")]
PATTERN = public_tokenizers.PATTERN
CODERS = {p: ByteBpe(Merges.read(p, PATTERN)) for p in PATHS}
LIBRARY = {p: tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(p), special_tokens={}) for p in PATHS}


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("path", PATHS)
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list("aehintg's -=0\n\tß😀ਕ<|endoftext|>")) | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_ids_are_the_librarys(path, texts):
    for text, ids in zip(texts, CODERS[path].encode_all(texts), strict=True):
        assert numbers(ids) == LIBRARY[path].encode_ordinary(text)
        assert CODERS[path].decode(ids) == text.encode()


@pytest.mark.parametrize("path", PATHS)
@settings(max_examples=200, deadline=None)
@given(word=st.binary(min_size=1, max_size=60) | st.text(st.sampled_from(list("aeinst")), min_size=1, max_size=60).map(str.encode))
def test_words_are_the_plain_merges(path, word):
    """Any bytes, valid or not, and long words of few letters, in which the search often goes back."""
    ranks, parts = CODERS[path].ranks, [word[k : k + 1] for k in range(len(word))]
    while word not in ranks and (open_ := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]):
        k = min(open_)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    expected = [ranks[word]] if word in ranks else [ranks[p] for p in parts]
    assert numbers(CODERS[path].encode_words([word])[0]) == expected


def test_tokens_that_no_merge_makes_are_whole_words_only(tmp_path):
    """``abc`` has no halves: it is the id of the word ``abc`` and of nothing else."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"aa", b"aaaa"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" " + str(k).encode() + b"\n" for k, t in enumerate(tokens)))
    merges = Merges.read(str(path), PATTERN)
    assert merges.left[256] == -2 and merges.left[258] == 257
    coder, library = ByteBpe(merges), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(str(path)), special_tokens={})
    for text in ["abc", "abcd", " abc", "aaaaa", "aaaaaaa", "xaaab", ""]:
        assert numbers(coder.encode_all([text])[0]) == library.encode_ordinary(text)


def test_pairs_apart():
    coder = CODERS[PATHS[1]]
    pairs = Pairs(Merges.read(PATHS[1], PATTERN), coder.ranks)
    assert not pairs.apart(coder.ranks[b"t"], coder.ranks[b"h"])
    assert pairs.apart(coder.ranks[b"the"], coder.ranks[b"\xff"])


def test_a_memory_that_turns_over_changes_nothing(rows):
    small = ByteBpe(Merges.read(PATHS[0], PATTERN))
    small.pieces.size = 3
    texts = [t or "" for _, t in rows]
    assert small.encode_all(texts) + small.encode_all(texts) == CODERS[PATHS[0]].encode_all(texts) * 2


def test_a_worker_remembers_the_pieces_of_a_large_part():
    coder, asked = ByteBpe(Merges.read(PATHS[0], PATTERN)), []
    plain = coder.encode_pieces
    coder.encode_pieces = lambda pieces: asked.extend(pieces) or plain(pieces)
    first = coder.encode_all([" first"])
    for k in range(900_000):
        coder.pieces.put(f" w{k}", b"")
    assert coder.encode_all([" first"]) == first
    assert asked.count(" first") == 1


def test_table(docs, rows):
    path = PATHS[0]
    ids = [np.array(LIBRARY[path].encode_ordinary(t or ""), "<u4") for _, t in rows]
    digest = lambda x: hashlib.sha256(x).hexdigest()
    expected = [(i, len(x), digest(x.tobytes()), digest((t or "").encode())) for (i, t), x in zip(rows, ids, strict=True)]
    assert found(round_trip(docs, path, PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    back = decode_documents(encode_documents(docs, path, PATTERN), path, PATTERN)
    got = sorted(((r.doc_id, bytes(r.content)) for r in back.collect()), key=repr)
    assert got == sorted(((i, (t or "").encode()) for i, t in rows), key=repr)


def test_nothing(nothing):
    assert round_trip(nothing, PATHS[0], PATTERN).count() == 0
    assert round_trip(nothing, PATHS[0], PATTERN).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
