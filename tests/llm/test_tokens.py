"""Token counts, token files and packing against the library's own ids of whole texts."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadastra.llm import packing, token_files
from cadastra.llm.pieces import LONGEST_KEPT, Pieces, on_worker, vocabulary_text
from cadastra.llm.token_counts import count_tokens, frequent_pieces
from tests.llm.conftest import found

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(text=st.text(st.sampled_from(list("aTé ß.!'s\n\t\r\x1c\x85\xa0 ́Σ1２<|endoftext|>")) | st.characters(codec="utf-8"), max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(path, text):
    pieces = _PIECES.setdefault(path, Pieces(vocabulary_text(path)))
    assert np.frombuffer(pieces.ids(text), "<u4").tolist() == pieces.ids_of(text)
    assert pieces.ids_of(text) == _LIBRARY[path].encode(text, add_special_tokens=False).ids


_PIECES: dict = {}
_LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def test_counts(docs, rows):
    expected = [(i, len((t or "").encode()), n := len(_LIBRARY[BYTE].encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    assert found(count_tokens(docs, BYTE), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


def test_counts_of_nothing(nothing):
    assert count_tokens(nothing, BYTE).count() == 0


def test_long_pieces_are_not_in_the_table(spark):
    texts = ["x" * (LONGEST_KEPT + k) + " and and" for k in range(1, 5)] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = frequent_pieces(rows, vocabulary_text(BYTE), n=2)
    assert table == {" and": 1}
    expected = [(i, len(t), len(library_ids(BYTE, t)), len(library_ids(BYTE, t)) > 512) for i, t in enumerate(texts)]
    assert found(count_tokens(rows, BYTE), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


@pytest.mark.parametrize("width", [1, 3, 8, 16, 17, 32])
def test_bit_packing_reads_any_range(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, dtype=np.uint64).astype("<u4")
    payload = token_files.pack(ids, width)
    assert len(payload) == -(-1001 * width // 8)
    for a, b in [(0, 1001), (0, 0), (5, 6), (17, 900), (1000, 1001)]:
        assert (token_files.unpack(payload, width, a, b) == ids[a:b]).all()


def test_token_files(docs, rows):
    start, expected = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*_LIBRARY[WORD].encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found(token_files.token_files(docs, WORD, 2), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_a_worker_remembers_the_pieces_of_a_large_part(monkeypatch):
    pieces, asked = on_worker(vocabulary_text(WORD), token_files.REMEMBERED, token_files.WORDS), []
    plain = pieces.packed.make
    monkeypatch.setattr(pieces.packed, "make", lambda piece: asked.append(piece) or plain(piece))
    first = pieces.ids("first,")
    for k in range(600_000):
        pieces.packed.put(f"w{k}", b"")
    assert pieces.ids("first,") == first
    assert asked == ["first,"]


def test_token_files_of_nothing(nothing):
    assert token_files.token_files(nothing, WORD, 2).count() == 0


def test_small_blocks_and_random_access(spark, docs, monkeypatch, tmp_path):
    whole = found(token_files.token_files(docs, WORD, 2), "doc_id", "start", "n_tokens", "ids_crc32")
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, WORD, path, 2)
    assert found(token_files.read_token_files(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == whole
    block = spark.read.parquet(path).where("n_ids > 3").first()
    ids = token_files.unpack(block["payload"], block["width"], block["starts"][0], block["starts"][1])
    assert ids[-1] == 2 and block["width"] == 16


def test_cuts():
    assert packing.cut_points(5, 1024) == [0, 5]
    assert packing.cut_points(1024, 1024) == [0, 1024]
    assert packing.cut_points(2050, 1024) == [0, 2, 1026, 2050]


def test_packing(docs, rows):
    size = 64
    packed = packing.pack_documents(docs, BYTE, 2, size).collect()
    expected = Counter()
    for i, text in rows:
        ids = np.array([*_LIBRARY[BYTE].encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        points = packing.cut_points(len(ids), size)
        assert all(b - a == size for a, b in zip(points[1:], points[2:], strict=False))
        expected.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(points, points[1:], strict=False)))
    assert Counter(tuple(r)[:5] for r in packed) == expected
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= size
    assert len(bins) <= -(-sum(r["length"] for r in packed) // size) + 2


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing, BYTE, 2).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), min_size=1, max_size=12))
def test_segments_place_every_piece_once(histogram):
    segments, sequences = packing.minimum_slack(histogram, 30)
    for length, n in histogram.items():
        own = sorted(s[1:3] for s in segments if s[0] == length)
        assert own[0][0] == 0 and own[-1][1] == n and all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
    assert sequences >= -(-sum(k * v for k, v in histogram.items()) // 30)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 3), min_size=1, max_size=5))
def test_fullest_bin(counts):
    def best(items, room):
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums if s + x <= room}
        return max(sums)

    longest = max(counts)
    rest = [x for x, n in counts.items() for _ in range(n - (x == longest))]
    chosen = packing.fullest(counts, 16)
    assert sum(x * n for x, n in chosen) == longest + best(rest, 16 - longest)
    assert all(n <= counts[x] for x, n in chosen) and dict(chosen)[longest] >= 1
