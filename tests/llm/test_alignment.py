"""Alignment of two tokenizers against a plain version over all pairs of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadastra.llm.alignment import Aligner, Vocabularies, align_documents, possible_pairs
from cadastra.llm.pieces import vocabulary_text
from cadastra.llm.ranked import Ranked
from tests.llm.conftest import found

PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(tokens):
    """(id, first byte, byte behind) of every token."""
    at, out = 0, []
    for k, content in tokens:
        out.append((k, at, at + len(content)))
        at += len(content)
    return out


def plain(rows):
    """By the definition: every A token against every B token of every document, copies included."""
    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    byte = {chr(c) if c in shown else chr(next(hidden)): c for c in range(256)}
    aligned = []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        of_a = [(k, bytes(byte[c] for c in a.id_to_token(k))) for k in a.encode(" " + (text or ""), add_special_tokens=False).ids]
        of_b = []
        for k in b.encode(text or ""):
            piece = b.id_to_piece(k)
            of_b.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
        if not text or b"".join(c for _, c in of_a) != whole or b"".join(c for _, c in of_b) != whole:
            aligned.append((doc_id, [], [], [], ""))
            continue
        of_a, of_b = spans(of_a), spans(of_b)
        ends = sorted({e for *_, e in of_a} & {e for *_, e in of_b})
        links = [(x, y) for x, _, p in of_a for y, _, q in of_b if p == q]
        groups = [
            ",".join(str(k) for k, _, e in of_a if start < e <= end) + "|" + ",".join(str(k) for k, _, e in of_b if start < e <= end)
            for start, end in zip([0, *ends], ends, strict=False)
        ]
        aligned.append((doc_id, of_a, of_b, links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(ends)))
    counts = Counter(pair for row in aligned for pair in row[3])
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return sorted(
        (
            (r[0], len(r[1]), len(r[2]), r[5] if r[1] else 0, len(r[3]), sum(counts[p] == highest[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4])
            for r in aligned
        ),
        key=repr,
    )


def test_against_all_pairs(spark, docs, rows):
    short = [(i, t) for i, t in rows if t is None or len(t) < 5000]
    assert any(t and "▁" in t for _, t in short), "a text that the pieces do not give back"
    expected = plain(short)
    got = found(align_documents(docs.where("text IS NULL OR length(text) < 5000"), PATH_A, PATH_B), *COLUMNS)
    assert got == expected
    assert sum(r[4] for r in expected) > 1000


def test_copies_weigh(spark):
    rows = [(k, "the same text again") for k in range(40)] + [(50, "the same"), (51, " the same"), (52, "<|endoftext|> </s> <s>"), (53, ""), (None, None), (50, "the same")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, digest string, n_a int").repartition(4)
    assert found(align_documents(df, PATH_A, PATH_B), *COLUMNS) == plain(rows)


def test_possible_pairs_bound_what_can_meet():
    assert possible_pairs([b"ab", b"b", b""], [b"b", b"xab", b"c"]).tolist() == sorted([0 << 32 | 0, 0 << 32 | 1, 1 << 32 | 0, 1 << 32 | 1])
    both = Vocabularies.read(PATH_A, PATH_B)
    assert len(both.pairs) <= sum(map(len, both.bytes_a)) + sum(map(len, both.bytes_b))
    assert (np.diff(both.pairs) > 0).all()


LIBRARY = Tokenizer.from_file(PATH_A)
LIBRARY.encode_special_tokens = True
ALIGNER = Aligner(Vocabularies.read(PATH_A, PATH_B))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aeinst'sThé ²½ßǆΩя,.-!#09  \n\t")) | st.characters(max_codepoint=0x24F), max_size=60), max_size=4))
def test_ids_of_a_are_the_librarys(texts):
    assert ALIGNER._ranked.takes("Plain text, über alles.")
    assert ALIGNER.encode_a(texts) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_what_goes_to_the_library():
    byte, word = (Ranked(vocabulary_text(public_tokenizers.path(n)), special_strings=True) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    assert not word.takes("text") and byte.takes("text") and byte.takes("")
    assert not any(byte.takes(t) for t in ["a <|endoftext|> b", "\u2028", "中", "a\x85b", "soft\xadhyphen"])
    assert Ranked(vocabulary_text(PATH_A), special_strings=False).takes("a <|endoftext|> b")
    assert ALIGNER.encode_a(["\u2028中\x85 text"]) == [LIBRARY.encode("\u2028中\x85 text", add_special_tokens=False).ids]


def test_nothing(nothing, spark):
    assert align_documents(nothing, PATH_A, PATH_B).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert found(align_documents(only, PATH_A, PATH_B), *COLUMNS) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
