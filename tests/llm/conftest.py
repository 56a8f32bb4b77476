from __future__ import annotations

import random

import pytest

from tests.conftest import make_session

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, start int, key string, kind int, text_hash long"


@pytest.fixture(scope="session")
def spark():
    return make_session()


def words(rng: random.Random, n: int) -> str:
    parts = ["".join(rng.choice(["an", "the", "ré", "ß", "on", "tion", "e"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(p + rng.choice(["", "", "", ".", ",", "!?", ".\n" + "x"]) for p in parts)


def corpus() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and odd texts, a long one, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(11)
    passage = words(rng, 70)
    base = words(rng, 150)
    near = base.split(" ")
    near[40] = "changed"
    odd = ["", " ", "\n\n", "a", "  two  spaces \n x ", "é" * 5, "a" * 900, "ab" * 700, "\t\r\x0b\x0c x\x1cy\x85z\xa0 <|endoftext|> ▁ é 😀 １２", "Ｗide ﬁ ǆ İ Σας"]
    texts = [*odd, base, base, " ".join(near), passage, words(rng, 30) + " " + passage + " " + words(rng, 30), words(rng, 20) + passage, words(rng, 9000)]
    texts += [words(rng, rng.randint(1, 120)) for _ in range(40)]
    rows: list[tuple[int | None, str | None]] = [(3 * k - 20, t) for k, t in enumerate(texts)]
    rows += [(900, None), (901, None), (None, "no id here"), (None, base), (-20, texts[10]), rows[12], rows[12]]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


def frame(spark, rows):
    """Documents with columns that clash with names the operators use."""
    return spark.createDataFrame([(i, t, ["en", None, "fr"][k % 3], f"src{k % 4}", None, "f", 1, "k", 2, 3) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


def found(df, *columns):
    """Rows as a sorted list, nulls included."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
