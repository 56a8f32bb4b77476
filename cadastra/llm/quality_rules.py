"""Quality rules whose cutoffs come from labelled documents, with a guaranteed limit on false rejections.

A ladder of rule sets goes from lax to strict. Labelled documents that pass the base rules are split into a fitting half and
a holdout. Per stratum the sets are tested on the holdout in that fixed order: a set is certified if so few of the good
documents are rejected that a true share over ``RISK`` would show as few with a probability of at most
``DOUBT / number of strata`` (exact binomial test), and every laxer set is certified. The fixed order corrects for the
levels, the division (Bonferroni) for the strata: with probability 1 - ``DOUBT`` no stratum loses more than ``RISK`` of its good documents.
Of the certified sets the one that tells the fitting half's labels apart best is used; a stratum without one rejects nothing.

Built-in DataFrame functions only. A text is one row's array functions, so no word is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.session import small, written

#: White space between words, and characters that count as symbols.
SPACE, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
#: Base rules: least number of words, and the most per cent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Rejected if over: symbols a word, share of repeated lines, share of words in repeated windows, letters a word; if under: letters a word.
LADDER = [
    (2.0, 0.90, 0.50, 15.0, 1.50),
    (1.0, 0.75, 0.45, 12.0, 2.00),
    (0.50, 0.60, 0.40, 10.0, 2.50),
    (0.25, 0.50, 0.35, 9.0, 3.00),
    (0.10, 0.40, 0.30, 8.0, 3.50),
    (0.05, 0.35, 0.25, 7.5, 3.75),
    (0.02, 0.25, 0.20, 7.0, 4.00),
    (0.01, 0.20, 0.15, 6.5, 4.25),
]
RISK, DOUBT = 0.02, 0.05


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that the text has twice or more."""

    def of_sorted(windows: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(windows, a)["w"] == F.get(windows, b)["w"], F.lit(False))
        found = F.filter(windows, lambda _, j: same(j, j - 1) | same(j, j + 1))
        places = F.array_sort(F.transform(found, lambda x: x["i"]))
        new = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last"))
        return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), new, lambda acc: acc["n"])

    def of_words(w: Column) -> Column:
        joined = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), joined)
        sort = lambda x: _let(F.array_sort(F.transform(x, lambda t, i: F.struct(t.alias("w"), i.alias("i")))), of_sorted)
        several = lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), sort(x)).otherwise(0)
        return F.when(F.size(w) >= 4, _let(windows, several)).otherwise(0)

    return _let(words, of_words)


def counts(text_col: str) -> Column:
    """Struct of the counts of a whole text. A null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACE, "") != "")
    without = lambda marks: F.length(text) - F.length(F.translate(text, marks, ""))
    counted = lambda x: F.struct(
        F.size(x["words"]).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
        F.size(x["lines"]).cast("long").alias("n_lines"),
        _repeated_words(x["words"]).cast("long").alias("n_repeat_words"),
    )
    return _let(F.struct(words.alias("words"), lines.alias("lines")), counted)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"])


def signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``_signals``: the counts and ``base_failed``."""
    s = F.col("_signals")
    return docs.withColumn("_signals", counts(text_col)).withColumn("_signals", s.withField("base_failed", base_failed(s)))


def rejected_at(s: Column) -> Column:
    """First level of the ladder that rejects a document with these signals; the number of levels if none does."""
    per = lambda a, b: s[a] / F.greatest(s[b], F.lit(1))
    symbols, lines, repeated, letters = per("n_symbols", "n_words"), per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("word_chars", "n_words")
    found = F.lit(len(LADDER))
    for level, (a, b, c, d, e) in reversed(list(enumerate(LADDER))):
        hit = (symbols > F.lit(a)) | (lines > F.lit(b)) | (repeated > F.lit(c)) | (letters > F.lit(d)) | (letters < F.lit(e))
        found = F.when(hit, level).otherwise(found)
    return found


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of n trials with probability p, exactly, summed as logarithms; 1 where k exceeds n p."""
    odds = F.lit(p / (1 - p))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j * odds)
        return F.struct(term.alias("term"), (term + F.log1p(F.exp(acc["all"] - term))).alias("all"))

    none = n * F.lit(math.log1p(-p))
    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(none.alias("term"), none.alias("all")), add, lambda acc: F.exp(acc["all"]))
    return F.when(k > n * p, 1.0).when(k == 0, F.exp(none)).otherwise(total)


def cutoffs(measured: DataFrame, labels: DataFrame, stratum_col: str, id_col: str = "doc_id") -> DataFrame:
    """``stratum, level`` for each stratum with a certified level. ``measured`` has the id, the stratum and ``_signals``.

    Labels of one document that differ make it a bad one; null labels and ids don't count. A null stratum is one of its own, ''.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    spread = F.pmod(F.pmod("doc_id", F.lit(1 << 31)) * F.lit(2654435761), F.lit(1 << 32))
    s = F.col("_signals")
    passed = measured.where(~s["base_failed"]).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col), F.lit("")).alias("stratum"), rejected_at(s).alias("at"))
    mixed = F.pmod(F.floor(spread / 64), F.lit(2)) == 1
    counted = known.join(passed, "doc_id").groupBy("stratum", mixed.alias("holdout"), (F.col("good") == 1).alias("good"), "at").agg(F.count("*").alias("n"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(len(LADDER) - 1))).alias("level")
    hit, total = F.when(F.col("at") <= F.col("level"), F.col("n")).otherwise(0), F.col("n")
    of = lambda rows, x: F.coalesce(F.sum(F.when(rows, x)), F.lit(0))
    held, good = F.col("holdout"), F.col("good")
    tested = written(
        counted.select("*", levels)
        .groupBy("stratum", "level")
        .agg(
            of(held & good, hit).alias("k"),
            of(held & good, total).alias("n"),
            (of(~held & ~good, hit) / F.greatest(of(~held & ~good, total), F.lit(1)) - of(~held & good, hit) / F.greatest(of(~held & good, total), F.lit(1))).alias("gain"),
        )
    )
    n_strata = max(tested.select("stratum").distinct().count(), 1)
    sure = binomial_tail(F.col("k"), F.col("n"), RISK) <= F.lit(DOUBT / n_strata)
    judged = tested.withColumn("sure", sure & (F.col("n") > 0))
    doubtful = judged.groupBy("stratum").agg(F.min(F.when(~F.col("sure"), F.col("level"))).alias("stop"))
    certified = judged.join(doubtful, "stratum").where("stop is null or level < stop")
    return certified.groupBy("stratum").agg(F.max_by("level", F.struct(F.col("gain"), -F.col("level"))).alias("level"))


def _with_level(docs: DataFrame, levels: DataFrame, stratum_col: str) -> DataFrame:
    """``docs`` with ``_level``, that of their stratum or -1. ``levels`` is broadcast if its counted rows are few."""
    own = small(levels.select(F.col("stratum").alias("_stratum"), F.col("level").alias("_own_level")))
    joined = docs.join(own, F.coalesce(F.col(stratum_col), F.lit("")) == F.col("_stratum"), "left")
    return joined.withColumn("_level", F.coalesce("_own_level", F.lit(-1))).drop("_stratum", "_own_level")


def _kept(s: Column) -> Column:
    return ~base_failed(s) & (rejected_at(s) > F.col("_level"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` per row of ``docs``.

    Without labels for its stratum a document is kept if it passes the base rules. A null text has no words and fails.
    Repeated rows and ids, and null ids, each get their verdict. An empty table gives no rows; other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).alias("text"))
    measured = written(signals(narrow).drop("text"))
    levels = written(cutoffs(measured, labels, "stratum"))
    s = F.col("_signals")
    shown = [s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    return _with_level(measured, levels, "stratum").select("doc_id", *shown, _kept(s).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are kept, with the columns of ``docs``; no text is shuffled while the levels are few enough to broadcast."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).alias("text"))
    levels = written(cutoffs(written(signals(narrow).drop("text")), labels, "stratum"))
    # The counts are bound inside the filter: as a column of their own they would be counted anew for each use in it.
    return _with_level(docs, levels, stratum_col).where(_let(counts(text_col), _kept)).select(*docs.columns)
