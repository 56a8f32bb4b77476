"""Secret scan whose findings a random forest sifts.

Candidates are long runs of key characters with a digit among them, and shorter values assigned to a credential word, with
blanks around the sign or without. Most
are no secrets: numbers, names, identifiers. The forest looks at a candidate's length, its changes between kinds of
characters, how much of it the corpus's own dictionary explains, the path (source) and the neighbouring words, and is
trained on labelled findings. Without labels from outside, ``weak_labels`` gives them: formats of known issuers and long
mixed values assigned to a credential word are secrets; digits only, few different characters and dictionary words are not;
all else stays unlabelled and is left to the forest.

Built-in DataFrame functions and Spark ML only; texts stay in their rows and only candidates move.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.session import written

#: Credential words, formats of known issuers, words of paths that hold samples or settings.
CREDENTIAL = r"(?i)pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer|private[_-]?key"
KNOWN = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{16,})"
SAMPLE_PATH, SETTING_PATH = r"(?i)test|example|sample|mock|fixture|doc", r"(?i)\.env|conf|cfg|\.ini|ya?ml|json|properties|\.pem|secret"

#: Shortest run that is a candidate anywhere, and behind an assignment to a credential word.
LONG, SHORT = 16, 8
RUN = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
#: A credential word with what may follow it in a name, an assignment sign, and a value: up to a quote, a blank or the next
#: assignment of a list; punctuation at its end counts only before a quote.
_NAME, _SIGN = rf"(?:{CREDENTIAL})[\w.\-]*[\"'`\])}}]*", r"(?::=|=>|==|=|:)"
_STOP = r"""(?![,;&?|]["'`]?[\w.\-]+["'`]?[=:])"""
_CHAR = rf"""(?:{_STOP}[^\s"'`])"""
VALUE = rf"""({_CHAR}{{{SHORT},}}(?=["'`])|{_CHAR}{{{SHORT - 1},}}{_STOP}[^\s"'`).,;:!?\]}}>])"""
_OPEN = r"""["'`(\[{]*"""
NAMED_BEFORE, NAME_BEFORE = rf"{_NAME}\s*{_SIGN}{_OPEN}$", rf"{_NAME}$"
INSIDE, SIGNED, WHOLE = rf"{_NAME}{_SIGN}{_OPEN}{VALUE}", rf"^{_SIGN}{_OPEN}{VALUE}", rf"^{_OPEN}{VALUE}"
#: Words of the dictionary, the most frequent of the corpus, and their shortest length.
DICTIONARY_WORDS, DICTIONARY_LETTERS = 4096, 3
#: Labelled findings of each kind that the forest is trained on at most, chosen by a hash.
MOST_TRAINED = 50_000
TREES, DEPTH, SEED = 24, 6, 7
FEATURES = ["length", "changes", "digits", "capitals", "variety", "entropy", "covered", "credential", "assigned", "quoted", "sample_path", "setting_path", "depth"]


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word``: the corpus's ``DICTIONARY_WORDS`` most frequent words in lower case, of those met twice; counted over all texts."""
    # Letters beside digits are parts of keys and numbers, no words.
    word = rf"(?<![\p{{L}}\p{{N}}])\p{{L}}{{{DICTIONARY_LETTERS},}}(?![\p{{L}}\p{{N}}])"
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(word), F.lit(0)))
    counted = docs.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where("n > 1").orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).select("word")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``doc_id, path, place`` (of the word in the text) ``, nth`` (in the word) ``, finding, around, assigned, quoted``."""
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[ \t\n\x0B\f\r]+")

    def found(w: Column) -> Column:
        at = lambda i: F.coalesce(F.get(w, i), F.lit(""))
        before = lambda i: F.concat_ws(" ", at(i - 2), at(i - 1))
        ends = lambda x: x.rlike(rf"{_SIGN}{_OPEN}$")
        apart = lambda i: at(i - 1).isin("=", ":", ":=", "=>") & at(i - 2).rlike(CREDENTIAL)
        named = lambda i: apart(i) | ends(at(i - 1)) & before(i).rlike(NAMED_BEFORE)
        signed = lambda i: at(i).rlike(SIGNED) & at(i - 1).rlike(NAME_BEFORE)
        inside = lambda i: (at(i).contains("=") | at(i).contains(":")) & at(i).rlike(INSIDE)
        wanted = lambda i: (F.length(at(i)) >= SHORT) & ((F.length(at(i)) >= LONG) & at(i).rlike(RUN) | named(i) | signed(i) | inside(i))
        shown = lambda i: F.struct(
            i.alias("place"), at(i).alias("word"), before(i).alias("before"), at(i + 1).alias("after"), named(i).alias("named"), signed(i).alias("signed")
        )
        return F.transform(F.filter(F.sequence(F.lit(0), F.size(w) - 1), wanted), shown)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.inline(_let(words, found)))
    runs = F.regexp_extract_all("word", F.lit(RUN), F.lit(0))
    one = lambda when, value: F.when(F.col(when), F.array(value)).otherwise(F.array())
    whole, plain = F.regexp_extract("word", WHOLE, 1), F.regexp_extract("word", r"""^["'`(]*([^"'`]*?)["'`).,;:!?]*$""", 1)
    values = F.concat(one("named", F.when(whole != "", whole).otherwise(plain)), one("signed", F.regexp_extract("word", SIGNED, 1)), F.regexp_extract_all("word", F.lit(INSIDE), F.lit(1)))
    exploded = rows.select("*", F.posexplode(F.array_distinct(F.concat(runs, values))).alias("nth", "finding"))
    own = F.expr("substring_index(word, finding, 1)")
    return exploded.where((F.length("finding") >= SHORT) & F.col("finding").rlike("[0-9]")).select(
        "doc_id",
        "path",
        "place",
        "nth",
        "finding",
        F.concat_ws(" ", "before", own, "after").alias("around"),
        (F.concat_ws(" ", "before", own).rlike(r"""[=:]>?\s*["'`(\[{]*$""")).alias("assigned"),
        own.rlike(r"""["'`]$""").alias("quoted"),
    )


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with an ``id`` and the columns ``FEATURES``. ``words`` is the dictionary, ``DICTIONARY_WORDS`` rows at most."""
    numbered = written(found.withColumn("id", F.monotonically_increasing_id()))
    parts = numbered.select("id", F.explode(F.regexp_extract_all(F.lower("finding"), F.lit(rf"[a-z]{{{DICTIONARY_LETTERS},}}"), F.lit(0))).alias("word"))
    covered = parts.join(F.broadcast(words), "word").groupBy("id").agg(F.sum(F.length("word")).alias("letters"))
    f, size = F.col("finding"), F.length("finding")
    kinds = f
    for kind, mark in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "9"), ("[^a-zA-Z0-9]+", "-")):
        kinds = F.regexp_replace(kinds, kind, mark)
    without = lambda kind: size - F.length(F.regexp_replace(f, kind, ""))
    share = lambda n: n / size
    flag = lambda c: c.cast("double")
    spelt = F.array_distinct(F.split(f, ""))
    times = lambda c: size - F.length(F.replace(f, c, F.lit("")))
    entropy = F.aggregate(spelt, F.lit(0.0), lambda acc, c: F.when(c == "", acc).otherwise(acc - share(times(c)) * F.log2(share(times(c)))))
    return numbered.join(covered, "id", "left").select(
        *numbered.columns,
        size.cast("double").alias("length"),
        share(F.length(kinds) - 1).alias("changes"),
        share(without("[0-9]")).alias("digits"),
        share(without("[A-Z]")).alias("capitals"),
        share(F.size(spelt)).alias("variety"),
        entropy.alias("entropy"),
        share(F.coalesce("letters", F.lit(0))).alias("covered"),
        flag(F.col("around").rlike(CREDENTIAL)).alias("credential"),
        flag(F.col("assigned")).alias("is_assigned"),
        flag(F.col("quoted")).alias("is_quoted"),
        flag(F.col("path").rlike(SAMPLE_PATH)).alias("sample_path"),
        flag(F.col("path").rlike(SETTING_PATH)).alias("setting_path"),
        F.size(F.split("path", "/")).cast("double").alias("depth"),
    ).drop("assigned", "quoted").withColumnsRenamed({"is_assigned": "assigned", "is_quoted": "quoted"})


def weak_labels(measured: DataFrame) -> DataFrame:
    """``measured`` with ``label``: 1.0, 0.0 or null, by format alone."""
    mixed = (F.col("digits") < 1) & (F.col("variety") * F.col("length") >= 6)
    secret = F.col("finding").rlike(KNOWN) | (F.col("credential") == 1) & (F.col("assigned") == 1) & mixed & (F.col("entropy") >= 2.5) & (F.col("covered") < 0.5)
    harmless = (F.col("digits") == 1) | (F.col("variety") * F.col("length") <= 4) | (F.col("covered") >= 0.6) | (F.col("assigned") == 0) & (F.col("credential") == 0)
    return measured.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0))


def train(labelled: DataFrame):
    """Random forest from rows with ``FEATURES`` and ``label``; None unless both labels are there."""
    counts = {r["label"]: r["n"] for r in labelled.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0.0, 1.0}:
        return None
    part = F.lit(1.0)
    for label, n in counts.items():
        part = F.when(F.col("label") == label, min(1.0, MOST_TRAINED / n)).otherwise(part)
    drawn = F.pmod(F.xxhash64("finding", "around"), F.lit(1 << 20)) < part * (1 << 20)
    weight = F.when(F.col("label") == 1.0, max(1.0, counts[0.0] / counts[1.0])).otherwise(1.0)
    sample = written(labelled.where("label is not null").where(drawn).select("label", weight.alias("weight"), *FEATURES))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", maxBins=32).fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``doc_id, place, nth, finding, score, is_secret`` per candidate in the texts of ``docs``.

    A finding in a known issuer's format is a secret whatever its score.

    ``labelled`` has findings with ``FEATURES`` and ``label``; without it the candidates are labelled by their formats. If
    only one label is met there is no forest, and the labels decide. ``place`` counts the words of a text from 0, ``nth`` the
    candidates in a word. Null texts have no candidates, null paths are ''. Repeated rows and null ids give their findings
    each. An empty table gives no rows; other columns are ignored.
    """
    words = written(dictionary(docs, text_col))
    measured = written(weak_labels(with_features(candidates(docs, id_col, text_col, path_col), words)))
    forest = train(measured if labelled is None else labelled)
    if forest is None:
        scored = measured.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(measured)
        scored = forest.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "place", "nth", "finding", "score", ((F.col("score") >= 0.5) | F.col("finding").rlike(KNOWN)).alias("is_secret"))


def redact(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Rows of ``docs`` with every secret in the text replaced by ``mark``; other columns as they are, whatever their names.

    A secret found in one row of an id goes from all rows of that id. Null texts stay null, an empty table stays empty.
    """
    found = scan(docs, None, id_col, text_col, path_col).where("is_secret").select("doc_id", "finding").distinct()
    # Longer ones first, so that none is cut by one that it holds; a text's own secrets are as many as fit into it.
    secrets = found.groupBy(F.col("doc_id").alias("_id")).agg(F.reverse(F.array_sort(F.collect_set(F.struct(F.length("finding").alias("n"), "finding")))).alias("_secrets"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    own_id, own_text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    joined = docs.toDF(*names).join(secrets, own_id.cast("long").eqNullSafe(F.col("_id")), "left")
    clean = F.aggregate("_secrets", own_text, lambda text, s: F.replace(text, s["finding"], F.lit(mark)))
    text = F.when(F.col("_secrets").isNull(), own_text).otherwise(clean)
    return joined.select(*[text.alias(n) if c == text_col else F.col(n) for n, c in zip(names, docs.columns, strict=True)]).toDF(*docs.columns)
