"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from cadastra.llm import quality_rules as rules


def quality_verdicts() -> str:
    symbols, lines, repeated, letters = ("n_symbols / greatest(n_words, 1)", "n_dup_lines / greatest(n_lines, 1)", "n_repeat_words / greatest(n_words, 1)", "word_chars / greatest(n_words, 1)")
    hits = " ".join(
        f"WHEN {symbols} > {a} OR {lines} > {b} OR {repeated} > {c} OR {letters} > {d} OR {letters} < {e} THEN {level}"
        for level, (a, b, c, d, e) in enumerate(rules.LADDER)
    )
    term = f"exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({rules.RISK}) + (n - j) * ln(1 - {rules.RISK}))"
    return rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cover AS (SELECT rid, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS v(o) GROUP BY rid),
line AS (
  SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
counted AS (
  SELECT d.rid, doc_id, stratum, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(line.dup, 0)::BIGINT AS n_dup_lines,
         coalesce(line.n, 0)::BIGINT AS n_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN line ON line.rid = d.rid LEFT JOIN cover ON cover.rid = d.rid),
measured AS MATERIALIZED (
  SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed,
         CASE {hits} ELSE {len(rules.LADDER)} END AS lvl
  FROM counted),
known AS (
  SELECT doc_id, min(quality) AS good, ((doc_id % 2147483648 + 2147483648) % 2147483648 * 2654435761) % 4294967296 AS spread
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
used AS (
  SELECT stratum, (spread // 64) % 2 = 1 AS held, good = 1 AS good, lvl FROM known JOIN measured USING (doc_id) WHERE NOT base_failed),
tested AS (
  SELECT stratum, level, count(*) FILTER (held AND good AND lvl <= level) AS k, count(*) FILTER (held AND good) AS n,
         count(*) FILTER (NOT held AND NOT good AND lvl <= level) / greatest(count(*) FILTER (NOT held AND NOT good), 1)
         - count(*) FILTER (NOT held AND good AND lvl <= level) / greatest(count(*) FILTER (NOT held AND good), 1) AS gain
  FROM used, range({len(rules.LADDER)}) AS r(level) GROUP BY stratum, level),
judged AS (
  SELECT *, n > 0 AND (CASE WHEN k > n * {rules.RISK} THEN 1.0 ELSE (SELECT sum({term}) FROM (SELECT unnest(range(0, k + 1)) AS j)) END)
         <= {rules.DOUBT} / (SELECT count(DISTINCT stratum) FROM tested) AS sure
  FROM tested),
stops AS (SELECT stratum, min(level) FILTER (NOT sure) AS stop FROM judged GROUP BY stratum),
chosen AS (
  SELECT stratum, level FROM judged JOIN stops USING (stratum) WHERE stop IS NULL OR level < stop
  QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, level) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lvl > coalesce(level, -1) AS kept
FROM measured LEFT JOIN chosen USING (stratum)
"""


def hard_negatives(scale: int = 256, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """Counterpart of ``op11_hard_negatives``: every row takes part for itself, told apart by ``k``."""
    return f"""
    WITH v AS (
        SELECT row_number() OVER () AS k, vec_id,
               CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
               list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.k, a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
               list_dot_product(a.q, r.q)::BIGINT AS score
        FROM v a, v r WHERE a.vec_id % {every} = 0
    ), p AS (
        SELECT k, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
               row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS place
        FROM s WHERE label = anchor_label AND vec_id <> anchor_id
        QUALIFY place <= {positives}
    ), n AS (
        SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.k, p.place ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s ON s.k = p.k
        WHERE s.label <> p.anchor_label AND {low} * p.positive_score <= 100 * s.score AND 100 * s.score <= {high} * p.positive_score
    )
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= {negatives}
    """
