"""Joins of raw rows to one row per key, where one key may own a large share of the rows.

Adaptive execution splits a skewed join only when both inputs come straight from a shuffle; an input that was
aggregated or joined on the same key is not split. These joins are therefore salted, for the hot keys only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.session import small

HOT_ROWS = 1_000_000
#: Most hot keys that are broadcast; more are joined like any other rows.
HOT_KEYS = 100_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, _parts): keys with more than ``hot_rows`` rows, and into how many parts to split each.

    Every hot key has more than ``hot_rows`` rows, so there are fewer than (all rows / ``hot_rows``) of them. Their
    number is checked before they are broadcast.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int")
    return counts.where(F.col("_rows") > hot_rows).select(key, parts.alias("_parts"))


def spread_join(
    rows: DataFrame, attributes: DataFrame, key: str, by: str, hot: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """``rows`` joined to ``attributes`` on ``key``; rows of hot keys are split by a hash of column ``by``.

    The attributes of a hot key are repeated once per part, all others stay single.
    Without ``hot`` (no key can be hot) this is a plain join.
    """
    if hot is None:
        return rows.join(attributes, key, how)
    known = small(hot, HOT_KEYS)
    part = F.coalesce(F.expr(f"pmod(xxhash64({by}), _parts)"), F.lit(0)).cast("int")
    left = rows.join(known, key, "left").withColumn("_part", part).drop("_parts")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    right = attributes.join(known, key, "left").withColumn("_part", parts).drop("_parts")
    return left.join(right, [key, "_part"], how).drop("_part")
