"""Order-dependent rules on hot keys: summarise per (key, day) first, then run windows on the summaries.

A property may own a third of all rows, so no window here is partitioned by property over raw rows. Rows are
numbered inside one (key, day) and joined to a running total of the earlier days. The running totals have one row
per key and day, so a window partitioned by the key never holds more rows than the calendar has days. A day that
holds too much itself is cut into blocks of its order first, which then count as days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running(keys: list[str], order: list[str]):
    """Window from the first day to the current one."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def number_by_day(df: DataFrame, keys: list[str], day: str, order: list[str], out: str) -> DataFrame:
    """Exact ``row_number`` over ``keys`` ordered by (day, order...), without a window over the whole key."""
    counts = df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select(
        *keys, day, (F.sum("_rows").over(running(keys, [day])) - F.col("_rows")).alias("_before")
    )
    in_day = F.row_number().over(Window.partitionBy(*keys, day).orderBy(*order))
    return (
        df.withColumn("_in_day", in_day)
        .join(before, [*keys, day])
        .withColumn(out, F.col("_before") + F.col("_in_day"))
        .drop("_before", "_in_day")
    )


#: A group with more rows than this, and more than one in ``SHARES`` of all, is cut into blocks.
WIDE_ROWS = 1_000_000
SHARES = 1024
#: Rows drawn for each block, of which the last becomes its bound: the more, the more even the blocks.
DRAWN = 8
#: Bounds are searched in runs of this length.
RUN = 32


def block_bounds(rows: DataFrame, keys: list[str], order: list[str], wide_rows: int, shares: int) -> DataFrame:
    """(keys, _bounds): for each wide group the ascending values of ``order`` that start its second and later blocks.

    A row is drawn by the hash of its keys and order, so a repeated task draws the same rows. A block has about as many
    rows as the least wide group. All groups together have at most ``shares`` bounds on average, whatever the number of rows.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_all")).select(F.greatest(F.lit(wide_rows), F.ceil(F.col("_all") / shares)).alias("_width"))
    wide = counts.withColumn("_width", total.scalar()).where("_rows > _width").drop("_rows")
    place = F.struct(*order)
    every = F.greatest(F.col("_width") / DRAWN, F.lit(1)).cast("bigint")
    drawn = rows.join(F.broadcast(wide), keys).where(F.pmod(F.xxhash64(*keys, *order), every) == 0)
    last_of_block = lambda _, i: i % DRAWN == DRAWN - 1
    return drawn.groupBy(*keys).agg(F.filter(F.sort_array(F.collect_list(place)), last_of_block).alias("_bounds"))


def in_blocks(
    rows: DataFrame, keys: list[str], order: list[str], out: str, wide_rows: int | None = None, shares: int | None = None
) -> DataFrame:
    """``rows`` with the number ``out`` of their block in the order of their group, 0 for groups that are not wide.

    Rows of a later block come later in ``order``; rows equal in it share a block. Nothing is read while planning, and
    the bounds, which are broadcast, are fewer than ``shares`` on average over the draws.
    """
    wide_rows, shares = wide_rows or WIDE_ROWS, shares or SHARES
    bounds = F.broadcast(block_bounds(rows, keys, order, wide_rows, shares))
    place = F.struct(*order)

    def reached(values):
        return F.size(F.filter(values, lambda bound: bound <= place))

    runs = reached(F.filter("_bounds", lambda _, i: i % RUN == RUN - 1))
    block = runs * RUN + reached(F.slice("_bounds", runs * RUN + 1, F.lit(RUN)))
    return rows.join(bounds, keys, "left").withColumn(out, F.when(F.col("_bounds").isNull(), 0).otherwise(block)).drop("_bounds")
