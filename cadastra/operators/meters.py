"""Meter balances. A reading sets the balance, adjustments subtract or add, other movements change nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.operators.ledger import running

SET, SUBTRACT, ADD = 1, 2, 3
TOTAL = "decimal(28,2)"


def signed(movement: Column, value: Column) -> Column:
    return (
        F.when(movement == SUBTRACT, -value).when(movement == ADD, value).otherwise(F.lit(0)).cast(TOTAL)
    )


#: Width, in positions, of the blocks that the readings of a meter's day are summed in.
BLOCK = 65_536


def _in_blocks(readings: DataFrame, key: str) -> DataFrame:
    """Readings with ``_block``, the block's running total ``_total`` and what the last set adds to it, ``_rebase``.

    A window holds one block of one date, so a meter with any number of readings on one day is many tasks.
    """
    block = F.coalesce(F.floor(F.col("position") / BLOCK).cast("bigint"), F.lit(-(1 << 62)).cast("bigint"))
    rows = readings.withColumn("_block", block)
    in_block = running([key, "op_date", "_block"], ["position"])
    total = F.sum(signed(F.col("movement"), F.col("value"))).over(in_block).cast(TOTAL)
    rebase = F.last(F.when(F.col("movement") == SET, F.col("value") - F.col("_total")), True).over(in_block)
    return rows.withColumn("_total", total).withColumn("_rebase", rebase.cast(TOTAL))


def _block_effects(rows: DataFrame, key: str) -> DataFrame:
    """One row per block: a balance b becomes coalesce(base, b) + delta. Such pairs combine in any grouping."""
    place = F.coalesce(F.col("position").cast("bigint"), F.lit(-(1 << 62)))
    last = F.max_by(F.struct("_rebase", "_total"), place).alias("_last")
    return (
        rows.groupBy(key, "op_date", "_block")
        .agg(last)
        .select(key, "op_date", "_block", F.col("_last._rebase").alias("base"), F.coalesce("_last._total", F.lit(0)).cast(TOTAL).alias("delta"))
    )


def _folded(effects: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Effects of everything up to each row: ``_base`` and ``_delta``."""
    before = running(keys, order)
    total = F.sum("delta").over(before).cast(TOTAL)
    rebase = F.last(F.when(F.col("base").isNotNull(), F.col("base") + F.col("delta") - F.col("_delta")), True).over(before)
    return effects.withColumn("_delta", total).withColumn("_base", rebase.cast(TOTAL))


def day_effects(readings: DataFrame, key: str = "meter_id") -> DataFrame:
    """One row per (key, date): the day turns a balance b into coalesce(base, b) + delta, from the blocks of the day."""
    rows = readings.where(F.col("value").isNotNull()).select(key, "op_date", "position", "movement", "value")
    blocks = _folded(_block_effects(_in_blocks(rows, key), key), [key, "op_date"], ["_block"])
    last = F.max_by(F.struct("_base", "_delta"), "_block").alias("_last")
    return (
        blocks.groupBy(key, "op_date")
        .agg(last)
        .select(key, "op_date", F.col("_last._base").alias("base"), F.col("_last._delta").alias("delta"))
    )


def day_balances(effects: DataFrame, key: str) -> DataFrame:
    """Balance at the end of each day, starting from 0: running sum, re-based on every day that sets a value."""
    days = running([key], ["op_date"])
    total = F.sum("delta").over(days)
    rebase = F.last(F.when(F.col("base").isNotNull(), F.col("base") + F.col("delta") - F.col("_total")), True)
    return (
        effects.withColumn("_total", total.cast(TOTAL))
        .withColumn("balance", (F.col("_total") + F.coalesce(rebase.over(days), F.lit(0))).cast(TOTAL))
        .drop("_total", "base", "delta")
    )


def property_effects(readings: DataFrame, properties: DataFrame) -> DataFrame:
    """Day effects carried to every property on the meter, from its listing date on."""
    listed = properties.select("property_id", "meter_id", F.col("op_date").alias("_listed"))
    return (
        day_effects(readings)
        .join(listed, "meter_id")
        .where("op_date >= _listed")
        .select("property_id", "op_date", "base", "delta")
    )


def property_balances(readings: DataFrame, properties: DataFrame) -> DataFrame:
    """(property_id, op_date, balance) at the end of every day with readings."""
    return day_balances(property_effects(readings, properties), "property_id")


def reading_balances(readings: DataFrame) -> DataFrame:
    """Every reading with its meter's balance right after it, in (date, position) order, starting from 0."""
    rows = _in_blocks(readings, "meter_id")
    order = ["op_date", "_block"]
    closing = _folded(_block_effects(rows, "meter_id"), ["meter_id"], order)
    balance = F.coalesce("_base", F.lit(0)) + F.col("_delta")
    before = F.lag(balance).over(Window.partitionBy("meter_id").orderBy(*order))
    opening = closing.select("meter_id", *order, F.coalesce(before, F.lit(0)).cast(TOTAL).alias("_opening"))
    return (
        rows.join(opening, ["meter_id", *order], "left")
        .withColumn("balance", (F.col("_total") + F.coalesce("_rebase", "_opening", F.lit(0))).cast(TOTAL))
        .drop("_total", "_rebase", "_opening", "_block")
    )
