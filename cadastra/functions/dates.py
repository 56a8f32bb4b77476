"""Billing-day arithmetic and the forward calendar lookup."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bills_on(registered: Column, on: Column) -> Column:
    """True when ``on`` is the property's billing day (registration day, clamped to the month's end)."""
    due_day = F.least(F.dayofmonth(registered), F.dayofmonth(F.last_day(on)))
    return (registered <= on) & (due_day == F.dayofmonth(on))


def billing_day_keys(dates: DataFrame) -> DataFrame:
    """For every date, the registration days it bills: its own, and on a month's last day all later ones."""
    day = F.dayofmonth("op_date")
    last = F.when(F.col("op_date") == F.last_day("op_date"), F.lit(31)).otherwise(day)
    return dates.select("op_date", F.explode(F.sequence(day, last)).alias("day_key"))


#: Longest calendar, in days, that is made on the driver: a thousand years.
MAX_DAYS = 366_000


def next_date_lookup(dates: DataFrame, column: str, max_dates: int = 100_000, max_days: int = MAX_DAYS) -> tuple[DataFrame, Column]:
    """Calendar ``(day, next_date)`` giving the first date of ``dates`` strictly after each day.

    Returns the calendar and the earliest day it covers: clamp a lookup key with ``greatest(key, earliest)``.
    The calendar has one row per day from the first to the last date. Up to ``max_dates`` distinct dates that span
    ``max_days`` at most it is made on the driver and broadcast; beyond either it is an ordinary equi-join side.
    """
    spark = dates.sparkSession
    distinct = dates.select(F.col(column).cast("date").alias("next_date")).where("next_date IS NOT NULL").distinct()
    found = distinct.limit(max_dates + 1).toArrow()["next_date"]
    stops = np.sort(found.to_numpy().astype("datetime64[D]"))
    span = int((stops[-1] - stops[0]).astype(int)) + 1 if len(stops) else 0
    if len(found) <= max_dates and span <= max_days:
        days = np.arange(stops[0] - 1, stops[-1]) if len(stops) else stops
        following = stops[np.searchsorted(stops, days, side="right")] if len(stops) else stops
        table = pa.table({"day": pa.array(days, pa.date32()), "next_date": pa.array(following, pa.date32())})
        earliest = F.lit(days[0].item()) if len(days) else F.lit(None).cast("date")
        return F.broadcast(spark.createDataFrame(table)), earliest
    earliest = F.date_sub(F.lit(distinct.agg(F.min("next_date")).first()[0]), 1)
    # The date before each one: in its year by a window of a year's dates, else the last of the year before that has any.
    year = F.year("next_date").alias("year")
    years = distinct.groupBy(year).agg(F.max("next_date").alias("last"))
    before = years.select("year", F.lag("last").over(Window.orderBy("year")).alias("year_before"))
    in_year = F.lag("next_date").over(Window.partitionBy("year").orderBy("next_date"))
    dated = distinct.select("next_date", year).withColumn("in_year", in_year).join(before, "year")
    previous = F.coalesce("in_year", "year_before", earliest)
    days = dated.select(F.explode(F.sequence(previous, F.date_sub("next_date", 1))).alias("day"), "next_date")
    return days, earliest
