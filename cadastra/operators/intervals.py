"""Ownership and charge-assignment intervals, built from dated movements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, CLOSE = 1, 2


def ownership_transitions(movements: DataFrame) -> DataFrame:
    """Movements that take effect: (property_id, document, op_date, action), opens and closes alternating.

    On one date all opens run before all closes, an open needs no interval to be open, a close needs one.
    ``movements`` should be distinct (see ``known_ownership``): the window then holds at most two rows per pair
    and date.
    """
    order = Window.partitionBy("property_id", "document").orderBy("op_date", "action")
    previous = F.coalesce(F.lag("action").over(order), F.lit(CLOSE))
    return (
        movements.where(F.col("action").isin(OPEN, CLOSE))
        .select("property_id", "document", "op_date", "action")
        .withColumn("_previous", previous)
        .where("action <> _previous")
        .drop("_previous")
    )


def known_ownership(movements: DataFrame, properties: DataFrame, persons: DataFrame) -> DataFrame:
    """Distinct movements whose property and person are registered on or before the movement's date.

    Copies collapse in partial aggregation before the joins.
    """
    listed = properties.select("property_id", F.col("op_date").alias("_listed"))
    known = persons.select("document", F.col("op_date").alias("_known"))
    return (
        movements.select("property_id", "document", "op_date", "action")
        .distinct()
        .join(listed, "property_id")
        .join(known, "document")
        .where("op_date >= _listed AND op_date >= _known")
        .drop("_listed", "_known")
    )


def ownership_intervals(transitions: DataFrame) -> DataFrame:
    """(property_id, document, start_date, end_date); an open interval has no end date."""
    order = Window.partitionBy("property_id", "document").orderBy("op_date", "action")
    return (
        transitions.withColumn("end_date", F.lead("op_date").over(order))
        .where(F.col("action") == OPEN)
        .select("property_id", "document", F.col("op_date").alias("start_date"), "end_date")
    )


def charge_intervals(movements: DataFrame) -> DataFrame:
    """(property_id, charge_id, from_date, to_date) from assign / unassign movements.

    The first assignment opens the pair, the first unassignment on or after it ends it for good: a pair that has
    ever existed is never opened again. ``to_date`` is exclusive and null while the charge is active. ``movements``
    should be distinct (see ``known_charges``): the window then holds at most two rows per pair and date. Filters
    on the charge or the property reach below it.
    """
    order = Window.partitionBy("property_id", "charge_id").orderBy("action", "op_date")
    pair = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opened = F.when(F.col("action") == OPEN, F.col("op_date"))
    ended = F.when((F.col("action") == CLOSE) & (F.col("op_date") >= F.col("from_date")), F.col("op_date"))
    return (
        movements.where(F.col("action").isin(OPEN, CLOSE))
        .select("property_id", "charge_id", "op_date", "action")
        .withColumn("_place", F.row_number().over(order))
        .withColumn("from_date", F.min(opened).over(pair))
        .withColumn("to_date", F.min(ended).over(pair))
        .where((F.col("_place") == 1) & F.col("from_date").isNotNull())
        .select("property_id", "charge_id", "from_date", "to_date")
    )


def known_charges(movements: DataFrame, properties: DataFrame, charges: DataFrame) -> DataFrame:
    """Distinct movements on a registered property and a catalogued charge."""
    listed = properties.select("property_id", F.col("op_date").alias("_listed"))
    return (
        movements.select("property_id", "charge_id", "op_date", "action")
        .distinct()
        .join(charges.select("charge_id"), "charge_id", "left_semi")
        .join(listed, "property_id")
        .where("op_date >= _listed")
        .drop("_listed")
    )


def active_on(day, start="from_date", end="to_date"):
    """Interval test [start, end) at ``day``."""
    return (F.col(start) <= day) & (F.col(end).isNull() | (F.col(end) > day))
