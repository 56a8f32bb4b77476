"""First registration of persons and properties, and the charges a new property receives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERSON_COLUMNS = ["name", "email", "phone"]
PROPERTY_COLUMNS = ["meter_id", "area_m2", "use_id", "zone_id", "fiscal_value", "registered_on"]


def first_by_key(incoming: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """One row per key: the earliest by ``order``. Partial aggregation absorbs keys with many copies."""
    kept = [c for c in [*order, *columns]]
    pick = F.min_by(F.struct(*kept), F.struct(*order)).alias("_first")
    return incoming.where(F.col(key).isNotNull()).groupBy(key).agg(pick).select(key, "_first.*")


def new_only(incoming: DataFrame, existing: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``, first occurrence only; existing rows never change."""
    return first_by_key(incoming, key, order, columns).join(existing.select(key), key, "left_anti")


def automatic_charge_ids(use_id: Column, zone_id: Column) -> Column:
    """Charges assigned on registration: tax to all, water by use, garbage unless farmland, parks by zone."""
    return F.array_compact(
        F.array(
            F.lit(3),
            F.when(use_id.isin(1, 2, 3), F.lit(1)),
            F.when(use_id != 5, F.lit(4)),
            F.when(zone_id.isin(1, 5), F.lit(5)),
        )
    )


def automatic_charges(properties: DataFrame) -> DataFrame:
    """(property_id, charge_id, op_date) for every automatic assignment, dated at the listing."""
    return properties.select(
        "property_id", F.explode(automatic_charge_ids(F.col("use_id"), F.col("zone_id"))).alias("charge_id"), "op_date"
    )
