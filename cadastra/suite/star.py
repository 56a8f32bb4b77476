"""Billing tables projected from the star-schema parquet tables.

Plain projections only: every table grows with the tables it reads, and the SQL counterparts repeat them as CTEs.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions.money import money
from cadastra.operators import intervals, registry, service
from cadastra.operators.payments import settle
from cadastra.operators.skew import hot_keys
from cadastra.session import small
from cadastra.sources.catalog import Catalog

# Dates of the as-of queries.
CUT_DATE = dt.date(1996, 1, 31)
AS_OF = dt.date(1996, 3, 31)

# The published catalog.
CHARGES = [
    (1, "ConsumoAgua", 2, 1, "5000", 30, "1000", None, None, None, None),
    (2, "PatenteComercial", 1, 3, None, None, None, None, "150000", None, None),
    (3, "ImpuestoPropiedad", 3, 4, None, None, None, "0.01", None, None, None),
    (4, "RecoleccionBasura", 1, 1, "150", None, None, None, "300", 400, 75),
    (5, "MantenimientoParques", 1, 1, None, None, None, None, "2000", None, None),
    (6, "ReconexionAgua", 1, 5, None, None, None, None, "30000", None, None),
    (7, "InteresesMoratorios", 3, 6, None, None, None, "0.04", None, None, None),
]
USES = [(1, "Habitación"), (2, "Comercial"), (3, "Industrial"), (4, "Lote Baldío"), (5, "Agrícola")]
ZONES = [(1, "Residencial"), (2, "Agrícola"), (3, "Bosque"), (4, "Industrial"), (5, "Comercial")]


def fee() -> Column:
    """Fixed value of the reconnection charge."""
    return F.lit("30000").cast(schemas.MONEY)


def day(column: str) -> Column:
    return F.col(column).cast("date")


def literal(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A catalog as a local relation; broadcast, because its rows are written out in this file."""
    names = schema.fieldNames()
    text = pa.table({n: pa.array([None if r[i] is None else str(r[i]) for r in rows], pa.string()) for i, n in enumerate(names)})
    typed = spark.createDataFrame(text).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return F.broadcast(typed)


class Star:
    """Billing tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- catalogs -------------------------------------------------------------------------

    @cached_property
    def charges(self) -> DataFrame:
        return literal(self.spark, CHARGES, schemas.CHARGE)

    @cached_property
    def uses(self) -> DataFrame:
        return literal(self.spark, USES, schemas.LOOKUP)

    @cached_property
    def zones(self) -> DataFrame:
        return literal(self.spark, ZONES, schemas.LOOKUP)

    @cached_property
    def catalog(self) -> Catalog:
        none = literal(self.spark, [], schemas.LOOKUP)
        return Catalog(
            parameters=literal(self.spark, [("DiasVencimientoFactura", 15), ("DiasGraciaCorta", 10)], schemas.PARAMETER),
            uses=self.uses,
            zones=self.zones,
            movement_types=none,
            payment_methods=none,
            amount_types=none,
            periods=literal(self.spark, [], schemas.PERIOD),
            charges=self.charges,
        )

    # -- registrations and movements ------------------------------------------------------

    @cached_property
    def properties(self) -> DataFrame:
        regions = small(self.read("nation").select("n_nationkey", "n_regionkey"))
        key = F.col("c_custkey")
        registered = F.date_add(F.lit(dt.date(1995, 1, 1)), (key % 365).cast("int"))
        return (
            self.read("customer")
            .join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                registered.alias("op_date"),
                key.alias("property_id"),
                key.alias("meter_id"),
                (50 + (key * 37) % 1450).cast(schemas.QUANTITY).alias("area_m2"),
                (1 + key % 5).cast("int").alias("use_id"),
                (1 + F.col("n_regionkey")).cast("int").alias("zone_id"),
                money(F.round(F.abs("c_acctbal") * 1000)).alias("fiscal_value"),
                registered.alias("registered_on"),
            )
        )

    @cached_property
    def persons(self) -> DataFrame:
        known = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("s_suppkey") % 31).cast("int"))
        return self.read("supplier").select(
            known.alias("op_date"), F.col("s_suppkey").alias("document"), F.col("s_name").alias("name")
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def replay_date(self) -> Column:
        """Events spread over the years of the orders (all of them happened in one month)."""
        return F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("event_id") % 2400).cast("int"))

    @cached_property
    def readings(self) -> DataFrame:
        kind = F.col("event_type")
        movement = F.when(kind == "purchase", 1).when(kind == "error", 2).when(kind == "click", 3).otherwise(0)
        return self.events.select(
            self.replay_date.alias("op_date"),
            F.col("event_id").alias("position"),
            F.col("user_id").alias("meter_id"),
            movement.alias("movement"),
            F.col("value").cast(schemas.QUANTITY).alias("value"),
        )

    @cached_property
    def ownership_moves(self) -> DataFrame:
        kind = F.col("event_type")
        return (
            self.events
            .where(kind.isin("signup", "error"))
            .select(
                day("ts").alias("op_date"),
                F.col("user_id").alias("property_id"),
                (F.col("event_id") % 7).alias("document"),
                F.when(kind == "signup", 1).otherwise(2).alias("action"),
            )
        )

    @cached_property
    def ownership(self) -> DataFrame:
        known = intervals.known_ownership(self.ownership_moves, self.properties, self.persons)
        return intervals.ownership_intervals(intervals.ownership_transitions(known))

    @cached_property
    def charge_moves(self) -> DataFrame:
        kind = F.col("event_type")
        return (
            self.events
            .where(kind.isin("view", "error"))
            .select(
                self.replay_date.alias("op_date"),
                F.col("user_id").alias("property_id"),
                (1 + F.col("event_id") % 8).cast("int").alias("charge_id"),
                F.when(kind == "view", 1).otherwise(2).alias("action"),
            )
        )

    @cached_property
    def assignments(self) -> DataFrame:
        known = intervals.known_charges(self.charge_moves, self.properties, self.charges)
        automatic = registry.automatic_charges(self.properties).withColumn("action", F.lit(1))
        return intervals.charge_intervals(known.unionByName(automatic))

    @cached_property
    def fiscal_changes(self) -> DataFrame:
        return (
            self.read("orders")
            .where(F.col("o_orderstatus") == "P")
            .select(
                day("o_orderdate").alias("op_date"),
                F.col("o_orderkey").alias("position"),
                F.col("o_custkey").alias("property_id"),
                money(F.col("o_totalprice")).alias("value"),
            )
        )

    @cached_property
    def op_dates(self) -> DataFrame:
        return self.read("orders").select(day("o_orderdate").alias("op_date")).distinct()

    @cached_property
    def gates(self) -> DataFrame:
        urgent = self.read("orders").where(F.col("o_orderpriority") == "1-URGENT")
        return urgent.select(day("o_orderdate").alias("op_date")).distinct()

    # -- invoices and payments ------------------------------------------------------------

    @cached_property
    def invoices(self) -> DataFrame:
        issued = day("o_orderdate")
        total = money(F.col("o_totalprice"))
        paid = F.col("o_orderstatus") == "F"
        return self.read("orders").select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("property_id"),
            issued.alias("invoice_date"),
            F.date_add(issued, 15).alias("due_date"),
            total.alias("original_total"),
            F.when(paid, money(total + F.col("o_orderkey") % 100)).otherwise(total).alias("final_total"),
            F.when(paid, 2).otherwise(1).alias("state"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_linenumber").alias("charge_id"),
            money(F.col("l_extendedprice")).alias("amount"),
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("description"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Stored payments of paid invoices; every seventh order has a second one three days later."""
        key = F.col("o_orderkey")
        shifts = F.when(key % 7 == 0, F.array(F.lit(0), F.lit(3))).otherwise(F.array(F.lit(0)))
        return (
            self.read("orders")
            .where(F.col("o_orderstatus") == "F")
            .select("o_orderkey", "o_orderdate", F.explode(shifts).alias("shift"))
            .select(
                key.alias("invoice_id"),
                F.date_add(day("o_orderdate"), ((key % 45) + F.col("shift")).cast("int")).alias("paid_on"),
                (1 + key % 2).cast("int").alias("method_id"),
            )
        )

    @cached_property
    def attempts(self) -> DataFrame:
        return self.shipped("R").select("property_id", F.col("shipped_on").alias("op_date"), "method_id", "reference")

    @cached_property
    def desk_attempts(self) -> DataFrame:
        """Payments made at the desk after the date of shipment, dated up to 39 days ahead; a batch per line number."""
        return self.shipped("A").select(
            "property_id",
            F.date_add("shipped_on", (F.col("l_orderkey") % 40).cast("int")).alias("op_date"),
            "method_id",
            "reference",
            F.concat(F.lit("desk "), F.col("l_linenumber").cast("string")).alias("batch"),
            F.col("l_linenumber").cast("int").alias("number"),
            F.col("shipped_on").alias("seen"),
        )

    def shipped(self, flag: str) -> DataFrame:
        """Lines of a return flag, read as payments of the order's customer."""
        lines = self.read("lineitem").where(F.col("l_returnflag") == flag).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
        owners = self.read("orders").select("o_orderkey", "o_custkey")
        number = F.col("l_linenumber").cast("string")
        return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("property_id"),
            day("l_shipdate").alias("shipped_on"),
            (1 + F.col("l_partkey") % 2).cast("int").alias("method_id"),
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), number).alias("reference"),
            "l_orderkey",
            "l_linenumber",
        )

    # -- derived state --------------------------------------------------------------------

    @cached_property
    def water_now(self) -> DataFrame:
        return service.must_have_water(self.properties, self.uses, self.assignments, self.charges)

    @cached_property
    def water_history(self) -> DataFrame:
        return service.water_intervals(self.properties, self.uses, self.assignments, self.charges)

    @cached_property
    def active_cuts(self) -> DataFrame:
        """Cut orders of one earlier date, all still active."""
        none = self.invoices.select("property_id").limit(0)
        pending = self.invoices.where("state = 1")
        return service.cut_orders_on(pending, self.water_now, none, F.lit(CUT_DATE))

    @cached_property
    def settled(self) -> tuple[DataFrame, DataFrame]:
        return settle(self.invoices, self.attempts)

    @cached_property
    def desk_settled(self) -> tuple[DataFrame, DataFrame]:
        return settle(self.invoices, self.attempts, desk=self.desk_attempts)

    @cached_property
    def cycle(self) -> DataFrame:
        hot = hot_keys(self.invoices, "property_id")
        return service.service_cycle(self.settled[0], self.water_history, self.gates, fee(), hot=hot)
