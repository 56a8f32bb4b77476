"""Current state read from the logs: who owns what, which charges are active, what is pending."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.operators import intervals

Tables = Mapping[str, DataFrame]


def ownership(log: DataFrame) -> DataFrame:
    return intervals.ownership_intervals(log)


def assignments(log: DataFrame) -> DataFrame:
    return intervals.charge_intervals(log)


def invoices(invoice: DataFrame, payment: DataFrame) -> DataFrame:
    """Invoices with state and final total: paid ones carry the amount paid."""
    paid = payment.select("invoice_id", F.col("amount").alias("_amount"))
    return (
        invoice.withColumnRenamed("op_date", "invoice_date")
        .join(paid, "invoice_id", "left")
        .withColumn("final_total", F.coalesce("_amount", "original_total"))
        .withColumn("state", F.when(F.col("_amount").isNull(), R.PENDING).otherwise(R.PAID))
        .drop("_amount")
    )


def pending(invoice: DataFrame, payment: DataFrame) -> DataFrame:
    return invoice.withColumnRenamed("op_date", "invoice_date").join(payment, "invoice_id", "left_anti")


def payments(payment: DataFrame) -> DataFrame:
    return payment.withColumnRenamed("op_date", "paid_on")


def active_cuts(cut_open: DataFrame, cut_close: DataFrame) -> DataFrame:
    """Cut orders not closed; a cut is named by its property and invoice."""
    return cut_open.join(cut_close, ["property_id", "invoice_id"], "left_anti")


def cut_orders(cut_open: DataFrame, cut_close: DataFrame) -> DataFrame:
    """Cut orders with closing date and state (1 active, 2 closed)."""
    closed = cut_close.select("property_id", "invoice_id", F.col("op_date").alias("closed_on"))
    return (
        cut_open.withColumnRenamed("op_date", "created_on")
        .join(closed, ["property_id", "invoice_id"], "left")
        .withColumn("state", F.when(F.col("closed_on").isNull(), 1).otherwise(2))
    )


def latest(log: DataFrame, value: str, key: str = "property_id") -> DataFrame:
    """Last non-null value per key, by partial aggregation."""
    return log.where(F.col(value).isNotNull()).groupBy(key).agg(F.max_by(value, "op_date").alias(value))


def properties(t: Tables) -> DataFrame:
    """Properties with their current fiscal value, meter balance and consumption mark."""
    changed = latest(t["fiscal_log"], "value")
    return (
        t["property"]
        .join(changed, "property_id", "left")
        .join(latest(t["balance_log"], "balance"), "property_id", "left")
        .join(latest(t["invoice"], "water_mark"), "property_id", "left")
        .withColumn("fiscal_value", F.coalesce("value", "fiscal_value"))
        .withColumn("balance", F.coalesce("balance", F.lit(0)).cast("decimal(28,2)"))
        .withColumn("water_mark", F.coalesce("water_mark", F.lit(0)).cast("decimal(28,2)"))
        .drop("value")
    )


def compacted(t: Tables) -> dict[str, DataFrame]:
    """Logs without the rows that no later date needs; what a later date works out from them stays the same.

    Kept are listed persons and properties, the last open of each open ownership, the steps of charges (two per pair), the
    last fiscal value, balance and consumption mark of a property, pending invoices, cuts that are active, and payments and
    reconnections of invoices kept. Everything is one aggregate or join by property or invoice.
    """
    cuts = active_cuts(t["cut_open"], t["cut_close"])
    marked = t["invoice"].where("water_mark IS NOT NULL").groupBy("property_id")
    marks = marked.agg(F.max_by(F.struct(*t["invoice"].columns), "op_date").alias("_last")).select("_last.*")
    unpaid = t["invoice"].join(t["payment"], "invoice_id", "left_anti").select(*t["invoice"].columns)
    invoice = unpaid.unionByName(marks).dropDuplicates(["invoice_id"])
    settled = marks.select("invoice_id").unionByName(cuts.select("invoice_id")).distinct()
    opened = intervals.ownership_intervals(t["ownership_log"]).where("end_date IS NULL")
    return {
        "person": t["person"],
        "property": t["property"],
        "ownership_log": opened.select(F.col("start_date").alias("op_date"), "property_id", "document", F.lit(intervals.OPEN).alias("action")),
        "charge_log": t["charge_log"],
        "fiscal_log": last_row(t["fiscal_log"]),
        "balance_log": last_row(t["balance_log"]),
        "invoice": invoice,
        "payment": t["payment"].join(settled, "invoice_id", "left_semi"),
        "cut_open": cuts.select(*t["cut_open"].columns),
        "cut_close": t["cut_close"].limit(0),
        "reconnection": t["reconnection"].join(cuts.select("property_id", "invoice_id"), ["property_id", "invoice_id"], "left_semi"),
    }


def last_row(log: DataFrame) -> DataFrame:
    """The row of each property's last date."""
    return log.groupBy("property_id").agg(F.max_by(F.struct(*log.columns), "op_date").alias("_last")).select("_last.*")
