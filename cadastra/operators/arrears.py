"""As-of arrears: late interest, last overdue invoice, simulated reconnection fee, oldest pending invoice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.functions.money import late_interest, money, zero
from cadastra.operators.skew import HOT_ROWS, hot_keys, spread_join
from cadastra.rules import Rules

MODES = ("pay", "list", "detail")


def is_pending() -> Column:
    return F.col("state") == R.PENDING


def oldest_pending(invoices: DataFrame, *columns: str) -> DataFrame:
    """Oldest pending invoice per property by (date, id); partial aggregation, so hot properties stay cheap."""
    kept = ["invoice_date", "invoice_id", *[c for c in columns if c not in ("invoice_date", "invoice_id")]]
    return (
        invoices.where(is_pending())
        .groupBy("property_id")
        .agg(F.min_by(F.struct(*kept), F.struct("invoice_date", "invoice_id")).alias("_oldest"))
        .select("property_id", "_oldest.*")
    )


def overdue_counts(invoices: DataFrame, on: Column) -> DataFrame:
    return (
        invoices.where(is_pending() & (F.col("due_date") < on))
        .groupBy("property_id")
        .agg(F.count(F.lit(1)).alias("overdue"))
    )


def is_last_overdue(on: Column) -> Column:
    """No *other* pending invoice is overdue; needs ``overdue`` (count per property, null for none)."""
    own = F.when(is_pending() & (F.col("due_date") < on), F.lit(1)).otherwise(F.lit(0))
    return F.coalesce("overdue", F.lit(0)) - own == 0


def last_overdue(invoices: DataFrame, on: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Invoices with the flag ``last_overdue`` at date ``on``: one count per property instead of a self anti join."""
    hot = hot_keys(invoices, "property_id", hot_rows)
    return (
        spread_join(invoices, overdue_counts(invoices, on), "property_id", "invoice_id", hot, "left")
        .withColumn("last_overdue", is_last_overdue(on))
        .drop("overdue")
    )


def with_fee(
    invoices: DataFrame,
    water: DataFrame,
    active_cuts: DataFrame,
    on: Column,
    fee: Column,
    mode: str = "list",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Invoices with the simulated ``fee`` at date ``on``.

    The fee needs water, an active cut and no other overdue pending invoice. ``list`` looks at every pending
    invoice, ``detail`` asks that the invoice itself be overdue, ``pay`` looks at the oldest pending one only.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    cut_off = active_cuts.select("property_id").distinct().join(water.select("property_id"), "property_id", "left_semi")
    standing = cut_off.join(overdue_counts(invoices, on), "property_id", "left").withColumn("_cut_off", F.lit(True))
    charged = F.coalesce("_cut_off", F.lit(False)) & is_pending() & is_last_overdue(on)
    if mode == "detail":
        charged = charged & (F.col("due_date") < on)
    if mode == "pay":
        first = oldest_pending(invoices).select("property_id", F.col("invoice_id").alias("_oldest_id"))
        standing = standing.join(first, "property_id")
        charged = charged & (F.col("invoice_id") == F.col("_oldest_id"))
    hot = hot_keys(invoices, "property_id", hot_rows)
    return (
        spread_join(invoices, standing, "property_id", "invoice_id", hot, "left")
        .withColumn("fee", F.when(charged, money(fee)).otherwise(zero()))
        .drop("_cut_off", "overdue", "_oldest_id")
    )


def with_interest(invoices: DataFrame, on: Column, rules: Rules = Rules()) -> DataFrame:
    """Pending invoices accrue interest up to ``on``; paid ones show 0."""
    accrued = late_interest(F.col("original_total"), F.col("due_date"), on, rules)
    return invoices.withColumn("interest", F.when(is_pending(), accrued).otherwise(zero()))


def simulated(
    invoices: DataFrame,
    water: DataFrame,
    active_cuts: DataFrame,
    on: Column,
    fee: Column,
    mode: str = "list",
    rules: Rules = Rules(),
) -> DataFrame:
    """Invoices with interest, fee and ``total`` as of ``on`` (paid invoices keep their stored final total)."""
    priced = with_interest(with_fee(invoices, water, active_cuts, on, fee, mode), on, rules)
    due = money(F.col("original_total") + F.col("interest") + F.col("fee"))
    return priced.withColumn("total", F.when(is_pending(), due).otherwise(F.col("final_total")))
