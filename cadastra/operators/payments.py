"""Payments: de-duplication, first-in-first-out matching with rejects, and the positional day batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra import rules as R
from cadastra.functions.money import late_interest, money, zero
from cadastra.operators.ledger import in_blocks, number_by_day, running
from cadastra.rules import Rules

ATTEMPT = ["property_id", "op_date", "method_id", "reference"]


def valid_attempts(attempts: DataFrame) -> DataFrame:
    """Attempts with property, method and reference; equal ones of a date count once."""
    complete = " AND ".join(f"{column} IS NOT NULL" for column in ATTEMPT)
    return attempts.select(*ATTEMPT).where(complete).distinct()


def incomplete_attempts(attempts: DataFrame, *more: str | Column) -> DataFrame:
    """Rejects for attempts that lack a key or a date, with ``more`` columns."""
    return attempts.where(" OR ".join(f"{column} IS NULL" for column in ATTEMPT)).select(
        "op_date",
        F.lit("payment").alias("step"),
        F.lit(R.NOTHING_PENDING).alias("code"),
        F.concat_ws("/", F.col("property_id").cast("string"), "reference").alias("key"),
        F.lit("payment without property, date, method or reference").alias("reason"),
        *more,
    )


#: A step of the ledger: a wide date's attempts are several blocks, one after the other.
STEP = ["property_id", "op_date", "phase", "block"]
#: What a desk's attempt carries besides ``ATTEMPT``: its batch, the batch's number, the last operation date the desk had seen.
DESK_ATTEMPT = [*ATTEMPT, "batch", "number", "seen"]


def with_desk(attempts: DataFrame, desk: DataFrame) -> DataFrame:
    """Valid attempts of the documents and of the desk in one table.

    A desk's attempt takes its turn after the operation date the desk had seen, which is ``op_date`` here; ``made_on`` is
    the date it bears. Attempts of one batch that are equal count once.
    """
    complete = " AND ".join(f"{column} IS NOT NULL" for column in ATTEMPT)
    made = desk.select(*DESK_ATTEMPT).where(complete).distinct().withColumnRenamed("op_date", "made_on").withColumnRenamed("seen", "op_date")
    return attempts.withColumn("made_on", F.col("op_date")).unionByName(made, allowMissingColumns=True)


def numbered_tries(attempts: DataFrame) -> DataFrame:
    """Attempts in steps (phase 0; the desk's 2; see ``STEP``). Payments of a date run before its invoices (phase 1), those of
    the desk after them in the order of the batches."""
    phase = F.when(F.col("batch").isNull(), 0).otherwise(2) if "batch" in attempts.columns else F.lit(0)
    return in_blocks(attempts.withColumn("phase", phase), ["property_id", "op_date", "phase"], turn_order(attempts), "block")


def turn_order(attempts: DataFrame) -> list[str]:
    """Order of the attempts of one step."""
    return [*(["number"] if "batch" in attempts.columns else []), "reference", "method_id"]


def as_steps(invoices: DataFrame) -> DataFrame:
    """Invoices in phase 1 of their date, which has one block.

    Rows without property or date are left out here already: otherwise the join with the ledger infers that filter for one
    of its two inputs only, and their shuffle is not shared.
    """
    return (
        invoices.withColumnRenamed("invoice_date", "op_date")
        .where("property_id IS NOT NULL AND op_date IS NOT NULL")
        .withColumns({"phase": F.lit(1), "block": F.lit(0)})
    )


def settlement_rows(invoices: DataFrame, attempts: DataFrame) -> DataFrame:
    """Attempts and invoices in one table, numbered inside (property, date, phase, block).

    Numbering stays inside one block of a day, so a property with any share of the rows is spread over its dates, and a
    date over blocks of its attempts.
    """
    events = numbered_tries(attempts).unionByName(as_steps(invoices), allowMissingColumns=True)
    in_step = Window.partitionBy(*STEP).orderBy(*turn_order(attempts), "invoice_id")
    return events.withColumn("in_step", F.row_number().over(in_step)).withColumn(
        "sibling_due", F.lead("due_date").over(in_step)
    )


def counted_steps(rows: DataFrame) -> DataFrame:
    """One row per (property, date, phase, block): how many rows, and the first due date."""
    return rows.groupBy(*STEP).agg(F.count(F.lit(1)).alias("n"), F.min("due_date").alias("due_date"))


#: Due date and date of the next invoice day.
NEXT = {"next_due": "due_date", "next_day": "CASE WHEN phase = 1 THEN op_date END"}


def settlement_ledger(steps: DataFrame) -> DataFrame:
    """One row per (property, date, phase, block): how many attempts pay, and where invoice ranks start.

    With A attempts and I invoices so far, the attempts rejected so far are R = max over steps of (A - I), floored
    at 0, and A - R have paid. Of the attempts of a step the first pay. Columns:

    * phases 0 and 2: ``before`` (attempts that paid earlier) and ``pays`` (how many of these do);
    * phase 1: ``before`` (invoices of earlier days), ``next_due`` and ``next_day`` (due date and date of the next invoice day).
    """
    ordered = running(["property_id"], STEP[1:])
    sorted_steps = Window.partitionBy("property_id").orderBy(*STEP[1:])
    is_attempt = F.col("phase") != 1
    following = f"lead({{}}) IGNORE NULLS OVER (PARTITION BY property_id ORDER BY {', '.join(STEP[1:])})"
    sums = steps.withColumns(
        {
            "tried": F.sum(F.when(is_attempt, F.col("n")).otherwise(0)).over(ordered),
            "issued": F.sum(F.when(is_attempt, 0).otherwise(F.col("n"))).over(ordered),
            **{name: F.expr(following.format(value)) for name, value in NEXT.items()},
        }
    )
    rejected = F.greatest(F.max(F.col("tried") - F.col("issued")).over(ordered), F.lit(0))
    paid_before = F.coalesce(F.lag("paid").over(sorted_steps), F.lit(0))
    return (
        sums.withColumn("paid", F.col("tried") - rejected)
        .withColumn("paid_before", paid_before)
        .select(
            *STEP,
            F.when(is_attempt, F.col("paid_before")).otherwise(F.col("issued") - F.col("n")).alias("before"),
            (F.col("paid") - F.col("paid_before")).alias("pays"),
            *NEXT,
        )
    )


def paired(rows: DataFrame, payer: dict[str, str]) -> DataFrame:
    """Invoices among the placed ``rows`` with ``rank`` and the columns ``payer`` of the attempt that pays them."""
    pays = (F.col("phase") == 1) | (F.col("in_step") <= F.col("pays"))
    # An attempt and the invoice it pays share (property, rank); the attempt sorts first.
    pair = Window.partitionBy("property_id", "rank").orderBy(F.col("phase") == 1)
    return (
        rows.where(pays)
        .withColumn("rank", F.col("before") + F.col("in_step"))
        .withColumns({name: F.lag(column).over(pair) for name, column in payer.items()})
        .where("phase = 1")
    )


def paired_by_day(invoices: DataFrame, tries: DataFrame, payer: dict[str, str]) -> DataFrame:
    """Like ``paired`` for ``invoices`` of which a property has at most one a date, placed ``tries`` aside.

    Such invoices are steps themselves: one window by property ranks them, and the paying attempts, no more than they are,
    come to their property as one list in the order of the ranks, which run from 1. So invoices are dealt out once.
    """
    of_property = Window.partitionBy("property_id").orderBy("invoice_date")
    placed = (F.col("before") + F.col("in_step")).alias("rank")
    paying = tries.where("in_step <= pays").select("property_id", F.struct(placed, *[F.col(c).alias(n) for n, c in payer.items()]).alias("_payer"))
    payers = paying.groupBy("property_id").agg(F.sort_array(F.collect_list("_payer")).alias("_payers"))
    ranked = invoices.where("property_id IS NOT NULL AND invoice_date IS NOT NULL").withColumns(
        {
            "rank": F.row_number().over(of_property).cast("bigint"),
            "sibling_due": F.lit(None).cast("date"),
            "next_due": F.expr("lead(due_date) IGNORE NULLS OVER (PARTITION BY property_id ORDER BY invoice_date)"),
            "next_day": F.lead("invoice_date").over(of_property),
        }
    )
    mine = F.get("_payers", (F.col("rank") - 1).cast("int"))
    return ranked.join(payers, "property_id", "left").withColumns({name: mine[name] for name in payer}).withColumnRenamed("invoice_date", "op_date")


def settle(
    invoices: DataFrame, attempts: DataFrame, rules: Rules = Rules(), desk: DataFrame | None = None, daily: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Match payment attempts to invoices, oldest invoice first.

    ``invoices``: invoice_id, property_id, invoice_date, due_date, original_total. ``attempts``: see ``ATTEMPT``.
    Returns (settled, rejects): ``settled`` is every invoice with paid_on, method_id, reference and interest (null
    while unpaid); ``rejects`` are the attempts that found nothing pending. An attempt sees the invoices dated
    before it. ``daily`` says that a property has at most one invoice a date, as generated ones, which need no invoice_id
    then: the result is the same, for one shuffle of the invoices and one of their dates.

    ``desk`` (``DESK_ATTEMPT``) are attempts made at the desk: each sees the invoices up to the date the desk had seen.
    Both results then also carry ``batch`` and ``settled_on``, the operation date after which a payment took its turn;
    ``next_due`` is that of an invoice that was there when the desk paid.
    """
    tries = valid_attempts(attempts)
    made, date = ([], "op_date") if desk is None else (["batch", "settled_on"], "made_on")
    if desk is not None:
        tries = with_desk(tries, desk)
    payer = {"paid_on": date, "method_id": "method_id", "reference": "reference"}
    if desk is not None:
        payer |= {"batch": "batch", "settled_on": "op_date"}
    if daily:
        turns = numbered_tries(tries)
        in_step = F.row_number().over(Window.partitionBy(*STEP).orderBy(*turn_order(tries)))
        counted = turns.groupBy(*STEP).agg(F.count(F.lit(1)).alias("n"))
        days = as_steps(invoices).select(*STEP, F.lit(1).cast("bigint").alias("n"))
        ledger = settlement_ledger(counted.unionByName(days).withColumn("due_date", F.lit(None).cast("date")))
        rows = turns.withColumn("in_step", in_step).join(ledger.where("phase <> 1").drop(*NEXT), STEP)
        found = paired_by_day(invoices, rows, payer)
    else:
        numbered = settlement_rows(invoices, tries)
        rows = numbered.join(settlement_ledger(counted_steps(numbered)), STEP)
        found = paired(rows, payer)
    next_due = F.col("next_due")
    if desk is not None:
        next_due = F.when(F.col("batch").isNull() | (F.col("next_day") <= F.col("settled_on")), next_due)
    interest = late_interest(F.col("original_total"), F.col("due_date"), F.col("paid_on"), rules)
    settled = (
        found.withColumn("next_due", F.coalesce("sibling_due", next_due))
        .withColumn("interest", F.when(F.col("paid_on").isNotNull(), interest))
        .withColumnRenamed("op_date", "invoice_date")
        .select(*invoices.columns, "rank", "next_due", "paid_on", "method_id", "reference", "interest", *made)
    )
    rejects = rows.where("phase <> 1 AND in_step > pays")
    if desk is not None:
        rejects = rejects.withColumnRenamed("op_date", "settled_on").withColumnRenamed("made_on", "op_date")
    rejects = rejects.select(*ATTEMPT, *made)
    check_strict(rejects, rules)
    return settled, rejects


def check_strict(rejects: DataFrame, rules: Rules) -> None:
    """With strict payments, the first attempt without a pending invoice stops the load."""
    if rules.strict_payments:
        first = rejects.agg(F.min("op_date").alias("d")).first()["d"]
        if first is not None:
            raise ValueError(f"payment without a pending invoice on {first} (code {R.NOTHING_PENDING})")


def payment_rejects(rejects: DataFrame, *more: str | Column) -> DataFrame:
    """Unmatched attempts in the shape of the reject table, with ``more`` columns."""
    return rejects.select(
        "op_date",
        F.lit("payment").alias("step"),
        F.lit(R.NOTHING_PENDING).alias("code"),
        F.concat_ws("/", F.col("property_id").cast("string"), "reference").alias("key"),
        F.lit("nothing pending").alias("reason"),
        *more,
    )


def numbered_attempts(attempts: DataFrame) -> DataFrame:
    """Attempts numbered from 1 inside (property, date), by reference and method; a wide date is numbered in blocks."""
    order = ["reference", "method_id"]
    rows = in_blocks(attempts.select(*ATTEMPT), ["property_id", "op_date"], order, "block")
    return number_by_day(rows, ["property_id", "op_date"], "block", order, "rank").drop("block")


def numbered_pending(pending: DataFrame) -> DataFrame:
    """Pending invoices numbered from 1 inside the property, oldest first."""
    return number_by_day(pending, ["property_id"], "invoice_date", ["invoice_id"], "rank")


def settle_batch(
    pending: DataFrame, attempts: DataFrame, on: Column, rules: Rules = Rules()
) -> tuple[DataFrame, DataFrame]:
    """Attempts of one date against the invoices pending then, whatever their date: the k-th pays the k-th oldest.

    Returns (settled, rejects) like ``settle``, with ``closes``: the payment leaves no overdue invoice pending.
    """
    bills = numbered_pending(pending)
    last = bills.where(F.col("due_date") < on).groupBy("property_id").agg(F.max("rank").alias("_last_overdue"))
    tries = numbered_attempts(valid_attempts(attempts))
    paying = tries.withColumnRenamed("op_date", "paid_on")
    interest = late_interest(F.col("original_total"), F.col("due_date"), F.col("paid_on"), rules)
    settled = (
        bills.join(paying, ["property_id", "rank"])
        .join(last, "property_id", "left")
        .withColumn("interest", interest)
        .withColumn("closes", F.coalesce("_last_overdue", F.lit(0)) <= F.col("rank"))
        .drop("_last_overdue")
    )
    rejects = tries.join(bills.select("property_id", "rank"), ["property_id", "rank"], "left_anti").select(*ATTEMPT)
    check_strict(rejects, rules)
    return settled, rejects


def positional_batch(pending: DataFrame, attempts: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """Day batch without reconnection fee: the k-th attempt of a property and date pays its k-th pending invoice.

    ``pending`` also carries final_total; every date is a batch of its own. Returns (matched, unmatched); the amount
    paid is the stored final total plus interest.
    """
    bills = numbered_pending(pending).select(
        "property_id", "rank", "invoice_id", "due_date", "original_total", "final_total"
    )
    joined = numbered_attempts(attempts).join(bills, ["property_id", "rank"], "left")
    interest = late_interest(F.col("original_total"), F.col("due_date"), F.col("op_date"), rules)
    matched = (
        joined.where("invoice_id IS NOT NULL")
        .withColumn("interest", interest)
        .withColumn("amount", money(F.col("final_total") + F.coalesce("interest", zero())))
    )
    return matched, joined.where("invoice_id IS NULL").select(*ATTEMPT)
