"""Inquiries over the billing state. Every one answers for all properties; a filter narrows it to one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.functions.money import money
from cadastra.functions.text import payment_reference
from cadastra.operators import arrears
from cadastra.rules import Rules


def only(df: DataFrame, property_id=None) -> DataFrame:
    """Optional property filter: no argument, no filter."""
    return df if property_id is None else df.where(F.col("property_id") == F.lit(property_id))


# -- properties -------------------------------------------------------------------------------


def owner_lists(ownership: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Open owners per property as one ordered text, documents cut to the width the rules set."""
    open_owners = ownership.where("end_date IS NULL").select(
        "property_id", F.substring(F.col("document").cast("string"), 1, rules.owner_document_width).alias("_doc")
    )
    return open_owners.groupBy("property_id").agg(
        F.expr("listagg(_doc, ', ') WITHIN GROUP (ORDER BY _doc)").alias("owners")
    )


def property_list(properties: DataFrame, ownership: DataFrame) -> DataFrame:
    """All properties with their owner list (null when nobody owns it)."""
    return properties.join(owner_lists(ownership), "property_id", "left")


def search_by_prefix(properties: DataFrame, ownership: DataFrame, prefix: str) -> DataFrame:
    """Properties whose id starts with ``prefix``; the filter reaches the scan of a text id."""
    kept = properties.where(F.col("property_id").cast("string").startswith(prefix))
    return property_list(kept, ownership)


def search_by_owner(properties: DataFrame, ownership: DataFrame, document) -> DataFrame:
    """Properties the person owns now, each with its full owner list."""
    owned = ownership.where(F.col("document") == F.lit(document)).where("end_date IS NULL").select("property_id")
    kept = properties.join(owned, "property_id", "left_semi")
    return property_list(kept, ownership.join(owned, "property_id", "left_semi"))


def search(properties: DataFrame, ownership: DataFrame, persons: DataFrame, q: str | None) -> tuple[int, DataFrame]:
    """Search box: empty text lists all, digits look up an owner, other text is a property prefix.

    Returns (code, rows); code 4 when the owner is unknown.
    """
    text = (q or "").strip(" \t\n\x0b\f\r")
    if text == "":
        return 0, property_list(properties, ownership)
    if not re.fullmatch("[0-9]+", text):
        return 0, search_by_prefix(properties, ownership, text)
    if persons.where(F.col("document") == F.lit(text)).isEmpty():
        return R.PERSON_UNKNOWN, search_by_owner(properties, ownership, text).limit(0)
    return 0, search_by_owner(properties, ownership, text)


def lookup_codes(requests: DataFrame, known: DataFrame, key: str, missing: int) -> DataFrame:
    """Requests with ``code``: 0 when the key exists, else ``missing``."""
    present = known.select(key).distinct().withColumn("_known", F.lit(True))
    return requests.join(present, key, "left").select(
        *requests.columns, F.when(F.col("_known").isNull(), F.lit(missing)).otherwise(F.lit(0)).alias("code")
    )


def property_profile(
    properties: DataFrame,
    uses: DataFrame,
    zones: DataFrame,
    ownership: DataFrame,
    persons: DataFrame,
    assignments: DataFrame,
    charges: DataFrame,
    property_id=None,
) -> dict[str, DataFrame]:
    """Property with use and zone names, its open owners, and every charge ever linked to it."""
    use = uses.select(F.col("id").alias("use_id"), F.col("name").alias("use_name"))
    zone = zones.select(F.col("id").alias("zone_id"), F.col("name").alias("zone_name"))
    catalog = charges.select("charge_id", F.col("name").alias("charge_name"))
    return {
        "property": only(properties, property_id).join(use, "use_id").join(zone, "zone_id"),
        "owners": only(ownership, property_id).where("end_date IS NULL").join(persons, "document"),
        "charges": only(assignments, property_id).join(catalog, "charge_id"),
    }


# -- invoices ---------------------------------------------------------------------------------


def payment_dates(payments: DataFrame) -> DataFrame:
    return payments.groupBy("invoice_id").agg(F.max("paid_on").alias("paid_on"))


def invoice_list(
    invoices: DataFrame,
    payments: DataFrame,
    water: DataFrame,
    active_cuts: DataFrame,
    on: Column,
    fee: Column,
    property_id=None,
    rules: Rules = Rules(),
) -> DataFrame:
    """Invoices with payment date and total as of ``on``; narrow it with ``property_id`` and sort there."""
    shown = arrears.simulated(only(invoices, property_id), water, active_cuts, on, fee, "list", rules)
    listed = shown.join(payment_dates(payments), "invoice_id", "left").select(
        "property_id", "invoice_id", "invoice_date", "due_date", "state", "paid_on", "original_total", "total"
    )
    return listed if property_id is None else listed.orderBy(F.desc("invoice_date"), F.desc("invoice_id"))


def invoice_headers(
    invoices: DataFrame,
    payments: DataFrame,
    properties: DataFrame,
    uses: DataFrame,
    zones: DataFrame,
    water: DataFrame,
    active_cuts: DataFrame,
    on: Column,
    fee: Column,
    rules: Rules = Rules(),
) -> DataFrame:
    """Detail headers of all invoices: dates, use and zone, interest, fee, computed and stored totals."""
    use = uses.select(F.col("id").alias("use_id"), F.col("name").alias("use_name"))
    zone = zones.select(F.col("id").alias("zone_id"), F.col("name").alias("zone_name"))
    place = (
        properties.select("property_id", "use_id", "zone_id").join(use, "use_id", "left").join(zone, "zone_id", "left")
    )
    return (
        arrears.simulated(invoices, water, active_cuts, on, fee, "detail", rules)
        .join(payment_dates(payments), "invoice_id", "left")
        .join(place.drop("use_id", "zone_id"), "property_id", "left")
        .select(
            "invoice_id",
            "property_id",
            "invoice_date",
            "due_date",
            "state",
            "paid_on",
            "use_name",
            "zone_name",
            on.alias("as_of"),
            "original_total",
            "interest",
            "fee",
            F.col("total").alias("computed_total"),
            F.col("final_total").alias("stored_total"),
        )
    )


def simulated_lines(headers: DataFrame, charges: DataFrame) -> DataFrame:
    """Extra lines of pending invoices: late interest and reconnection fee, each only when positive."""
    ids = charges.where(F.col("name").isin(R.LATE_INTEREST, R.RECONNECTION)).select(
        F.col("name").alias("charge_name"), "charge_id"
    )
    extras = F.array(
        F.struct(
            F.lit(R.LATE_INTEREST).alias("charge_name"),
            F.col("interest").alias("amount"),
            F.lit(R.INTEREST_TEXT).alias("description"),
        ),
        F.struct(
            F.lit(R.RECONNECTION).alias("charge_name"),
            F.col("fee").alias("amount"),
            F.lit(R.RECONNECTION_TEXT).alias("description"),
        ),
    )
    return (
        headers.where(arrears.is_pending())
        .select("invoice_id", F.explode(extras).alias("_extra"))
        .select("invoice_id", "_extra.*")
        .where("amount > 0")
        .join(ids, "charge_name", "left")
        .select("invoice_id", "charge_id", "charge_name", "amount", "description")
    )


def invoice_lines(lines: DataFrame, headers: DataFrame, charges: DataFrame) -> DataFrame:
    """Stored lines with charge names plus the simulated extras (sort by name and charge id to display)."""
    catalog = charges.select("charge_id", F.col("name").alias("charge_name"))
    stored = lines.join(catalog, "charge_id").select(
        "invoice_id", "charge_id", "charge_name", money(F.col("amount")).alias("amount"), "description"
    )
    return stored.unionByName(simulated_lines(headers, charges))


def payment_simulation(headers: DataFrame, invoices: DataFrame) -> DataFrame:
    """Headers of each property's oldest pending invoice: what a payment would cost."""
    return headers.join(oldest_ids(invoices), "invoice_id", "left_semi")


def oldest_ids(invoices: DataFrame) -> DataFrame:
    return arrears.oldest_pending(invoices).select("invoice_id")


def account_summary(invoices: DataFrame) -> DataFrame:
    """Per property: pending and paid counts, oldest pending invoice and the next payment reference."""
    pending = arrears.is_pending()
    oldest = F.min_by(
        F.when(pending, F.struct("invoice_date", "invoice_id")),
        F.when(pending, F.struct("invoice_date", "invoice_id")),
    )
    return (
        invoices.groupBy("property_id")
        .agg(
            F.count_if(pending).alias("pending"),
            F.count_if(~pending).alias("paid"),
            oldest.alias("_oldest"),
        )
        .select(
            "property_id",
            "pending",
            "paid",
            F.col("_oldest.invoice_id").alias("oldest_pending_id"),
            F.when(
                F.col("_oldest").isNotNull(), payment_reference(F.col("property_id"), F.col("_oldest.invoice_date"))
            ).alias("next_reference"),
        )
    )
