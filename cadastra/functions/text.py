"""Text helpers: search routing, owner lists, payment references, tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_null(value: Column, type_name: str) -> Column:
    """Parse text as a number; empty, malformed and zero values become null."""
    return F.nullif(value.try_cast(type_name), F.lit(0).cast(type_name))


def int_or_default(value: Column, default: int) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(default))


def search_route(q: Column) -> Column:
    """'all' for empty text, 'document' for digits only, else 'prefix'."""
    text = search_text(q)
    return F.when(text == "", "all").when(text.rlike("^[0-9]+$"), "document").otherwise("prefix")


def search_text(q: Column) -> Column:
    """What is searched for: white space around it does not count, be it blanks, tabs or line ends."""
    return F.regexp_replace(F.coalesce(q, F.lit("")), r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")


def split_owners(owner_list: Column) -> Column:
    """Owner list text back to an array; empty array when there are no owners."""
    parts = F.transform(F.split(owner_list, ","), lambda part: F.trim(part))
    return F.when(F.coalesce(owner_list, F.lit("")) == "", F.array().cast("array<string>")).otherwise(parts)


def payment_reference(property_id: Column, invoice_date: Column) -> Column:
    return F.concat(F.lit("RCTP-"), F.date_format(invoice_date, "yyyyMM"), F.lit("-"), property_id.cast("string"))
