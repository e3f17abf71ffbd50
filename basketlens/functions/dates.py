"""Dates out of text that may not hold one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notations tried, in this order, on text that is not an ISO date.
DATE_FORMATS = ["M/d/yyyy"]
ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(\D|$)"


def parse_timestamp(text: Column, formats: list[str] | None = None) -> Column:
    """An ISO date with or without time, else the first format that fits, else null.

    A plain cast would read a time of day as that time today.
    """
    iso = F.when(text.rlike(ISO_DATE), text.try_cast("timestamp"))
    others = [F.try_to_timestamp(text, F.lit(f)) for f in formats or DATE_FORMATS]
    return F.coalesce(iso, *others)


def date_prefix(text: Column) -> Column:
    """The date in the first ten characters, else null."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
