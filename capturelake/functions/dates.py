"""Dates of records: 14 digits or ISO with seconds and Z."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(s: Column) -> Column:
    """A UTC timestamp of either form, null for others (the session's zone must be UTC)."""
    return F.when(s.rlike(r"^\d{14}$"), F.try_to_timestamp(s, F.lit("yyyyMMddHHmmss"))).when(
        s.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"), F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )


def shown(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_millis(x: Column) -> Column:
    return F.timestamp_millis(x)
