"""Column expressions for names (P5) and epoch times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: Column) -> Column:
    """A name safe as a path segment: letters, digits and single inner underscores."""
    safe = F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_]", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.btrim(safe, F.lit("_")), F.lit("")), F.lit("unnamed"))


def seconds_to_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def time_to_seconds(time: Column) -> Column:
    """Whole epoch seconds; zone-less times count as session time, which is kept at UTC."""
    return F.unix_seconds(time.cast("timestamp"))


def time_to_millis(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def time_to_micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def millis_to_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)
