"""Time texts that do not pass through the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def time_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``"""
    return F.substring(moment.try_cast("timestamp_ntz").cast("string"), 1, 19)


def parse_time(text: Column) -> Column:
    """ISO or dd/MM/yyyy text, with or without a time, to a timestamp; NULL when it is neither."""
    iso = F.regexp_replace(F.trim(text), r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")
    return iso.try_cast("timestamp_ntz")
