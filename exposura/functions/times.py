"""Date and time functions; all in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from exposura.functions.text import strip


def sanitize_date(c: Column) -> Column:
    """Zero dates become NULL; one blank between date and time becomes T."""
    s = strip(c)
    joined = F.regexp_replace(s, r"^([^ ]*-[^ ]*) ([^ ]*:[^ ]*)$", "$1T$2")
    bad = (s == "") | s.startswith("0000-00-00") | s.isin("0", "1/1/0001 12:00:00 AM")
    return F.when(~bad, joined)


def dmy_timestamp(c: Column) -> Column:
    """DD.MM.YYYY HH:MM:SS to ISO text, NULL when it is no such moment."""
    parsed = F.try_to_timestamp(strip(c), F.lit("dd.MM.yyyy HH:mm:ss"))
    return F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss")


def epoch_timestamp(c: Column) -> Column:
    seconds = c.try_cast("double") if hasattr(c, "try_cast") else c.cast("double")
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def run_duration(started: Column, finished: Column) -> Column:
    seconds = F.timestamp_diff("SECOND", started, finished)
    return F.coalesce(seconds.cast("string"), F.lit("running"))


def age_hours(now: Column, then: Column) -> Column:
    """Hours to one decimal."""
    return F.round((F.unix_timestamp(now) - F.unix_timestamp(then)) / F.lit(3600.0), 1)


def next_day(c: Column) -> Column:
    return F.date_add(F.to_date(c), 1)


def in_days(ts: Column, start: str | None = None, end: str | None = None) -> Column:
    """Open on either side; the end day is included whole."""
    out = F.lit(True)
    if start:
        out = out & (ts >= F.lit(start).cast("timestamp_ntz"))
    if end:
        out = out & (ts < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return out
