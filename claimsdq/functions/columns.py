"""Small Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def folder_prefix(path: Column) -> Column:
    """``claims/x.csv`` -> ``claims/``; a name without ``/`` stays as it is."""
    return F.when(path.contains("/"), F.concat(F.split_part(path, F.lit("/"), F.lit(1)), F.lit("/"))) \
        .otherwise(path)


def ratio_pct(num: Column, den: Column) -> Column:
    """num / den * 100, or 0 when den is 0 (the reference's guard)."""
    return F.when(den > 0, num.cast("double") / den.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def utc_ntz(ts: Column) -> Column:
    """An instant as its UTC wall clock (whole seconds), whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(ts), epoch)


def hour_bucket(ts: Column) -> Column:
    """Hour start of a TIMESTAMP_NTZ value, kept TIMESTAMP_NTZ (``date_trunc``
    yields a session-zone timestamp; the cast back keeps the wall clock)."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def period_bucket(ts: Column, seconds: int) -> Column:
    """Start of the fixed ``seconds``-wide period holding ``ts`` (epoch aligned)."""
    if seconds == 3600:
        return hour_bucket(ts)
    if seconds == 86400:
        return F.date_trunc("day", ts).cast("timestamp_ntz")
    return F.window(ts, f"{seconds} seconds").start
