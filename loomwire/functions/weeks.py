"""Timestamps and week keys. Sessions are expected to run in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col


def parse_ts(text: Column | str) -> Column:
    """Timestamp of an ISO-8601 text, with or without offset; what cannot be parsed gives null."""
    return F.try_to_timestamp(_col(text))


def year_week(ts: Column | str, iso: bool = False) -> Column:
    """Week key ``YYYY-WW``: weeks start on Monday, week 00 lies before the year's first Monday.

    ``iso=True`` gives ISO-8601 weeks, which do not split at New Year.
    """
    ts = _col(ts)
    if iso:
        year, week = F.date_part(F.lit("YEAROFWEEK"), ts), F.weekofyear(ts)
    else:
        year, week = F.year(ts), F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7)
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))
