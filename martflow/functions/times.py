"""Dates, month keys and feed times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

LONDON = "Europe/London"


def parse_date(col: Column, fmt: str | None = None) -> Column:
    """A date, or null where the text is none."""
    return F.try_to_date(col, fmt) if fmt else col.try_cast("date")


def lenient_ts(col: Column) -> Column:
    """A timestamp read as UTC, or null where the value is none."""
    return col.try_cast("timestamp")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_key(ts: Column) -> Column:
    return F.to_date(ts)


def on_day(ts: Column, ds: str | dt.date) -> Column:
    """Rows of one calendar day; Catalyst turns it into a pushed-down range."""
    return F.to_date(ts) == F.lit(str(ds)).cast("date")


def since(ts: Column, now: Column, days: int = 7) -> Column:
    """Strictly later than ``days`` days before ``now``."""
    return ts > now - F.make_dt_interval(days=F.lit(days))


def epoch_ms(col: Column) -> Column:
    """The instant of an epoch-millisecond text; null where it is none."""
    return F.timestamp_millis(col.try_cast("bigint"))


def epoch_ms_to_london(col: Column) -> Column:
    """UK wall-clock time (without zone) of an epoch-millisecond text."""
    wall_here = epoch_ms(col).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(LONDON), wall_here)


def epoch_ms_to_london_text(col: Column) -> Column:
    """UK wall-clock time with its offset, e.g. ``2024-07-01 13:00:00+01:00``."""
    wall = epoch_ms_to_london(col)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), epoch_ms(col).cast("timestamp_ntz"))
    offset = F.when(wall == utc, "+00:00").otherwise("+01:00")
    # Formatted once; the fraction holds the only dot.
    text = F.replace(F.date_format(wall, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(".000000"), F.lit(""))
    return F.concat(text, offset)
