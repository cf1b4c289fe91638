"""Date/time functions (DT-01..07). Session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.text import _c, ColumnOrName


# a date, alone or with a time of minutes, seconds or fractions and an offset
ISO_SHAPE = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
             r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$")
DAY_IN_TEXT = r"\b(20[0-9]{2}-[0-9]{2}-[0-9]{2})\b"


def parse_iso(c: ColumnOrName) -> Column:
    """DT-01/03: ISO-8601 date or date and time, with offset, 'Z' or naive (naive = UTC).

    The shape is checked first, so nothing depends on the clock; a time without seconds is
    given them, as Spark's parser wants them before an offset.
    """
    s = _c(c)
    full = F.regexp_replace(s, r"([T ][0-9]{2}:[0-9]{2})(Z|[+-][0-9]{2}.*)$", "$1:00$2")
    full = F.regexp_replace(F.replace(full, F.lit(","), F.lit(".")), r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    full = F.regexp_replace(full, r"(:[0-9]{2}(?:[.][0-9]+)?[+-][0-9]{2})$", "$1:00")
    return F.when(s.rlike(ISO_SHAPE), F.try_to_timestamp(full))


def parse_iso_or_date(c: ColumnOrName) -> Column:
    """DT-02: ISO parse, else the first whole word 20YY-MM-DD in the text at midnight UTC."""
    day = F.nullif(F.regexp_extract(_c(c), DAY_IN_TEXT, 1), F.lit(""))
    return F.coalesce(parse_iso(c), F.try_to_timestamp(day, F.lit("yyyy-MM-dd")))


def to_epoch_ms(c: ColumnOrName) -> Column:
    """DT-04: timestamp -> epoch milliseconds (UTC)."""
    return F.unix_millis(_c(c).cast("timestamp"))


def from_epoch_ms(c: ColumnOrName) -> Column:
    """DT-04: epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(c))


def clamp_cutoff(saved: ColumnOrName, now: Column, hours: int = specs.LOOKBACK_HOURS) -> Column:
    """DT-06: max(saved cutoff, now - lookback); missing saved -> now - lookback."""
    floor = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    return F.greatest(_c(saved), floor)


def display_date(ts: ColumnOrName, raw: ColumnOrName) -> Column:
    """DT-07: 'yyyy-MM-dd HH:mm' when the value parses, else the raw text."""
    return F.coalesce(F.date_format(_c(ts), "yyyy-MM-dd HH:mm"), _c(raw).cast("string"))


def minute_prefix(c: ColumnOrName) -> Column:
    """STR-12: first 16 characters of a date string (offset dropped)."""
    return F.substring(_c(c), 1, 16)
