"""Date helpers: B1 parse, C15 month bucket / label, C16 rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

# Formats tried in order when the permissive cast fails.
DATE_FORMATS = (
    "yyyy/MM/dd[ HH:mm:ss]",
    "MMM d, yyyy[ HH:mm:ss]",
    "MMMM d, yyyy[ HH:mm:ss]",
    "d MMM yyyy[ HH:mm:ss][ XX]",
    "d MMMM yyyy[ HH:mm:ss][ XX]",
    "MM/dd/yyyy[ HH:mm:ss]",
    "yyyyMMdd",
)


def parse_date(c: Column, kind: str = "string", formats=DATE_FORMATS) -> Column:
    """B1: date or time of any common form -> UTC timestamp; else null.

    ``kind`` is the column's type name: dates and timestamps are taken as they
    are.  Strings go through a permissive cast first, then the formats.
    """
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return c.cast("timestamp")
    s = F.regexp_replace(F.trim(c.cast("string")), r"^(Mon|Tues?|Wed|Thu|Thurs|Fri|Sat|Sun)[a-z]*,? | (GMT|UTC)$", "")
    return F.coalesce(F.try_to_timestamp(s), *[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def month_end(c) -> Column:
    """The last day of the month (pandas ``freq='M'`` label)."""
    return F.last_day(F.col(c) if isinstance(c, str) else c)


def month_label(c) -> Column:
    """``yyyy-MM`` display label."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, L.MONTH_LABEL_FORMAT)


def pct1(c) -> Column:
    """Share as a percent with one decimal."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 100, 1)


def share10(c) -> Column:
    """Share rounded to 10 digits."""
    return F.round(F.col(c) if isinstance(c, str) else c, 10)
