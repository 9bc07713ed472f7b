"""Timestamp, period and date expressions."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F

# The accepted text forms and the sentinel for "no date".
ISO_FORM = r"^\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})?)?$"
MINUTE_FORM = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}Z$"
DIGITS = r"^\d+$"
ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_US_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
EPOCH_ISO = "1970-01-01T00:00:00.000Z"
MAX_EPOCH_MS = 253402300799999
SPINE_FLOOR = "2010-01-01T00:00:00Z"
YY_PIVOT_YEAR = 2068


def parse_any_ts(text: Column) -> Column:
    """Timestamp from ISO text (with or without fraction, zone, seconds) or epoch milliseconds.

    Anything else gives null, so that the caller can quarantine the row. Text
    ending in ``+00:00`` is read to whole seconds; other offsets convert to UTC.
    """
    text = text.cast("string")
    millis = text.try_cast("bigint")
    trimmed = F.when(text.endswith("+00:00"), F.substring(text, 1, 19)).otherwise(text)
    return (
        F.when(text.rlike(DIGITS), F.when(millis <= MAX_EPOCH_MS, F.timestamp_millis(millis)))
        .when(text.rlike(ISO_FORM), trimmed.try_cast("timestamp"))
        .when(text.rlike(MINUTE_FORM), F.regexp_replace(text, "Z$", ":00Z").try_cast("timestamp"))
    )


def iso_ms(ts: Column) -> Column:
    """ISO text truncated to milliseconds, with a ``Z``."""
    return F.date_format(ts, ISO_MS_FORMAT)


def unix_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_seconds(ts.cast("timestamp"))


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts.cast("timestamp"))


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts.cast("timestamp"))


def time_parts(ts: Column, prefix: str = "date_") -> list[Column]:
    """Year, month, day and hour columns of a timestamp."""
    return [
        F.year(ts).alias(f"{prefix}year"),
        F.month(ts).alias(f"{prefix}month"),
        F.dayofmonth(ts).alias(f"{prefix}day"),
        F.hour(ts).alias(f"{prefix}hour"),
    ]


def clamp(value: Column, *, low: Column | None = None, high: Column | None = None) -> Column:
    """Limit a value to [low, high]; a null value stays null."""
    limited = value
    if low is not None:
        limited = F.greatest(limited, low)
    if high is not None:
        limited = F.least(limited, high)
    return F.when(value.isNotNull(), limited)


def parse_us_date(text: Column, tag: Column, *, four_digit_tags, two_digit_tags) -> Column:
    """Date from ``M/d/yyyy`` or ``M/d/yy`` text, the form chosen by the row's tag.

    Two-digit years 69..99 belong to the 1900s. Blank text, an unknown tag or
    text in the wrong form give null.
    """
    tag = F.trim(tag)
    short = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.try_to_date(text, "M/d/yy"))
    pivoted = F.when(F.year(short) > YY_PIVOT_YEAR, F.add_months(short, -1200)).otherwise(short)
    full = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "M/d/yyyy"))
    return F.when(tag.isin(list(four_digit_tags)), full).when(tag.isin(list(two_digit_tags)), pivoted)


def not_after(day: Column, today: Column) -> Column:
    """Move a date that lies in the future back by a century."""
    return F.when(day > today, F.add_months(day, -1200)).otherwise(day)


@dataclass(frozen=True)
class Period:
    """One calendar month, in UTC."""

    year: int
    month: int

    @classmethod
    def of(cls, year: int = 0, month: int = 0, *, today: date | None = None) -> "Period":
        """The given month if both parts are positive, else the current UTC month."""
        if year > 0 and month > 0:
            return cls(year, month)
        today = today or datetime.now(timezone.utc).date()
        return cls(today.year, today.month)

    @property
    def begin(self) -> datetime:
        return datetime(self.year, self.month, 1)

    @property
    def end(self) -> datetime:
        last = calendar.monthrange(self.year, self.month)[1]
        return datetime(self.year, self.month, last, 23, 59, 59, 999999)

    def begin_col(self) -> Column:
        return ts_literal(self.begin)

    def end_col(self) -> Column:
        return ts_literal(self.end)


def ts_literal(value: datetime | str) -> Column:
    """UTC timestamp literal that does not depend on the driver's local zone."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return F.lit(value).cast("timestamp")
