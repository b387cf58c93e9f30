"""Zone-free time functions.

Every bucket is built from the fields of a ``timestamp_ntz``. ``date_trunc`` and
``window`` go through the session time zone, which moves hours inside a daylight
saving gap, and ``window`` also drops NULL times.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

TimeLike = Column | datetime | str


def as_ntz(value: TimeLike) -> Column:
    """A ``timestamp_ntz`` column from a column, a ``datetime`` or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def utc_now() -> Column:
    """The current time as UTC wall clock, whatever the session time zone: it never goes back."""
    return F.expr("timestampadd(MICROSECOND, unix_micros(now()), timestamp_ntz'1970-01-01')")


def try_timestamp(text: Column) -> Column:
    """Parse text to ``timestamp_ntz``; NULL when it is no timestamp.

    An offset in the text is dropped, so the wall clock of the device is kept.
    """
    return text.try_cast("timestamp_ntz")


def hour_bucket(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def minute_bucket(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.lit(0)
    )


def day_bucket(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries between two times."""
    gap = minute_bucket(end) - minute_bucket(start)
    return gap.cast("interval minute").cast("bigint")


def before_by(ts: Column, seconds: int) -> Column:
    """The time ``seconds`` earlier than ``ts``."""
    return ts - F.expr(f"INTERVAL '{int(seconds)}' SECOND")


def within_last(ts: Column, as_of: TimeLike, hours: int) -> Column:
    """True for times later than ``as_of`` minus ``hours`` (strict bound)."""
    return ts > before_by(as_ntz(as_of), hours * 3600)
