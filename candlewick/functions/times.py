"""Time conversions as column expressions. All text without a zone is read and written in the session zone (UTC).

Usable times lie from ``EARLIEST`` up to ``LATEST`` (exclusive): what lies outside is a mistake of the sender and would move a
watermark for good or overflow a window, so the conversions give null for it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.functions.columns import as_column

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EARLIEST = dt.datetime(1900, 1, 1, tzinfo=dt.timezone.utc)
LATEST = dt.datetime(2200, 1, 1, tzinfo=dt.timezone.utc)
_FIRST_SECOND, _END_SECOND = (int(t.timestamp()) for t in (EARLIEST, LATEST))
# A date and a time of day, then anything that the parser takes (fractions, a zone).
_DATE_AND_TIME = r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}"


def usable_time(time: Column | str) -> Column:
    """The time itself, or null outside the usable range."""
    column = as_column(time)
    return F.when((column >= F.timestamp_seconds(F.lit(_FIRST_SECOND))) & (column < F.timestamp_seconds(F.lit(_END_SECOND))), column)


def parse_time(text: Column | str) -> Column:
    """ISO text with date and time of day to timestamp; null for other text and for times out of range."""
    column = as_column(text)
    return usable_time(F.try_to_timestamp(F.when(column.rlike(_DATE_AND_TIME), column)))


def iso_to_epoch_ms(text: Column | str) -> Column:
    """ISO text to epoch milliseconds; null for text that is no time."""
    return F.unix_millis(parse_time(text))


def epoch_ms_to_time(millis: Column | str) -> Column:
    """Epoch milliseconds to timestamp; null out of range."""
    column = as_column(millis)
    return F.timestamp_millis(F.when((column >= _FIRST_SECOND * 1000) & (column < _END_SECOND * 1000), column))


def epoch_ms_to_iso(millis: Column | str) -> Column:
    """Epoch milliseconds to ISO text, cut to whole seconds; null out of range."""
    return F.date_format(epoch_ms_to_time(millis), ISO_SECONDS)


def epoch_seconds_to_time(seconds: Column | str) -> Column:
    """Epoch seconds to timestamp; null out of range."""
    column = as_column(seconds)
    return F.timestamp_seconds(F.when((column >= _FIRST_SECOND) & (column < _END_SECOND), column))


def instant(bound: dt.datetime | dt.date | str | Column) -> Column:
    """A bound of a time range as an instant: with a zone it is that moment, without one it is read in the session zone.

    (A literal made from a ``datetime`` without zone would be read in the zone of the driver's host.)
    """
    if isinstance(bound, Column):
        return bound
    if isinstance(bound, dt.datetime) and bound.tzinfo is not None:
        bound = bound.astimezone(dt.timezone.utc)
    text = bound if isinstance(bound, str) else bound.isoformat()
    return F.to_timestamp(F.lit(text))


def now_epoch_ms() -> Column:
    """Current time in epoch milliseconds, one value per query (per micro-batch in a stream)."""
    return F.unix_millis(F.current_timestamp())
