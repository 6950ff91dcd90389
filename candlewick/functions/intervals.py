"""Bar intervals: code -> start of the bucket a time falls into."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.functions.columns import as_column

# The interval codes of the data service. Minutes without a unit.
WINDOW_INTERVALS = {
    "1": "1 minute",
    "3": "3 minutes",
    "5": "5 minutes",
    "15": "15 minutes",
    "30": "30 minutes",
    "45": "45 minutes",
    "1H": "1 hour",
    "2H": "2 hours",
    "3H": "3 hours",
    "4H": "4 hours",
    "1D": "1 day",
}
CALENDAR_INTERVALS = {"1W": "week", "1M": "month"}
INTERVALS = (*WINDOW_INTERVALS, *CALENDAR_INTERVALS)


def bucket_start(time: Column | str, interval: str) -> Column:
    """Start of the interval bucket that holds ``time``.

    Up to a day the buckets count from the epoch; weeks start on Monday and months on day 1.
    """
    column = as_column(time)
    if interval in WINDOW_INTERVALS:
        return F.window(column, WINDOW_INTERVALS[interval])["start"]
    if interval in CALENDAR_INTERVALS:
        return F.date_trunc(CALENDAR_INTERVALS[interval], column)
    raise ValueError(f"unknown interval {interval!r}; known: {', '.join(INTERVALS)}")
