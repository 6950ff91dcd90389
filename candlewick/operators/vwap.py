"""Volume-weighted average price per event-time window; the same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.decode import encode_json


def vwap(
    ticks: DataFrame,
    window: str = "5 minutes",
    keys: Sequence[str] = ("symbol",),
    time_col: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """Sum of close * volume over sum of volume per tumbling window and key; null when the volume is zero.

    Two sums per group: rows are reduced before the shuffle, so a busy symbol or window does not skew it.
    """
    if watermark:
        ticks = ticks.withWatermark(time_col, watermark)
    return ticks.groupBy(F.window(time_col, window), *keys).agg(
        F.try_divide(F.sum(F.col("close") * F.col("volume")), F.sum("volume")).alias("vwap"))


# The names of the message fields.
def vwap_rows(windows: DataFrame) -> DataFrame:
    """Message form: window bounds as text in the session zone."""
    return windows.select(
        F.col("window.start").cast("string").alias("window_start"),
        F.col("window.end").cast("string").alias("window_end"),
        "symbol",
        "vwap",
    )


def encode_vwap(rows: DataFrame) -> DataFrame:
    """Kafka key and value. Windows without a price are left out; ``empty_windows`` has them."""
    return encode_json(rows.filter(F.col("vwap").isNotNull()), "symbol")


def empty_windows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("vwap").isNull())
