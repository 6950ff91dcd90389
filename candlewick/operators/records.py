"""Time-series records: dimensions, measures, time and version; and the rule that the last version wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import double_text, is_finite, iso_to_epoch_ms, now_epoch_ms
from candlewick.operators.decode import usable_tick

IDENTITY = ("Dimensions", "Time", "MeasureName")
#: Column by which tables of versions are bucketed: a hash of the identity.
BUCKET_KEY = "identity_hash"
#: Rows of a bucket that one task reduces without a shuffle; tables with more of them are shuffled, over as many tasks as they need.
ROWS_OF_A_BUCKET = 1_000_000

# Names and units of the record format.
TICK_MEASURE = "market_metrics"
VWAP_MEASURE = "aggregated_metrics"


def _dimensions(**values: Column) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("Name"), value.cast("string").alias("Value"))
                     for name, value in values.items()])


def _measures(**values: Column) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("Name"), double_text(value).alias("Value"), F.lit("DOUBLE").alias("Type"))
                     for name, value in values.items()])


def _wide(dimensions: Column, measure: str, measures: Column, millis: Column, version: Column | None) -> list[Column]:
    return [
        dimensions.alias("Dimensions"),
        F.lit(measure).alias("MeasureName"),
        measures.alias("MeasureValues"),
        F.lit("MULTI").alias("MeasureValueType"),
        millis.cast("string").alias("Time"),
        F.lit("MILLISECONDS").alias("TimeUnit"),
        (now_epoch_ms() if version is None else version).cast("long").alias("Version"),
    ]


def usable_vwap() -> Column:
    return is_finite("vwap") & iso_to_epoch_ms("window_end").isNotNull()


def tick_record(source_topic: str, version: Column | None = None) -> Column:
    """Record of a decoded tick with its price and volume, at its event time."""
    dims = _dimensions(symbol=F.col("symbol"), source_topic=F.lit(source_topic))
    values = _measures(close_price=F.col("close"), trade_volume=F.col("volume"))
    return F.struct(*_wide(dims, TICK_MEASURE, values, F.unix_millis("event_time"), version))


def vwap_record(source_topic: str, version: Column | None = None) -> Column:
    """Record of a VWAP message, at the end of its window."""
    dims = _dimensions(symbol=F.col("symbol"), window_start=F.col("window_start"), window_end=F.col("window_end"),
                       source_topic=F.lit(source_topic))
    values = _measures(vwap_value=F.col("vwap"))
    return F.struct(*_wide(dims, VWAP_MEASURE, values, iso_to_epoch_ms("window_end"), version))


def tick_records(ticks: DataFrame, source_topic: str, version: Column | None = None) -> DataFrame:
    """One record per usable tick. ``version`` defaults to the current time."""
    return ticks.filter(usable_tick()).select(tick_record(source_topic, version).alias("record")).select("record.*")


def vwap_records(rows: DataFrame, source_topic: str, version: Column | None = None) -> DataFrame:
    """One record per VWAP message with a price and a readable time."""
    return rows.filter(usable_vwap()).select(vwap_record(source_topic, version).alias("record")).select("record.*")


def narrow_records(df: DataFrame, dimensions: Sequence[str], measures: Sequence[str], time_ms: Column,
                   version: Column | None = None) -> DataFrame:
    """One record per row and measure column; null measures give no record."""
    prepared = df.select(
        _dimensions(**{name: F.col(name) for name in dimensions}).alias("Dimensions"),
        time_ms.cast("string").alias("Time"),
        (now_epoch_ms() if version is None else version).cast("long").alias("Version"),
        *[double_text(name).alias(name) for name in measures],
    )
    long = prepared.unpivot(["Dimensions", "Time", "Version"], list(measures), "MeasureName", "MeasureValue")
    return long.dropna(subset=["MeasureValue", "Time"]).select(
        "Dimensions", "MeasureName", "MeasureValue", F.lit("DOUBLE").alias("MeasureValueType"), "Time",
        F.lit("MILLISECONDS").alias("TimeUnit"), "Version")


def bucketed(rows: DataFrame, identity: Sequence[str]) -> list[str]:
    """``identity``, and the bucket key if the rows' buckets are small enough for a task each. The key's comment has their number."""
    if BUCKET_KEY not in rows.columns:
        return list(identity)
    number = rows.schema[BUCKET_KEY].metadata.get("comment", "")
    large = number.isdigit() and rows.count() > ROWS_OF_A_BUCKET * int(number)
    return list(identity) if large else [BUCKET_KEY, *identity]


def latest_version(records: DataFrame, identity: Sequence[str] = IDENTITY,
                   version: Sequence[str] = ("Version",)) -> DataFrame:
    """One row per identity: the one with the highest version. Rows are reduced before the shuffle."""
    others = [name for name in records.columns if name not in identity]
    best = F.max_by(F.struct(*others), F.struct(*version)).alias("__best")
    return records.groupBy(*identity).agg(best).select(
        *[F.col(f"__best.{name}").alias(name) if name in others else F.col(name) for name in records.columns])
