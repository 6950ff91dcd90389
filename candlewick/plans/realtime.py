"""The real-time flow: candle updates -> ticks -> VWAP messages -> time-series records.

Every step maps a frame with the Kafka source's columns to one with ``key`` and ``value`` (or to records), for batch and
streaming frames alike. Where it reads from and writes to is the caller's choice (``sources.kafka``, ``streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions import epoch_ms_to_iso, epoch_seconds_to_time, parse_time, to_double
from candlewick.operators.decode import (
    candles_to_ticks, closed_candles, count_rejected, decode_candles, decode_json, decode_ticks, encode_json,
    is_heartbeat, usable_tick, valid_candles, valid_ticks,
)
from candlewick.operators.records import (
    IDENTITY, bucketed, latest_version, tick_record, usable_vwap, vwap_record,
)
from candlewick.operators.vwap import encode_vwap, vwap, vwap_rows
from candlewick.sources.files import replace_parts
from candlewick.sources.versions import compact_versions, create_versions

QUOTES = "quotes"
VWAPS = "vwap"


def candle_topic_to_ticks(records: DataFrame, symbol: Column | str | None = None) -> DataFrame:
    """Closed, usable candles as tick messages, keyed by symbol: a constant, a column of ``records`` (its key, say), or by
    default the symbol in the message."""
    named = "__symbol"
    if isinstance(symbol, Column):
        records, keep, symbol = records.withColumn(named, symbol), [named], F.col(named)
    else:
        keep = []
    return encode_json(candles_to_ticks(closed_candles(valid_candles(decode_candles(records, keep))), symbol), "symbol")


def clock_to_heartbeats(clock: DataFrame, lag: str = "1 minute") -> DataFrame:
    """Heartbeat messages for the tick topic from the ``timestamp`` of a rate source: each carries that time less ``lag``.

    ``lag``: how long a tick may take to reach the topic.
    """
    at = epoch_ms_to_iso(F.unix_millis(F.col("timestamp") - F.expr(f"INTERVAL {lag}")))
    return encode_json(clock.select(F.lit("heartbeat").alias("key"), at.alias("@timestamp")), "key", ["@timestamp"])


def tick_topic_to_windows(records: DataFrame, window: str = "5 minutes", watermark: str | None = "5 minutes",
                          heartbeat: bool = False) -> DataFrame:
    """Tick messages as VWAP per window and symbol. ``watermark`` has no effect on batch frames.

    ``heartbeat``: messages with a time and nothing else move the watermark, so the last windows of a topic without new ticks
    are finished too. They come through the topic like the ticks: read from far back, they still follow the ticks that were
    sent before them, which a clock in the query would overtake.
    """
    ticks = decode_ticks(records)
    if records.isStreaming:
        ticks = count_rejected(ticks, heartbeat=heartbeat)
        if heartbeat and watermark:
            # The metric also keeps the filter of the next step above the watermark.
            ticks = ticks.filter(usable_tick() | is_heartbeat()).withWatermark("event_time", watermark)
            ticks, watermark = ticks.observe("watermarked", F.max("event_time").alias("last")), None
    return vwap_rows(vwap(valid_ticks(ticks), window, watermark=watermark))


def tick_topic_to_vwap_topic(records: DataFrame, window: str = "5 minutes",
                             watermark: str | None = "5 minutes", heartbeat: bool = False) -> DataFrame:
    """Tick messages to VWAP messages, keyed by symbol."""
    return encode_vwap(tick_topic_to_windows(records, window, watermark, heartbeat))


def _messages(records: DataFrame, tick_topic: str, vwap_topic: str) -> DataFrame:
    """Messages of both topics, parsed in one pass, with the ``table`` they belong to; null if they give no record."""
    decoded = (
        decode_json(records, schemas.TICK_OR_VWAP, keep=["topic", "partition", "offset"])
        .withColumn("close", to_double("close"))
        .withColumn("volume", to_double("volume"))
        .withColumn("vwap", to_double("vwap"))
        .withColumn("event_time", parse_time("@timestamp"))
    )
    return decoded.withColumn("table", F.when((F.col("topic") == tick_topic) & usable_tick(), QUOTES)
                              .when((F.col("topic") == vwap_topic) & usable_vwap(), VWAPS))


def topics_to_records(records: DataFrame, tick_topic: str, vwap_topic: str, version: Column | None = None) -> DataFrame:
    """Messages of both topics as time-series records, routed by ``table`` (quotes, vwap), with their ``date``.

    One pass over the messages. Written with ``partition_by=("table", "date")`` each table is a folder. A replay has the
    same offsets and so replaces itself (``latest_records``).
    """
    good = _messages(records, tick_topic, vwap_topic).filter(F.col("table").isNotNull())
    record = F.when(F.col("table") == QUOTES, tick_record(tick_topic, version)).otherwise(
        vwap_record(vwap_topic, version))
    rows = good.select(record.alias("record"), "partition", "offset", "table")
    day = epoch_seconds_to_time(F.col("record.Time").cast("long") / 1000).cast("date")
    return rows.select("record.*", "partition", "offset", "table", day.alias("date"))


def latest_records(stored: DataFrame) -> DataFrame:
    """The last version of each record of ``topics_to_records``. A filter on ``table`` or ``date`` prunes the files.

    Within a partition of the topic the later offset wins, whatever the clocks say; only between partitions (after a topic
    got more of them) does the version decide. Rows of a bucketed table (``sources.create_versions``) are not shuffled if its buckets are small.
    """
    identity = bucketed(stored, ["table", "date", *IDENTITY])
    return latest_version(latest_version(stored, [*identity, "partition"], ["offset", "Version"]), identity, ["Version", "partition"])


def compact_records(spark: SparkSession, path: str, closed: Column) -> None:
    """Leave one row per record in the folders of ``table`` and ``date`` for which ``closed`` holds; see ``replace_parts``."""
    replace_parts(spark, latest_records(spark.read.parquet(path).filter(closed)), path, ["table", "date"], "records")


def create_record_table(spark: SparkSession, name: str, path: str, buckets: int = 64) -> None:
    """Bucketed catalog table for the rows of ``topics_to_records``: fill it with ``sources.versions_writer`` (or
    ``append_versions``), read it through ``latest_records(spark.table(name))``."""
    empty = spark.createDataFrame([], schemas.KAFKA_RECORD)
    create_versions(spark, name, path, topics_to_records(empty, "", "").schema, ["table", "date", *IDENTITY], ["table", "date"], buckets)


def compact_record_table(spark: SparkSession, name: str, closed: str) -> None:
    """Leave one row per record in the days for which ``closed``, a condition on ``table`` and ``date``, holds; see ``compact_versions``."""
    compact_versions(spark, name, closed, latest_records)


def rejected_messages(records: DataFrame, tick_topic: str, vwap_topic: str, heartbeat: bool = False) -> DataFrame:
    """Topic and text of the messages that give no record, with ``heartbeat`` without the heartbeats of the tick topic."""
    bad = F.col("table").isNull()
    if heartbeat:
        bad &= ~((F.col("topic").eqNullSafe(tick_topic)) & is_heartbeat())
    return _messages(records, tick_topic, vwap_topic).filter(bad).select("topic", "json")
