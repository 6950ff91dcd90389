"""The long-running jobs over Kafka. Each returns its started queries; a query has a checkpoint of its own.

``source`` goes to ``kafka.read_stream``: ``max_offsets_per_trigger`` keeps a start from far back from becoming one huge
micro-batch, ``min_partitions`` splits busy topic partitions, ``options`` holds any others of the Kafka source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.decode import decode_ticks, is_heartbeat, rejected_ticks
from candlewick.operators.vwap import encode_vwap
from candlewick.plans import realtime
from candlewick.session import require_utc
from candlewick.sources import kafka
from candlewick.sources.kafka import KafkaConfig
from candlewick.streaming.lifecycle import start
from candlewick.streaming.sinks import append_writer, parquet_writer


def start_ticks(spark: SparkSession, config: KafkaConfig, candle_topic: str, tick_topic: str,
                symbol: Column | str | None, checkpoint: str, starting_offsets: str = "latest",
                source: Mapping[str, object] | None = None, **trigger) -> list[StreamingQuery]:
    """Candle updates to ticks of closed candles. ``symbol``: a constant, a column, or None for the one in the message."""
    require_utc(spark)
    candles = kafka.read_stream(spark, config, candle_topic, starting_offsets=starting_offsets, **(source or {}))
    ticks = realtime.candle_topic_to_ticks(candles, symbol)
    return [start(kafka.stream_writer(ticks, config, tick_topic, checkpoint), "ticks", **trigger)]


def start_heartbeats(spark: SparkSession, config: KafkaConfig, tick_topic: str, checkpoint: str, seconds: int = 60,
                     lag: str = "1 minute", **trigger) -> list[StreamingQuery]:
    """A heartbeat into the tick topic every so many ``seconds``, for ``start_vwap(heartbeat=True)``; ``lag`` as in ``clock_to_heartbeats``."""
    require_utc(spark)
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load().filter(F.col("value") % seconds == 0)
    return [start(kafka.stream_writer(realtime.clock_to_heartbeats(clock, lag), config, tick_topic, checkpoint), "heartbeats", **trigger)]


def start_vwap(spark: SparkSession, config: KafkaConfig, tick_topic: str, vwap_topic: str, checkpoint: str,
               output_mode: str = "append", window: str = "5 minutes", watermark: str = "5 minutes",
               rejects: str | None = None, starting_offsets: str = "latest",
               source: Mapping[str, object] | None = None, files: int | None = None, heartbeat: bool = False,
               **trigger) -> list[StreamingQuery]:
    """Ticks to VWAP messages.

    ``append`` sends a window once, after the watermark has passed its end; ``update`` sends it on every change, and the
    readers keep the last one. ``rejects``: folder for the messages that are no usable ticks, kept by a second query, which
    ``files`` tasks write. ``heartbeat``: the topic has heartbeats (``start_heartbeats``), which finish the windows of a
    topic without new ticks.
    """
    require_utc(spark)
    records = kafka.read_stream(spark, config, tick_topic, starting_offsets=starting_offsets, **(source or {}))
    windows = realtime.tick_topic_to_windows(records, window, watermark, heartbeat)
    queries = [start(kafka.stream_writer(encode_vwap(windows), config, vwap_topic, checkpoint, output_mode), "vwap",
                     **trigger)]
    if rejects is not None:
        bad = rejected_ticks(decode_ticks(records, keep=["topic", "partition", "offset"]))
        if heartbeat:
            bad = bad.filter(~is_heartbeat())
        bad = bad.select("topic", "partition", "offset", "json")
        queries.append(start(parquet_writer(bad, rejects, f"{checkpoint}-rejects", files=files), "vwap-rejects", **trigger))
    return queries


def start_records(spark: SparkSession, config: KafkaConfig, tick_topic: str, vwap_topic: str, path: str,
                  checkpoint: str, rejects: str | None = None, starting_offsets: str = "latest",
                  source: Mapping[str, object] | None = None, files: int | None = None, heartbeat: bool = False,
                  **trigger) -> list[StreamingQuery]:
    """Both topics to the record tables ``table=quotes`` and ``table=vwap`` below ``path``, by date.

    Read them through ``latest_records``. ``heartbeat``: heartbeats are no rejected messages.
    """
    require_utc(spark)
    topics = kafka.read_stream(spark, config, tick_topic, vwap_topic, starting_offsets=starting_offsets, **(source or {}))
    records = realtime.topics_to_records(topics, tick_topic, vwap_topic)
    queries = [start(append_writer(records, path, checkpoint, partition_by=["table", "date"], files=files), "records", **trigger)]
    if rejects is not None:
        bad = realtime.rejected_messages(topics, tick_topic, vwap_topic, heartbeat)
        queries.append(start(parquet_writer(bad, rejects, f"{checkpoint}-rejects", files=files), "records-rejects", **trigger))
    return queries
