"""The driver's tables in the shapes the operators take: ticks, bars, messages, captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions import epoch_ms_to_iso
from candlewick.operators import encode_json, ticks_to_bars
from candlewick.session import use_utc

TICK_TOPIC = "ticks"
VWAP_TOPIC = "vwap"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def as_ticks(events: DataFrame) -> DataFrame:
    """Event type as symbol, value as price, the number in props as volume; event_id orders equal times."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
        "event_id",
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def bars(spark: SparkSession, sf_dir: str, interval: str) -> DataFrame:
    return ticks_to_bars(ticks(spark, sf_dir), interval, tie="event_id")


def shipment_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars over several years: return flag as symbol, price and quantity of the shipped lines."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"), F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume"))
    return ticks_to_bars(lines, "1D", tie="close")


def kafka_records(df: DataFrame, topic: str, offset: Column, time: Column) -> DataFrame:
    """Rows of ``key`` and ``value`` as the Kafka source delivers them."""
    return df.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), offset.alias("offset"), time.alias("timestamp"))


def tick_messages(ticks: DataFrame, close: Column | None = None, volume: Column | None = None,
                  time: Column | None = None) -> DataFrame:
    """One tick message per tick, as the Kafka source delivers it. ``close``, ``volume``, ``time``: other text to send."""
    message = F.struct(
        F.col("symbol").alias("symbol"),
        F.coalesce(F.lit(None) if time is None else time, epoch_ms_to_iso(F.unix_millis("event_time"))).alias("@timestamp"),
        (F.col("close").cast("string") if close is None else close).alias("close"),
        (F.col("volume").cast("string") if volume is None else volume).alias("volume"),
    )
    return kafka_records(ticks.select(F.col("symbol").alias("key"), F.to_json(message).alias("value"), "event_id", "event_time"),
                  TICK_TOPIC, F.col("event_id"), F.col("event_time"))


def vwap_messages(rows: DataFrame) -> DataFrame:
    """One VWAP message per window and symbol."""
    encoded = encode_json(rows, "symbol", schemas.VWAP.fieldNames())
    return kafka_records(encoded, VWAP_TOPIC, F.lit(0).cast("long"), F.lit(None).cast("timestamp"))


def candle_messages(ticks: DataFrame) -> DataFrame:
    """Candle updates of a minute chart: an open candle per tick, and the closed candle of every minute."""
    def message(close: Column, volume: Column, closed: bool, start: Column) -> Column:
        candle = F.struct(
            F.lit("1m").alias("i"), close.cast("string").alias("c"), volume.cast("string").alias("v"),
            F.lit(closed).alias("x"), (F.unix_millis(start) + 59_999).alias("T"))
        return F.to_json(F.struct(F.lit("kline").alias("e"), candle.alias("k")))

    minute = F.date_trunc("minute", "event_time")
    updates = ticks.select("symbol", message(F.col("close"), F.col("volume"), False, minute).alias("value"))
    closed = ticks_to_bars(ticks, "1", tie="event_id")
    closes = closed.select("symbol", message(F.col("close"), F.col("volume"), True, F.col("datetime")).alias("value"))
    return updates.unionByName(closes)


def chart_captures(daily: DataFrame) -> DataFrame:
    """Raw chart text per symbol and month of daily bars: at most 31 bars each. A bar without volume leaves it out."""
    values = F.array(F.unix_seconds("datetime").cast("double"), "open", "high", "low", "close")
    with_volume = F.when(F.col("volume") > 0, F.concat(values, F.array("volume"))).otherwise(values)
    bar = F.struct(F.unix_seconds("datetime").alias("at"), with_volume.alias("v"))
    months = daily.groupBy("symbol", F.date_trunc("month", "datetime").alias("month")).agg(
        F.sort_array(F.collect_list(bar)).alias("bars"))
    series = F.to_json(F.transform("bars", lambda b, i: F.struct(i.alias("i"), b["v"].alias("v"))))
    return months.select("symbol", F.concat(
        F.lit('~m~400~m~{"m":"timescale_update","p":["cs_chart",{"sds_1":{"node":"1","s":'), series,
        F.lit(',"ns":{"d":"","indexes":[]},"t":"s1"}}]}'),
    ).alias("text"))
