"""Messages to typed rows and back. Inputs have the columns of Spark's Kafka source; ``value`` may be bytes or text.

Everything here is a row-wise expression, so it works the same on batch and streaming frames and needs no shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas
from candlewick.functions import (
    epoch_ms_to_iso, epoch_ms_to_time, epoch_seconds_to_time, instant, is_finite, parse_time, to_double, volume_or_zero,
)

PRICES = ("open", "high", "low", "close")
# Fixed value: what precedes each payload on the wire.
FRAME_HEADER = r"~m~\d+~m~"


def _parsed_once(df: DataFrame, name: str | None = None) -> DataFrame:
    """Keeps later filters above this point, counting the rows as observed metric ``name``.

    Spark moves a filter below the projection it refers to and so repeats the projection's expressions: a check of three
    fields would parse every message four times.
    """
    return df.observe(name or f"messages-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def decode_json(records: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``value`` as JSON, one column per schema field, with the raw text in ``json``. Bad JSON gives null fields."""
    text = F.col("value").cast("string")
    parsed = records.select(*keep, text.alias("json"), F.from_json(text, schema).alias("data"))
    return _parsed_once(parsed).select(*keep, "json", "data.*")


def encode_json(df: DataFrame, key: str, value_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows to Kafka ``key`` and ``value``: the key column as text, all columns as a JSON object without null fields."""
    fields = [F.col(f"`{name}`") for name in value_columns or df.columns]
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def decode_ticks(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Tick messages with ``close`` and ``volume`` as doubles and the ``event_time``; null where a field is unusable."""
    return (
        decode_json(records, schemas.TICK, keep)
        .withColumn("close", to_double("close"))
        .withColumn("volume", to_double("volume"))
        .withColumn("event_time", parse_time("@timestamp"))
    )


def usable_tick() -> Column:
    """A finite price and volume, and a time in the usable range."""
    return is_finite("close") & is_finite("volume") & F.col("event_time").isNotNull()


def valid_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.filter(usable_tick())


def rejected_ticks(ticks: DataFrame) -> DataFrame:
    """The ticks ``valid_ticks`` leaves out, with their raw text."""
    return ticks.filter(~usable_tick())


def is_heartbeat() -> Column:
    """A tick message with a time and nothing else: it says that all ticks before that time have been sent."""
    return F.col("event_time").isNotNull() & F.coalesce("symbol", F.col("close").cast("string"), F.col("volume").cast("string")).isNull()


def count_rejected(ticks: DataFrame, name: str = "ticks", heartbeat: bool = False) -> DataFrame:
    """Counts all and rejected ticks on the way, as observed metrics (in a stream: part of each progress report).

    ``heartbeat``: heartbeats are counted too, apart from the rejected.
    """
    if not heartbeat:
        return ticks.observe(name, F.count(F.lit(1)).alias("all"), F.count_if(~usable_tick()).alias("rejected"))
    return ticks.observe(name, F.count(F.lit(1)).alias("all"), F.count_if(~usable_tick() & ~is_heartbeat()).alias("rejected"),
                         F.count_if(is_heartbeat()).alias("heartbeats"))


def decode_candles(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return decode_json(records, schemas.CANDLE, keep)


def closed_candles(candles: DataFrame) -> DataFrame:
    return candles.filter(F.col("k.x"))


def usable_candle() -> Column:
    """A finite price and volume, and a close time in the usable range."""
    return is_finite(to_double("k.c")) & is_finite(to_double("k.v")) & epoch_ms_to_time("k.T").isNotNull()


def valid_candles(candles: DataFrame) -> DataFrame:
    return candles.filter(usable_candle())


def rejected_candles(candles: DataFrame) -> DataFrame:
    """The updates ``valid_candles`` leaves out, with their raw text; messages that are no candle at all among them."""
    return candles.filter(~usable_candle())


def candle_preview(candles: DataFrame) -> DataFrame:
    """Interval, close and volume of each candle update."""
    return candles.select(F.col("k.i").alias("interval"), F.col("k.c").alias("close"), F.col("k.v").alias("volume"))


def candles_to_ticks(candles: DataFrame, symbol: Column | str | None = None) -> DataFrame:
    """One tick per candle at its close time in whole seconds; price and volume stay text.

    ``symbol``: a constant or a column; by default the symbol that the message names (``k.s``).
    """
    name = F.col("k.s") if symbol is None else F.lit(symbol) if isinstance(symbol, str) else symbol
    return candles.select(
        name.alias("symbol"),
        epoch_ms_to_iso("k.T").alias("@timestamp"),
        F.col("k.c").alias("close"),
        F.col("k.v").alias("volume"),
    )


def _frames(captures: DataFrame, text_col: str) -> tuple[list[str], DataFrame]:
    """One row per frame of the captured text, its place in ``__at`` and its payload in ``__frame``.

    A frame is a header with its length, then the payload; text without a header is one payload.
    """
    others = [name for name in captures.columns if name != text_col]
    payloads = F.split(F.col(text_col), FRAME_HEADER)
    return others, captures.select(*others, F.posexplode(payloads).alias("__at", "__frame")).filter("trim(__frame) <> ''")


def chart_messages(captures: DataFrame, text_col: str = "text") -> DataFrame:
    """``method`` and ``params`` (JSON) of raw chart-service messages, one row per message; other text gives no row."""
    others, frames = _frames(captures, text_col)
    fields = F.json_tuple("__frame", "m", "p").alias("method", "params")
    return _parsed_once(frames.select(*others, fields)).filter(F.col("method").isNotNull() & F.col("params").isNotNull())


def _chart_rows(captures: DataFrame, text_col: str) -> DataFrame:
    """The bars of each capture's first series block, usable or not: the captures' other columns, the bar's fields, ``__bar``."""
    others, frames = _frames(captures, text_col)
    message = F.from_json("__frame", schemas.CHART_MESSAGE)
    found = _parsed_once(frames.select(*others, "__at", message.alias("__message")))
    # The parameters are the session and an object that holds series by name.
    series = F.from_json(F.get("__message.p", F.lit(1)), schemas.CHART_SERIES)
    block = F.get(F.filter(F.map_values(series), lambda s: s["s"].isNotNull()), F.lit(0))["s"]
    blocks = found.select(*others, "__at", block.alias("__bars")).filter("__bars IS NOT NULL")
    bars = blocks.select(*others, "__at", F.explode("__bars").alias("__bar"))
    return bars.select(
        *others,
        epoch_seconds_to_time(to_double(F.get("__bar.v", F.lit(0)))).alias("datetime"),
        *[to_double(F.get("__bar.v", F.lit(i))).alias(name) for i, name in enumerate(PRICES, start=1)],
        volume_or_zero(F.get("__bar.v", F.lit(5))).alias("volume"),
        F.to_json("__bar").alias("__bar"),
    )


def _usable_bar() -> Column:
    usable = F.col("datetime").isNotNull()
    for name in PRICES:
        usable &= is_finite(name)
    return usable


def chart_bars(captures: DataFrame, text_col: str = "text") -> DataFrame:
    """Bars of the first series of each message of each capture, with the captures' other columns in front.

    A missing volume is 0.0. A bar with an unusable time or price is left out (``rejected_chart_bars``), and no bar affects
    another.
    """
    return _chart_rows(captures, text_col).filter(_usable_bar()).drop("__bar")


def rejected_chart_bars(captures: DataFrame, text_col: str = "text") -> DataFrame:
    """The bars ``chart_bars`` leaves out, as JSON in ``bar``."""
    others = [name for name in captures.columns if name != text_col]
    return _chart_rows(captures, text_col).filter(~_usable_bar()).select(*others, F.col("__bar").alias("bar"))


def with_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """A constant ``symbol`` column in front."""
    return df.select(F.lit(symbol).alias("symbol"), "*")


def time_range(df: DataFrame, start, end, time_col: str = "datetime") -> DataFrame:
    """Rows with start <= time < end. Bounds without a zone are read in the session zone, wherever the driver runs."""
    return df.filter((F.col(time_col) >= instant(start)) & (F.col(time_col) < instant(end)))
