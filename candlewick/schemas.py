"""Row shapes of the data model (bars, ticks, candles, VWAP messages, time-series records)."""

from __future__ import annotations

from pyspark.sql import types as T

_DOUBLE = T.DoubleType()
_STRING = T.StringType()

# Historical bar as stored in the bronze CSV files; year and month come from the path.
BRONZE_BAR = T.StructType([
    T.StructField("datetime", T.TimestampType()),
    T.StructField("open", _DOUBLE),
    T.StructField("high", _DOUBLE),
    T.StructField("low", _DOUBLE),
    T.StructField("close", _DOUBLE),
    T.StructField("volume", _DOUBLE),
])

# The same with the symbol kept, as this package writes it.
BRONZE_SYMBOL_BAR = T.StructType([T.StructField("symbol", _STRING), *BRONZE_BAR.fields])

PARTITION_FIELDS = [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]

BAR_COLUMNS = ["symbol", "datetime", "open", "high", "low", "close", "volume"]

# One update of the running candle, as the exchange sends it. s is the symbol, T is the close time in epoch ms, x marks a closed candle.
CANDLE = T.StructType([
    T.StructField("k", T.StructType([
        T.StructField("s", _STRING),
        T.StructField("i", _STRING),
        T.StructField("c", _STRING),
        T.StructField("v", _STRING),
        T.StructField("x", T.BooleanType()),
        T.StructField("T", T.LongType()),
    ])),
])

# Tick message: every field is text.
TICK = T.StructType([T.StructField(name, _STRING) for name in ("symbol", "@timestamp", "close", "volume")])

# VWAP message.
VWAP = T.StructType([
    T.StructField("window_start", _STRING),
    T.StructField("window_end", _STRING),
    T.StructField("symbol", _STRING),
    T.StructField("vwap", _DOUBLE),
])

# Fields of either message, for reading both topics in one pass.
TICK_OR_VWAP = T.StructType([
    *TICK.fields,
    *[T.StructField(name, _STRING) for name in ("window_start", "window_end", "vwap")],
])

# The columns of Spark's Kafka source that the decoders use.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", _STRING),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# The bars of a chart capture: running number and [time, open, high, low, close, volume]. The numbers are read as text,
# so that one bad number costs one bar and not the whole capture.
CHART_BARS = T.ArrayType(T.StructType([
    T.StructField("i", T.LongType()),
    T.StructField("v", T.ArrayType(_STRING)),
]))

# A message of the chart service: method and parameters, and the parameter that holds series of bars by name.
CHART_MESSAGE = T.StructType([T.StructField("m", _STRING), T.StructField("p", T.ArrayType(_STRING))])
CHART_SERIES = T.MapType(_STRING, T.StructType([T.StructField("s", CHART_BARS)]))
