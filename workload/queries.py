"""Queries over the driver's tables, one or more per operator. Each takes (spark, folder of the tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import functions as fn
from candlewick import operators as op
from candlewick import plans, schemas, sources, streaming
from candlewick.session import scratch_path
from candlewick.sources.kafka import record_preview
from workload import views
from workload.views import TICK_TOPIC, VWAP_TOPIC

Query = Callable[[SparkSession, str], DataFrame]
SERIES = {"time_col": "event_time", "tie": "event_id"}
PRICES = ("open", "high", "low", "close", "volume")


def _round(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(name, digits).alias(name) for name in names]


def _single(*names: str) -> list[Column]:
    """Single precision: engines add doubles in different order, and means of cents often lie on a decimal tie."""
    return [F.col(name).cast("float").cast("double").alias(name) for name in names]


def _text(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


# VWAP

def vwap_5m(spark, sf_dir):
    windows = op.vwap_rows(op.vwap(views.ticks(spark, sf_dir)))
    return windows.select("window_start", "window_end", "symbol", *_single("vwap"))


def vwap_encode(spark, sf_dir):
    messages = plans.tick_topic_to_vwap_topic(views.tick_messages(views.ticks(spark, sf_dir)))
    decoded = op.decode_json(messages, schemas.VWAP, keep=["key"])
    return decoded.select("key", "window_start", "window_end", "symbol", *_single("vwap"))


def empty_windows(spark, sf_dir):
    windows = op.vwap_rows(op.vwap(views.ticks(spark, sf_dir)))
    return op.empty_windows(windows).select("window_start", "symbol")


def _window_stream(spark, sf_dir):
    stream = views.as_ticks(views.table_stream(spark, sf_dir, "events"))
    return plans.tick_topic_to_windows(views.tick_messages(stream))


def vwap_5m_stream_update(spark, sf_dir):
    base = scratch_path(spark, "vwap-update")
    streaming.run(streaming.versioned_writer(_window_stream(spark, sf_dir), f"{base}/table", f"{base}/checkpoint"),
                  available_now=True)
    rows = streaming.read_versioned(spark, f"{base}/table", ["window_start", "window_end", "symbol"])
    return rows.select("window_start", "window_end", "symbol", *_single("vwap"))


def vwap_5m_stream_append(spark, sf_dir):
    base = scratch_path(spark, "vwap-append")
    streaming.run(streaming.parquet_writer(_window_stream(spark, sf_dir), f"{base}/table", f"{base}/checkpoint"),
                  available_now=True)
    rows = spark.read.schema(schemas.VWAP).parquet(f"{base}/table")
    return rows.select("window_start", "window_end", "symbol", *_single("vwap"))


def vwap_heartbeat(spark, sf_dir):
    """A query in append mode over ticks and, at the end, a heartbeat of a time after the last one: every window is sent."""
    base, ticks = scratch_path(spark, "vwap-heartbeat"), views.ticks(spark, sf_dir)
    after = ticks.agg((F.max("event_time") + F.expr("INTERVAL 12 MINUTES")).alias("timestamp"))
    beats = views.kafka_records(plans.clock_to_heartbeats(after), TICK_TOPIC, F.lit(-1).cast("long"), F.lit(None).cast("timestamp"))
    views.tick_messages(ticks).unionByName(beats).write.parquet(f"{base}/topic")
    stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(f"{base}/topic")
    streaming.run(streaming.parquet_writer(plans.tick_topic_to_windows(stream, heartbeat=True), f"{base}/table", f"{base}/checkpoint"),
                  available_now=True)
    rows = spark.read.schema(schemas.VWAP).parquet(f"{base}/table")
    return rows.select("window_start", "window_end", "symbol", *_single("vwap"))


def vwap_open_windows(spark, sf_dir):
    """What a query in append mode has sent, and the windows that it still holds in its state."""
    base = scratch_path(spark, "vwap-open")
    streaming.run(streaming.parquet_writer(_window_stream(spark, sf_dir), f"{base}/table", f"{base}/checkpoint"),
                  available_now=True)
    sent = spark.read.schema(schemas.VWAP).parquet(f"{base}/table").withColumn("state", F.lit("sent"))
    open_ = streaming.open_windows(spark, f"{base}/checkpoint").withColumn("state", F.lit("open"))
    return sent.unionByName(open_).select("state", "window_start", "window_end", "symbol", *_single("vwap"))


# Messages

def _doubtful_messages(spark, sf_dir):
    """Tick messages with a price that is no number for one event type and without volume for another."""
    ticks = views.ticks(spark, sf_dir)
    close = F.when(F.col("symbol") == "error", "n/a").otherwise(F.col("close").cast("string"))
    volume = F.when(F.col("symbol") != "view", F.col("volume").cast("string"))
    return views.tick_messages(ticks, close, volume)


def tick_decode(spark, sf_dir):
    ticks = op.decode_ticks(_doubtful_messages(spark, sf_dir), keep=["offset"])
    return ticks.select("offset", "symbol", _text("event_time").alias("event_time"), "close", "volume")


def tick_filter(spark, sf_dir):
    ticks = op.valid_ticks(op.decode_ticks(_doubtful_messages(spark, sf_dir), keep=["offset"]))
    return ticks.select("offset", "symbol", "close", "volume")


def _broken_messages(spark, sf_dir):
    """Every tick's message with one of ten texts in the place of a price, a volume or a time, by its number."""
    ticks = views.ticks(spark, sf_dir)
    kind = F.col("event_id") % 10
    close = F.when(kind == 0, "NaN").when(kind == 1, "Infinity").when(kind == 2, "1,5").otherwise(F.col("close").cast("string"))
    volume = F.when(kind == 3, "-Infinity").otherwise(F.col("volume").cast("string"))
    time = (F.when(kind == 4, "+294247-01-10T04:00:54Z").when(kind == 5, "12:34:56").when(kind == 6, "2024")
            .when(kind == 7, "1899-12-31T23:59:59Z"))
    return views.tick_messages(ticks, close, volume, time)


def tick_rejects(spark, sf_dir):
    return op.rejected_ticks(op.decode_ticks(_broken_messages(spark, sf_dir), keep=["offset"])).select(
        "offset", "symbol", F.col("json").isNotNull().alias("has_text"))


def _broken_candles(spark, sf_dir):
    """Closed candles of every minute; those of some prices overflow their time or have no number."""
    closed = op.ticks_to_bars(views.ticks(spark, sf_dir), "1", tie="event_id")
    cents = F.floor(F.col("close") * 100).cast("long") % 4
    candle = F.struct(
        F.col("symbol").alias("s"), F.lit("1m").alias("i"), F.when(cents == 1, "NaN").otherwise(F.col("close").cast("string")).alias("c"),
        F.col("volume").cast("string").alias("v"), F.lit(True).alias("x"),
        F.when(cents == 2, F.lit(2**63 - 1)).otherwise(F.unix_millis("datetime") + 59_999).alias("T"))
    rows = closed.select(F.col("symbol").alias("key"), F.to_json(F.struct(candle.alias("k"))).alias("value"), "datetime")
    return views.kafka_records(rows, "candles", F.unix_seconds("datetime"), F.col("datetime"))


def candle_rejects(spark, sf_dir):
    return op.rejected_candles(op.decode_candles(_broken_candles(spark, sf_dir), keep=["offset"])).select(
        "offset", F.col("k.s").alias("symbol"), F.col("json").isNotNull().alias("has_text"))


def candles_many_symbols(spark, sf_dir):
    """Candles of all symbols in one topic, named by the message; the broken ones give no tick."""
    messages = plans.candle_topic_to_ticks(_broken_candles(spark, sf_dir))
    return op.decode_ticks(messages, keep=["key"]).select(
        "key", "symbol", _text("event_time").alias("event_time"), "close", "volume")


def chart_rejects(spark, sf_dir):
    """One capture per tick with two bars, of which one has a time or price that is none."""
    ticks = views.ticks(spark, sf_dir)
    good = F.concat(F.lit('{"i":0,"v":['), F.unix_seconds("event_time"), F.lit(',1,2,0.5,1.5,9]}'))
    bad = F.when(F.col("event_id") % 2 == 0, '{"i":1,"v":[1e30,1,2,0.5,1.5]}').otherwise('{"i":1,"v":[60,1,"?",0.5,1.5]}')
    text = F.concat(F.lit('~m~200~m~{"m":"du","p":["cs",{"sds_1":{"s":['), good, F.lit(","), bad, F.lit("]}}]}"))
    captures = ticks.select("event_id", text.alias("text"))
    return op.rejected_chart_bars(captures).select("event_id", F.get_json_object("bar", "$.i").cast("int").alias("bar"))


def kafka_preview(spark, sf_dir):
    preview = record_preview(views.tick_messages(views.ticks(spark, sf_dir)))
    return preview.select("key", F.get_json_object("value", "$.close").alias("close"), "offset",
                          F.unix_micros("timestamp").alias("timestamp_us"))


def candle_to_tick(spark, sf_dir):
    updates = views.candle_messages(views.ticks(spark, sf_dir))
    candles = op.decode_candles(updates, keep=["symbol"])
    return op.candles_to_ticks(op.closed_candles(candles), F.col("symbol")).withColumnRenamed("@timestamp", "close_time")


def candle_topic_to_ticks(spark, sf_dir):
    updates = views.candle_messages(views.ticks(spark, sf_dir))
    messages = plans.candle_topic_to_ticks(updates, "ALL")
    return op.decode_ticks(messages, keep=["key"]).select(
        "key", "symbol", _text("event_time").alias("event_time"), "close", "volume")


def candle_preview(spark, sf_dir):
    return op.candle_preview(op.decode_candles(views.candle_messages(views.ticks(spark, sf_dir))))


def chart_parse(spark, sf_dir):
    parsed = op.chart_bars(views.chart_captures(views.bars(spark, sf_dir, "1D")))
    return parsed.select("symbol", _text("datetime").alias("datetime"), *PRICES)


def chart_messages(spark, sf_dir):
    """Two frames to a text: a heartbeat, then a message whose second parameter is JSON within a string."""
    params = F.concat(F.lit('["cs_1","s'), "event_id", F.lit('","={\\"symbol\\":\\"'), "symbol", F.lit('\\"}"]'))
    text = F.concat(F.lit('~m~4~m~~h~1~m~90~m~{"p":'), params, F.lit(',"m":"'), "symbol", F.lit('_update"}'))
    texts = views.ticks(spark, sf_dir).select(
        "event_id", F.when(F.col("symbol") == "error", "~m~4~m~~h~1").otherwise(text).alias("text"))
    return op.chart_messages(texts)


def symbol_format(spark, sf_dir):
    """Even volumes are futures contracts; purchases come with their exchange."""
    ticks = views.ticks(spark, sf_dir)
    symbol = F.when(F.col("symbol") == "purchase", F.concat(F.lit("OTHER:"), "symbol")).otherwise(F.col("symbol"))
    contract = F.when(F.col("volume") % 2 == 0, F.col("volume").cast("int"))
    return ticks.select("event_id", fn.format_symbol(symbol, F.lit("EX"), contract).alias("name"))


def time_range(spark, sf_dir):
    first, last = "2024-01-10 06:00:00", "2024-01-20 06:00:00"
    start, end = (F.to_timestamp(F.lit(t)) for t in (first, last))
    part = op.time_range(views.ticks(spark, sf_dir), start, end, "event_time")
    return op.with_symbol(part.drop("symbol"), "ALL").select("symbol", "event_id", "close", "volume")


# Indicators

def _series(spark, sf_dir):
    return views.ticks(spark, sf_dir)


def sma_min_periods(spark, sf_dir):
    got = op.with_indicators(_series(spark, sf_dir), op.Sma(20, 20), op.Ema(50, 30), op.Rsi(14, 15), **SERIES)
    return got.select("event_id", "symbol", *_single("sma20", "ema50", "rsi14"))


def gold_guard(spark, sf_dir):
    """Columns of the user that an indicator would make, in any case, stay; the others are added."""
    marked = _series(spark, sf_dir).withColumn("SMA200", F.lit(-1.0)).withColumn("signal_line", F.lit(-2.0))
    got = op.with_indicators(marked, *op.GOLD, **SERIES)
    return got.select("event_id", "symbol", "signal_line", F.col("SMA200").alias("sma200"), *_single("ema50", "rsi14"),
                      F.lit(sum(c.lower() in ("sma200", "macd_line", "macd_histogram") for c in got.columns)).alias("taken"))


def sma_200(spark, sf_dir):
    return op.sma(_series(spark, sf_dir), 200, **SERIES).select("event_id", "symbol", *_single("sma200"))


def ema_50(spark, sf_dir):
    return op.ema(_series(spark, sf_dir), 50, **SERIES).select("event_id", "symbol", *_single("ema50"))


def price_change(spark, sf_dir):
    return op.price_change(_series(spark, sf_dir), **SERIES).select("event_id", "symbol", *_round("price_change"))


def gain_loss(spark, sf_dir):
    return op.gain_loss(_series(spark, sf_dir), **SERIES).select("event_id", "symbol", *_round("gain", "loss"))


def rsi_14(spark, sf_dir):
    return op.rsi(_series(spark, sf_dir), 14, **SERIES).select("event_id", "symbol", *_single("rsi14"))


def macd(spark, sf_dir):
    return op.macd(_series(spark, sf_dir), **SERIES).select(
        "event_id", "symbol", *_round("macd_line", "signal_line", "macd_histogram"))


def gold(spark, sf_dir):
    return op.with_indicators(_series(spark, sf_dir), *op.GOLD, **SERIES).select(
        "event_id", "symbol", *_single("sma200", "ema50", "rsi14"), *_round("macd_line", "signal_line", "macd_histogram"))


def indicator_chain(spark, sf_dir):
    """The gold columns by one call after the other."""
    got = (_series(spark, sf_dir).transform(op.sma, **SERIES).transform(op.ema, **SERIES).transform(op.rsi, **SERIES)
           .transform(op.macd, **SERIES))
    return got.select("event_id", "symbol", *_single("sma200", "ema50", "rsi14"),
                      *_round("macd_line", "signal_line", "macd_histogram"))


def one_series(spark, sf_dir):
    """All rows as a single series, without a key."""
    got = op.with_indicators(_series(spark, sf_dir), op.Sma(200), op.Rsi(14), keys=(), **SERIES)
    return got.select("event_id", *_single("sma200", "rsi14"))


# Bars

def _ohlcv(interval: str) -> Query:
    def query(spark, sf_dir):
        bars = views.bars(spark, sf_dir, interval)
        return bars.select("symbol", _text("datetime").alias("datetime"), *PRICES)
    return query


def resample_1h_to_1d(spark, sf_dir):
    daily = op.resample(views.bars(spark, sf_dir, "1H"), "1D")
    return daily.select("symbol", _text("datetime").alias("datetime"), *PRICES)


def latest_bars_10(spark, sf_dir):
    latest = op.latest_bars(views.bars(spark, sf_dir, "1H"), 10)
    return latest.select("symbol", _text("datetime").alias("datetime"), *PRICES)


def latest_bars_1516(spark, sf_dir):
    latest = op.latest_bars(views.bars(spark, sf_dir, "5"), 1516)
    return latest.select("symbol", _text("datetime").alias("datetime"), *PRICES)


def history(spark, sf_dir):
    bars = op.history(views.bars(spark, sf_dir, "5"), "click", interval="4H", n_bars=20)
    return bars.select("symbol", _text("datetime").alias("datetime"), *PRICES)


# Tables

def _staged_silver(spark, sf_dir):
    base = scratch_path(spark, "medallion")
    sources.write_bronze(views.shipment_bars(spark, sf_dir), f"{base}/bronze")
    plans.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver")
    return base


def medallion_silver(spark, sf_dir):
    silver = spark.read.parquet(f"{_staged_silver(spark, sf_dir)}/silver")
    return silver.select("symbol", _text("datetime").alias("datetime"), *PRICES, "year", "month")


def latest_silver_bars(spark, sf_dir):
    """The last 40 bars of every symbol in silver; N has none in the last years, so older months are needed for it alone."""
    base = scratch_path(spark, "latest")
    bars = views.shipment_bars(spark, sf_dir).filter("symbol <> 'N' OR year(datetime) < 1996")
    sources.write_layer(sources.with_year_month(bars), f"{base}/silver")
    latest = plans.latest_stored_bars(spark, f"{base}/silver", 40)
    return latest.select("symbol", _text("datetime").alias("datetime"), *PRICES, "year", "month")


def bars_range(spark, sf_dir):
    """Silver bars between two bounds with zones, which fall into other months than they are written in."""
    base = _staged_silver(spark, sf_dir)
    zone = dt.timezone(dt.timedelta(hours=2))
    start = dt.datetime(1995, 2, 1, 0, 0, tzinfo=zone)
    end = dt.datetime(1996, 3, 31, 22, 30, tzinfo=dt.timezone(-dt.timedelta(hours=5)))
    bars = sources.read_bars(spark, f"{base}/silver", start, end)
    return bars.select("symbol", _text("datetime").alias("datetime"), *PRICES, "year", "month")


def medallion_replace_months(spark, sf_dir):
    """Silver in full, then the months of 1995 and 1996 again with doubled volumes: only they are replaced."""
    base = _staged_silver(spark, sf_dir)
    again = views.shipment_bars(spark, sf_dir).filter(F.year("datetime").isin(1995, 1996)).withColumn("volume", F.col("volume") * 2)
    sources.write_layer(sources.with_year_month(again), f"{base}/silver", replace="months")
    silver = spark.read.parquet(f"{base}/silver")
    return silver.select("symbol", _text("datetime").alias("datetime"), *PRICES, "year", "month")


def medallion_upsert(spark, sf_dir):
    """Three loads of one bronze and silver table: flag R, then A and N, then R again for the first half of each month of 1995, with
    doubled volumes. Each load merges into what is there."""
    base = scratch_path(spark, "upsert")
    bars = views.shipment_bars(spark, sf_dir)
    again = bars.filter("symbol = 'R' AND year(datetime) = 1995 AND day(datetime) <= 15").withColumn("volume", F.col("volume") * 2)
    for load in (bars.filter("symbol = 'R'"), bars.filter("symbol <> 'R'"), again):
        sources.write_bronze(load, f"{base}/bronze", replace="rows")
        sources.write_layer(sources.with_year_month(load), f"{base}/silver", replace="rows")
    bronze = sources.read_bronze(spark, f"{base}/bronze").withColumn("layer", F.lit("bronze"))
    both = bronze.unionByName(spark.read.parquet(f"{base}/silver").withColumn("layer", F.lit("silver")))
    return both.select("layer", "symbol", _text("datetime").alias("datetime"), *PRICES, "year", "month")


def bronze_rejects(spark, sf_dir):
    """Bronze files in which the shipping dates of three flags and prices are spoilt: what is left out, and the bars of what is left."""
    base = scratch_path(spark, "spoilt")
    bars = views.shipment_bars(spark, sf_dir)
    day = F.day("datetime")
    fields = [F.col("symbol"), F.when(day == 3, "not a time").when(day == 4, "").otherwise(_text("datetime")),
              *[F.col(name).cast("string") for name in ("open", "high", "low")],
              F.when(day == 5, "abc").when(day == 6, "").when(day == 7, "NaN").otherwise(F.col("close").cast("string")),
              F.when(day == 8, "1,2,3").otherwise(F.col("volume").cast("string"))]
    header = ",".join(schemas.BAR_COLUMNS)
    lines = sources.with_year_month(bars.withColumn("text", F.concat_ws(",", *fields))).select("text", *sources.files.PARTITION)
    files = lines.groupBy(*sources.files.PARTITION).agg(F.array_sort(F.collect_list("text")).alias("lines")).select(
        F.concat(F.lit(header + "\n"), F.array_join("lines", "\n")).alias("text"), *sources.files.PARTITION)  # at most 93 lines each
    files.write.partitionBy(*sources.files.PARTITION).text(base)
    rejected = sources.rejected_bronze(spark, base).groupBy("reason", "year", "month").agg(F.count(F.lit(1)).alias("lines"))
    bars_left = sources.read_bronze(spark, base).groupBy("year", "month").agg(F.count(F.lit(1)).alias("lines"))
    return rejected.unionByName(bars_left.withColumn("reason", F.lit("bar")))


def medallion_gold(spark, sf_dir):
    base = _staged_silver(spark, sf_dir)
    gold = plans.silver_to_gold(spark, f"{base}/silver", f"{base}/gold")
    return gold.select("symbol", _text("datetime").alias("datetime"), "close", *_single("sma200", "ema50", "rsi14"),
                       *_round("macd_line", "signal_line", "macd_histogram", digits=4), "year", "month")


def gold_incremental(spark, sf_dir):
    """Gold in four runs, cut within months: each reads the silver since the last one and the state it left."""
    base = _staged_silver(spark, sf_dir)
    for until in ((1992, 9, 3, 12), (1995, 6, 17), (1995, 6, 18), None):
        gold = plans.extend_gold(spark, f"{base}/silver", f"{base}/gold", f"{base}/state",
                                 until and dt.datetime(*until, tzinfo=dt.timezone.utc))
    return gold.select("symbol", _text("datetime").alias("datetime"), "close", *_single("sma200", "ema50", "rsi14"),
                       *_round("macd_line", "signal_line", "macd_histogram", digits=4), "year", "month")


def month_partitions(spark, sf_dir):
    base = scratch_path(spark, "months")
    sources.write_bronze(views.shipment_bars(spark, sf_dir), base)
    return sources.read_bronze(spark, base).groupBy("year", "month").agg(F.count(F.lit(1)).alias("bars"))


def catalog_table(spark, sf_dir):
    base = _staged_silver(spark, sf_dir)
    name = f"bars_{base.rsplit('-', 1)[1]}"
    silver = sources.register_table(spark, name, f"{base}/silver")
    return silver.groupBy("symbol", "year").agg(F.count(F.lit(1)).alias("bars"), F.max("high").alias("high"))


def bronze_from_charts(spark, sf_dir):
    base = scratch_path(spark, "charts")
    captures = views.chart_captures(views.shipment_bars(spark, sf_dir)).withColumn("exchange", F.lit("EX"))
    plans.build_bronze(captures, base)
    bars = sources.read_bronze(spark, base)
    return bars.select("symbol", _text("datetime").alias("datetime"), *PRICES, "year", "month")


# Records

def _pairs(column: str, value: str = "Value") -> Column:
    return F.array_join(F.transform(column, lambda e: F.concat(e["Name"], F.lit("="), e[value])), ";").alias(column)


def _flat(records: DataFrame) -> DataFrame:
    return records.select(_pairs("Dimensions"), "MeasureName", _pairs("MeasureValues"), "Time", "Version")


def wide_tick_records(spark, sf_dir):
    return _flat(op.tick_records(views.ticks(spark, sf_dir), TICK_TOPIC, F.col("event_id")))


def wide_vwap_records(spark, sf_dir):
    rows = op.vwap_rows(op.vwap(views.ticks(spark, sf_dir)))
    flat = _flat(op.vwap_records(rows, VWAP_TOPIC, F.lit(1)))
    value = F.regexp_extract("MeasureValues", "^vwap_value=(.*)$", 1).cast("float").cast("double")
    return flat.withColumn("MeasureValues", value)


def narrow_records(spark, sf_dir):
    ticks = views.ticks(spark, sf_dir).withColumn("source_topic", F.lit(TICK_TOPIC))
    records = op.narrow_records(ticks, ["symbol", "source_topic"], ["close", "volume"], F.unix_millis("event_time"),
                                F.col("event_id"))
    return records.select(_pairs("Dimensions"), "MeasureName", "MeasureValue", "MeasureValueType", "Time", "TimeUnit",
                          "Version")


def latest_version(spark, sf_dir):
    """Every tick is a new version of its symbol's record for the hour."""
    versions = views.ticks(spark, sf_dir).select(
        "symbol", _text(F.date_trunc("hour", "event_time")).alias("hour"), "close", "volume",
        F.col("event_id").alias("Version"))
    return op.latest_version(versions, ["symbol", "hour"])


def _staged_topics(spark, sf_dir):
    """Both topics as one table of Kafka records."""
    ticks = views.ticks(spark, sf_dir)
    path = scratch_path(spark, "topics")
    rows = op.vwap_rows(op.vwap(ticks))
    views.tick_messages(ticks).unionByName(views.vwap_messages(rows)).write.parquet(path)
    return path


def _record_values(records: DataFrame) -> DataFrame:
    values = F.transform("MeasureValues", lambda e: e["Value"].cast("float").cast("double"))
    return records.select("table", _pairs("Dimensions"), "MeasureName", F.get(values, F.lit(0)).alias("first_value"),
                          F.get(values, F.lit(1)).alias("second_value"), "Time")


def topics_to_records(spark, sf_dir):
    records = spark.read.parquet(_staged_topics(spark, sf_dir))
    return _record_values(plans.topics_to_records(records, TICK_TOPIC, VWAP_TOPIC))


def rejected_messages(spark, sf_dir):
    records = spark.read.parquet(_staged_topics(spark, sf_dir))
    rejected = plans.rejected_messages(records, TICK_TOPIC, VWAP_TOPIC)
    return rejected.select("topic", F.get_json_object("json", "$.symbol").alias("symbol"),
                           F.get_json_object("json", "$.window_start").alias("window_start"))


def records_stream(spark, sf_dir):
    topics, base = _staged_topics(spark, sf_dir), scratch_path(spark, "records")
    stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(topics)
    records = plans.topics_to_records(stream, TICK_TOPIC, VWAP_TOPIC)
    streaming.run(
        streaming.append_writer(records, f"{base}/table", f"{base}/checkpoint", partition_by=["table", "date"]),
        available_now=True)
    return _record_values(plans.latest_records(spark.read.parquet(f"{base}/table")))


def records_compacted(spark, sf_dir):
    """Quotes and windows stored twice, compacted twice: one row per record is left."""
    base = scratch_path(spark, "compacted")
    records = plans.topics_to_records(spark.read.parquet(_staged_topics(spark, sf_dir)), TICK_TOPIC, VWAP_TOPIC)
    for _ in range(2):
        records.write.mode("append").partitionBy("table", "date").parquet(base)
    for _ in range(2):
        plans.compact_records(spark, base, F.col("date") < F.current_date())
    return _record_values(spark.read.parquet(base))


def records_bucketed(spark, sf_dir):
    """Quotes and windows stored twice in a bucketed table, all days but the last ones compacted by switching their partitions."""
    base = scratch_path(spark, "bucketed")
    name = f"records_{base.rsplit('-', 1)[1]}"
    plans.create_record_table(spark, name, f"{base}/table", buckets=4)
    records = plans.topics_to_records(spark.read.parquet(_staged_topics(spark, sf_dir)), TICK_TOPIC, VWAP_TOPIC)
    for _ in range(2):
        sources.append_versions(records, name)
    plans.compact_record_table(spark, name, "date < DATE '2024-01-25'")
    return _record_values(plans.latest_records(spark.table(name)))


def vwap_late_restart(spark, sf_dir):
    """The stream stops after the first days and goes on from its checkpoint with the rest, which holds some of the first
    days' ticks once more: they are late and change nothing."""
    base, ticks = scratch_path(spark, "late"), views.ticks(spark, sf_dir)
    messages = views.tick_messages(ticks)
    split = F.lit("2024-01-10").cast("timestamp")
    late = messages.filter((F.col("timestamp") < F.lit("2024-01-05").cast("timestamp")) & (F.col("offset") % 3 == 0))
    parts = [messages.filter(F.col("timestamp") < split), messages.filter(F.col("timestamp") >= split).unionByName(late)]
    for part in parts:
        part.write.mode("append").parquet(f"{base}/topic")
        stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(f"{base}/topic")
        streaming.run(streaming.versioned_writer(plans.tick_topic_to_windows(stream), f"{base}/table", f"{base}/checkpoint"),
                      available_now=True)
    rows = streaming.read_versioned(spark, f"{base}/table", ["window_start", "window_end", "symbol"])
    return rows.select("window_start", "window_end", "symbol", *_single("vwap"))


# Scalar functions

def scalar_functions(spark, sf_dir):
    ticks = views.ticks(spark, sf_dir)
    millis = F.unix_millis("event_time")
    return ticks.select(
        "event_id",
        fn.epoch_ms_to_iso(millis).alias("iso"),
        fn.iso_to_epoch_ms(fn.epoch_ms_to_iso(millis)).alias("epoch_ms"),
        F.unix_seconds(fn.epoch_seconds_to_time(F.unix_seconds("event_time"))).alias("epoch_s"),
        fn.volume_or_zero(F.when(F.col("symbol") != "view", F.col("volume"))).alias("volume"),
        fn.to_double(F.when(F.col("symbol") == "error", "x").otherwise(F.col("close").cast("string"))).alias("price"),
        fn.double_text("close").alias("close_text"),
        (fn.now_epoch_ms() > 0).alias("now_is_set"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        vwap_5m, vwap_encode, empty_windows, vwap_5m_stream_update, vwap_5m_stream_append,
        tick_decode, tick_filter, tick_rejects, candle_rejects, candles_many_symbols, chart_rejects, kafka_preview, candle_to_tick, candle_topic_to_ticks, candle_preview,
        chart_parse, chart_messages, symbol_format, time_range,
        sma_200, sma_min_periods, gold_guard, ema_50, price_change, gain_loss, rsi_14, macd, gold, indicator_chain, one_series,
        resample_1h_to_1d, latest_bars_10, latest_bars_1516, latest_silver_bars, history,
        medallion_silver, bars_range, medallion_replace_months, medallion_upsert, bronze_rejects, medallion_gold, gold_incremental, month_partitions, catalog_table, bronze_from_charts,
        wide_tick_records, wide_vwap_records, narrow_records, latest_version, topics_to_records, rejected_messages,
        records_stream, records_compacted, records_bucketed, vwap_late_restart, vwap_open_windows, vwap_heartbeat, scalar_functions,
    )
}
QUERIES.update({f"ohlcv_{interval.lower() if interval != '1M' else '1mo'}": _ohlcv(interval)
                for interval in fn.INTERVALS})
