import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from candlewick import plans, schemas, streaming
from candlewick.sources import kafka

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def tick(minute, close=1.0, volume=1.0, symbol="A", second=0):
    at = (START + dt.timedelta(minutes=minute, seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps({"symbol": symbol, "@timestamp": at, "close": str(close), "volume": str(volume)})


def put(spark, folder, batch, texts, topic="ticks"):
    """One file of Kafka records; files are read one per micro-batch, in the order they were written."""
    rows = [(b"k", t.encode(), topic, 0, batch * 1000 + i, START) for i, t in enumerate(texts)]
    before = set(folder.glob("*.parquet"))
    spark.createDataFrame(rows, schemas.KAFKA_RECORD).coalesce(1).write.mode("append").parquet(str(folder))
    for file in set(folder.glob("*.parquet")) - before:
        os.utime(file, (1_700_000_000 + batch * 60,) * 2)


def source(spark, folder):
    return spark.readStream.schema(schemas.KAFKA_RECORD).option("maxFilesPerTrigger", 1).parquet(str(folder))


BATCHES = [
    [tick(0, 1.0), tick(1, 3.0), tick(2, 2.0, 2.0, "B")],
    [tick(4, 5.0, 2.0), "not json", tick(6, 7.0)],
    [tick(3, 9.0), tick(21, 1.0)],
    # Late rows are told by the watermark of the batch before.
    [tick(21, 3.0, second=5)],
    [tick(1, 100.0), tick(22, 2.0), tick(23, "x"), tick(24, 4.0, 0.0, "B")],
]


@pytest.fixture()
def topic(spark, tmp_path):
    for i, batch in enumerate(BATCHES):
        put(spark, tmp_path / "topic", i, batch)
    return tmp_path


def batch_result(spark, texts):
    rows = [(b"k", t.encode(), "ticks", 0, i, None) for i, t in enumerate(texts)]
    return plans.tick_topic_to_windows(spark.createDataFrame(rows, schemas.KAFKA_RECORD))


def flat(df):
    return {(r["symbol"], r["window_start"]): r["vwap"] for r in df.collect()}


def in_time():
    return [t for i, batch in enumerate(BATCHES) for t in batch if not (i == 4 and "100.0" in t)]


def test_update_ends_with_the_batch_result_and_drops_late_rows(spark, topic):
    windows = plans.tick_topic_to_windows(source(spark, topic / "topic"))
    query = streaming.run(streaming.versioned_writer(windows, str(topic / "out"), str(topic / "cp")), available_now=True)
    got = flat(streaming.read_versioned(spark, str(topic / "out"), ["symbol", "window_start", "window_end"]))
    assert got == flat(batch_result(spark, in_time()))
    assert got["B", "2024-01-01 00:20:00"] is None
    assert spark.read.parquet(str(topic / "out")).count() > len(got)
    assert streaming.late_rows(query) == 1
    seen = [p["observedMetrics"]["ticks"] for p in query.recentProgress if "ticks" in p["observedMetrics"]]
    assert sum(m["rejected"] for m in seen) == 2


def test_append_sends_each_window_once_after_the_watermark(spark, topic):
    messages = plans.tick_topic_to_vwap_topic(source(spark, topic / "topic"))
    writer = streaming.parquet_writer(messages, str(topic / "out"), str(topic / "cp"), files=1)
    streaming.run(writer, available_now=True)
    got = spark.read.schema("key string, value string").parquet(str(topic / "out")).collect()
    sent = [json.loads(r["value"]) for r in got]
    want = {k: v for k, v in flat(batch_result(spark, in_time())).items() if k[1] < "2024-01-01 00:15:00"}
    assert {(m["symbol"], m["window_start"]): m["vwap"] for m in sent} == want
    assert len(sent) == len(want) == 3 and {r["key"] for r in got} == {"A", "B"}


def test_sent_and_open_windows_are_the_batch_result(spark, topic):
    """At the end of every run, and between runs, what is sent and what is open are together all windows so far."""
    windows = plans.tick_topic_to_windows(source(spark, topic / "topic"))
    streaming.run(streaming.parquet_writer(windows, str(topic / "out"), str(topic / "cp"), files=1), available_now=True)
    sent = flat(spark.read.schema(schemas.VWAP).parquet(str(topic / "out")))
    held = flat(streaming.open_windows(spark, str(topic / "cp")))
    assert not set(sent) & set(held) and {**sent, **held} == flat(batch_result(spark, in_time()))
    assert held["B", "2024-01-01 00:20:00"] is None and len(held) > 1


def test_state_of_another_query(spark, tmp_path):
    put(spark, tmp_path / "topic", 0, BATCHES[0])
    counts = source(spark, tmp_path / "topic").groupBy("topic").count()
    streaming.run(streaming.versioned_writer(counts, str(tmp_path / "out"), str(tmp_path / "cp")), available_now=True)
    with pytest.raises(ValueError, match="VWAP"):
        streaming.open_windows(spark, str(tmp_path / "cp"))


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    def run_once():
        windows = plans.tick_topic_to_windows(source(spark, tmp_path / "topic"))
        return streaming.run(streaming.parquet_writer(windows, str(tmp_path / "out"), str(tmp_path / "cp")),
                             available_now=True)

    put(spark, tmp_path / "topic", 0, BATCHES[0])
    put(spark, tmp_path / "topic", 1, BATCHES[1])
    run_once()
    put(spark, tmp_path / "topic", 2, BATCHES[2])
    run_once()
    run_once()
    out = spark.read.schema(schemas.VWAP).parquet(str(tmp_path / "out"))
    want = {k: v for k, v in flat(batch_result(spark, in_time())).items() if k[1] < "2024-01-01 00:15:00"}
    assert flat(out) == want and out.count() == len(want)


def test_candles_to_ticks_as_a_stream(spark, tmp_path):
    def candle(minute, closed):
        millis = int((START + dt.timedelta(minutes=minute)).timestamp() * 1000) + 59_999
        return json.dumps({"k": {"i": "1m", "c": f"{minute}.5", "v": "2", "x": closed, "T": millis}})

    put(spark, tmp_path / "topic", 0, [candle(0, False), candle(0, True), candle(1, False), candle(1, True)], "candles")
    ticks = plans.candle_topic_to_ticks(source(spark, tmp_path / "topic"), "AB")
    streaming.run(streaming.parquet_writer(ticks, str(tmp_path / "out"), str(tmp_path / "cp")), available_now=True)
    got = [json.loads(r[0]) for r in spark.read.parquet(str(tmp_path / "out")).select("value").collect()]
    assert sorted(m["@timestamp"] for m in got) == ["2024-01-01T00:00:59Z", "2024-01-01T00:01:59Z"]
    assert {m["symbol"] for m in got} == {"AB"}


def test_replayed_records_give_the_same_table(spark, tmp_path):
    put(spark, tmp_path / "topic", 0, [tick(0, 1.0), tick(0, 2.0), tick(1, 3.0)])
    put(spark, tmp_path / "topic", 1, [json.dumps(
        {"window_start": "2024-01-01 00:00:00", "window_end": "2024-01-01 00:05:00", "symbol": "A", "vwap": v})
        for v in (1.0, 2.0)], "vwap")

    def table(checkpoint):
        records = plans.topics_to_records(source(spark, tmp_path / "topic"), "ticks", "vwap")
        writer = streaming.append_writer(records, str(tmp_path / "out"), str(tmp_path / checkpoint),
                                         partition_by=["table", "date"], files=1)
        streaming.run(writer, available_now=True)
        stored = spark.read.parquet(str(tmp_path / "out"))
        latest = plans.latest_records(stored)
        pruned = latest.filter("table = 'vwap'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(table" in pruned
        return stored.count(), sorted(
            (r["table"], r["Time"], r["MeasureValues"][0]["Value"]) for r in latest.collect())

    first_count, first = table("cp1")
    second_count, second = table("cp2")
    assert (first_count, second_count) == (5, 10)
    assert first == second == [("quotes", "1704067200000", "2.0"), ("quotes", "1704067260000", "3.0"),
                               ("vwap", "1704067500000", "2.0")]
    assert (tmp_path / "out" / "table=quotes" / "date=2024-01-01").exists()


def test_start_options(spark, tmp_path):
    put(spark, tmp_path / "topic", 0, BATCHES[0])
    writer = streaming.parquet_writer(source(spark, tmp_path / "topic").select("offset"), str(tmp_path / "o"),
                                      str(tmp_path / "c"))
    with pytest.raises(ValueError):
        streaming.start(writer, every="1 second", available_now=True)
    query = streaming.start(writer, name="named", every="1 second")
    try:
        assert query.name == "named" and query.isActive
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "o")).select(F.count("*")).first()[0] == 3


@pytest.fixture()
def broker(spark, tmp_path, monkeypatch):
    """Topics as folders of Kafka records, in place of the connector."""
    def read_stream(session, config, *topics, starting_offsets):
        assert starting_offsets == "earliest"
        stream = session.readStream.schema(schemas.KAFKA_RECORD).option("maxFilesPerTrigger", 1)
        return stream.parquet(str(tmp_path / "broker")).filter(F.col("topic").isin(*topics))

    def stream_writer(df, config, topic, checkpoint, output_mode="append"):
        def send(batch, batch_id):
            put(spark, tmp_path / f"to-{topic}", batch_id, [r["value"] for r in batch.collect()], topic)
        return df.writeStream.outputMode(output_mode).foreachBatch(send).option("checkpointLocation", checkpoint)

    monkeypatch.setattr(kafka, "read_stream", read_stream)
    monkeypatch.setattr(kafka, "stream_writer", stream_writer)
    return tmp_path


def sent(spark, folder):
    return [json.loads(r[0].decode()) for r in spark.read.parquet(str(folder)).select("value").collect()]


def finish(queries):
    for query in queries:
        query.awaitTermination()


ONCE = {"available_now": True, "starting_offsets": "earliest"}


def test_vwap_job(spark, broker):
    for i, batch in enumerate(BATCHES):
        put(spark, broker / "broker", i, batch)
    finish(streaming.start_vwap(spark, None, "ticks", "out", str(broker / "cp"), rejects=str(broker / "bad"), **ONCE))
    assert len(sent(spark, broker / "to-out")) == 3
    bad = spark.read.parquet(str(broker / "bad"))
    assert bad.count() == 2 and bad.columns == ["topic", "partition", "offset", "json"]
    finish(streaming.start_vwap(spark, None, "ticks", "all", str(broker / "cp2"), output_mode="update", **ONCE))
    assert len(sent(spark, broker / "to-all")) > 3


def test_tick_job(spark, broker):
    closed = {"k": {"i": "1m", "c": "1.5", "v": "2", "x": True, "T": 1704067259999}}
    put(spark, broker / "broker", 0, [json.dumps(closed), json.dumps({"k": {**closed["k"], "x": False}})], "candles")
    finish(streaming.start_ticks(spark, None, "candles", "ticks", "AB", str(broker / "cp"), **ONCE))
    assert sent(spark, broker / "to-ticks") == [
        {"symbol": "AB", "@timestamp": "2024-01-01T00:00:59Z", "close": "1.5", "volume": "2"}]


def test_records_job(spark, broker):
    put(spark, broker / "broker", 0, [tick(0), "bad", tick(1)], "ticks")
    put(spark, broker / "broker", 1, [json.dumps(
        {"window_start": "2024-01-01 00:00:00", "window_end": "2024-01-01 00:05:00", "symbol": "A", "vwap": 1.0})], "vwap")
    finish(streaming.start_records(spark, None, "ticks", "vwap", str(broker / "out"), str(broker / "cp"),
                                   rejects=str(broker / "bad"), **ONCE))
    counts = spark.read.parquet(str(broker / "out")).groupBy("table").count().collect()
    assert dict(map(tuple, counts)) == {"quotes": 2, "vwap": 1}
    assert [tuple(r) for r in spark.read.parquet(str(broker / "bad")).collect()] == [("ticks", "bad")]


def test_generations_order_versions_without_a_clock(spark, tmp_path):
    """A new checkpoint over the same table wins over the old one, whatever its batch numbers; a restart keeps its number."""
    out = str(tmp_path / "out")

    def run_once(topic, checkpoint):
        windows = plans.tick_topic_to_windows(source(spark, topic))
        streaming.run(streaming.versioned_writer(windows, out, str(tmp_path / checkpoint)), available_now=True)

    for i, batch in enumerate(BATCHES):
        put(spark, tmp_path / "topic", i, batch)
    run_once(tmp_path / "topic", "one")
    run_once(tmp_path / "topic", "one")
    put(spark, tmp_path / "other", 0, [tick(0, 77.0)])
    run_once(tmp_path / "other", "two")
    stored = spark.read.parquet(out)
    assert {r[0] for r in stored.select("generation").distinct().collect()} == {1, 2}
    identity = ["symbol", "window_start", "window_end"]
    got = flat(streaming.read_versioned(spark, out, identity))
    assert got["A", "2024-01-01 00:00:00"] == 77.0


def test_compaction_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).selectExpr("id % 5 AS k", "id AS v", "CAST(id % 2 AS INT) AS day", "1L AS generation", "id AS batch_id")
    rows.write.partitionBy("day").parquet(path)
    before = sorted(map(tuple, streaming.read_versioned(spark, path, ["k", "day"]).select("k", "day", "v").collect()))
    for _ in range(2):
        streaming.compact_versioned(spark, path, ["k", "day"], ["day"], F.col("day") == 0)
        stored = spark.read.parquet(path)
        assert stored.filter("day = 0").count() == 5 and stored.filter("day = 1").count() == 20
        assert sorted(map(tuple, streaming.read_versioned(spark, path, ["k", "day"]).select("k", "day", "v").collect())) == before


def test_the_later_offset_wins_whatever_the_clock_says(spark):
    rows = [("quotes", "d", "x", "1", "m", 0, offset, version) for offset, version in ((5, 100), (6, 50))]
    stored = spark.createDataFrame(rows, "table string, date string, Dimensions string, Time string, MeasureName string, "
                                         "partition int, offset long, Version long")
    assert [r["offset"] for r in plans.latest_records(stored).collect()] == [6]


def test_jobs_pass_source_options_on(spark, monkeypatch):
    from candlewick.streaming import jobs
    seen = {}

    def read(spark, config, *topics, **options):
        seen.update(options)
        raise RuntimeError("no broker here")

    monkeypatch.setattr(jobs.kafka, "read_stream", read)
    for start in (lambda s: jobs.start_ticks(spark, None, "c", "t", None, "cp", source=s),
                  lambda s: jobs.start_vwap(spark, None, "t", "v", "cp", source=s),
                  lambda s: jobs.start_records(spark, None, "t", "v", "out", "cp", source=s)):
        seen.clear()
        with pytest.raises(RuntimeError):
            start({"max_offsets_per_trigger": 9, "min_partitions": 4, "options": {"kafkaConsumer.pollTimeoutMs": 10}})
        assert seen["max_offsets_per_trigger"] == 9 and seen["min_partitions"] == 4 and seen["options"]


def beat(minute):
    return json.dumps({"@timestamp": (START + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")})


def test_heartbeats_finish_the_last_windows(spark, topic):
    """Without a further tick all windows are sent; ticks that were sent before a heartbeat are not late."""
    def run_once(heartbeat):
        windows = plans.tick_topic_to_windows(source(spark, topic / "topic"), heartbeat=heartbeat)
        name = f"heartbeat-{heartbeat}"
        return streaming.run(streaming.parquet_writer(windows, str(topic / name), str(topic / f"{name}-cp")), available_now=True)

    put(spark, topic / "topic", 5, [beat(40), json.dumps({"@timestamp": "soon"}), "{}"])
    query = run_once(True)
    got = spark.read.schema(schemas.VWAP).parquet(str(topic / "heartbeat-True"))
    assert flat(got) == flat(batch_result(spark, in_time())) and got.count() == len(flat(got))
    assert streaming.open_windows(spark, str(topic / "heartbeat-True-cp")).count() == 0 and streaming.late_rows(query) == 1
    seen = [p["observedMetrics"]["ticks"] for p in query.recentProgress if "ticks" in p["observedMetrics"]]
    assert sum(m["heartbeats"] for m in seen) == 1 and sum(m["rejected"] for m in seen) == 4
    run_once(False)
    assert flat(spark.read.schema(schemas.VWAP).parquet(str(topic / "heartbeat-False"))).keys() < flat(got).keys()


def test_heartbeats_are_neither_ticks_nor_rejects(spark, broker):
    put(spark, broker / "broker", 0, [tick(0), beat(1), "bad"])
    put(spark, broker / "broker", 1, [beat(30), json.dumps({"symbol": "A", "@timestamp": "2024-01-01T00:00:00Z"})])
    finish(streaming.start_vwap(spark, None, "ticks", "out", str(broker / "cp"), rejects=str(broker / "bad"), heartbeat=True, **ONCE))
    assert [m["window_start"] for m in sent(spark, broker / "to-out")] == ["2024-01-01 00:00:00"]
    assert spark.read.parquet(str(broker / "bad")).count() == 2
    finish(streaming.start_records(spark, None, "ticks", "vwap", str(broker / "records"), str(broker / "cp2"),
                                   rejects=str(broker / "bad2"), heartbeat=True, **ONCE))
    assert spark.read.parquet(str(broker / "records")).count() == 1 and spark.read.parquet(str(broker / "bad2")).count() == 2


def test_heartbeats_from_a_clock(spark, broker):
    clock = spark.createDataFrame([(START,)], "timestamp timestamp")
    assert [json.loads(r["value"]) for r in plans.clock_to_heartbeats(clock, "90 seconds").collect()] == [{"@timestamp": "2023-12-31T23:58:30Z"}]
    queries = streaming.start_heartbeats(spark, None, "ticks", str(broker / "cp"), seconds=2, every="1 second")
    try:
        for _ in range(60):
            if (broker / "to-ticks").exists() and sent(spark, broker / "to-ticks"):
                break
            queries[0].awaitTermination(1)
    finally:
        queries[0].stop()
    assert set(sent(spark, broker / "to-ticks")[0]) == {"@timestamp"}
