import json

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick import schemas
from candlewick.sources import kafka


def messages(spark, texts, topic="ticks"):
    rows = [("k".encode(), t.encode() if t is not None else None, topic, 0, i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schemas.KAFKA_RECORD)


GOOD = '{"symbol":"A","@timestamp":"2024-01-01T00:00:10Z","close":"1.5","volume":"2"}'
BAD = [
    '{"symbol":"A","@timestamp":"2024-01-01T00:00:10Z","close":"x","volume":"2"}',
    '{"symbol":"A","@timestamp":"2024-01-01T00:00:10Z","close":"1.5"}',
    '{"symbol":"A","@timestamp":"yesterday","close":"1.5","volume":"2"}',
    '{"symbol":"A","@timestamp":"12:34:56","close":"1.5","volume":"2"}',
    '{"symbol":"A","@timestamp":"2024","close":"1.5","volume":"2"}',
    '{"symbol":"A","@timestamp":"+294247-01-10T04:00:54Z","close":"1.5","volume":"2"}',
    '{"symbol":"A","@timestamp":"2200-01-01T00:00:00Z","close":"1.5","volume":"2"}',
    '{"symbol":"A","@timestamp":"2024-01-01T00:00:10Z","close":"NaN","volume":"2"}',
    '{"symbol":"A","@timestamp":"2024-01-01T00:00:10Z","close":"1.5","volume":"Infinity"}',
    '{"symbol":"A",',
    "",
    None,
]


def test_ticks_are_decoded_and_bad_ones_kept_apart(spark):
    ticks = op.decode_ticks(messages(spark, [GOOD, *BAD]), keep=["offset"])
    good = op.valid_ticks(ticks).collect()
    assert [(r["offset"], r["symbol"], r["close"], r["volume"], str(r["event_time"])) for r in good] == [
        (0, "A", 1.5, 2.0, str(good[0]["event_time"]))]
    rejected = {r["offset"]: r["json"] for r in op.rejected_ticks(ticks).collect()}
    assert rejected == {i: text for i, text in enumerate(BAD, start=1)}


def test_numbers_in_json_are_taken_as_text(spark):
    ticks = op.decode_ticks(messages(spark, ['{"symbol":"A","@timestamp":"2024-01-01T00:00:10Z","close":1.5,"volume":2}']))
    assert op.valid_ticks(ticks).select("close", "volume").first()[:] == (1.5, 2.0)


def test_rejected_ticks_are_counted_on_the_way(spark):
    from pyspark.sql import Observation
    seen = Observation("seen")
    op.valid_ticks(op.count_rejected(op.decode_ticks(messages(spark, [GOOD, *BAD])), seen)).count()
    assert seen.get == {"all": 1 + len(BAD), "rejected": len(BAD)}


def candle(closed, close="1.50", millis=1704067259999):
    return json.dumps({"e": "kline", "k": {"i": "1m", "c": close, "v": "7.0", "x": closed, "T": millis}})


def test_candles(spark):
    candles = op.decode_candles(messages(spark, [candle(False), candle(True, "1.60"), "nonsense"]))
    ticks = op.candles_to_ticks(op.closed_candles(candles), "AB")
    assert [r.asDict() for r in ticks.collect()] == [
        {"symbol": "AB", "@timestamp": "2024-01-01T00:00:59Z", "close": "1.60", "volume": "7.0"}]
    assert op.candle_preview(candles).dropna().count() == 2


def test_no_candle_stops_a_query(spark):
    texts = [candle(True, "1.60"), candle(True, "NaN"), candle(True, millis=2**63 - 1), candle(True, millis=-2**63), "nonsense", None]
    candles = op.decode_candles(messages(spark, texts), keep=["offset"])
    assert [r["offset"] for r in op.valid_candles(candles).collect()] == [0]
    assert {r["offset"]: r["json"] for r in op.rejected_candles(candles).collect()} == dict(list(enumerate(texts))[1:])
    assert op.candles_to_ticks(candles, "AB").filter("`@timestamp` IS NOT NULL").count() == 2


def test_candle_symbols(spark):
    from candlewick import plans
    named = json.dumps({"k": {"s": "XY", "c": "1", "v": "1", "x": True, "T": 1704067259999}})
    records = messages(spark, [named])
    for symbol, want in ((None, "XY"), ("AB", "AB"), (F.col("key").cast("string"), "k")):
        got = plans.candle_topic_to_ticks(records, symbol).first()
        assert (got["key"], json.loads(got["value"])["symbol"]) == (want, want)


def test_encode_leaves_null_fields_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "symbol string, vwap double")
    got = {r["key"]: json.loads(r["value"]) for r in op.encode_json(df, "symbol").collect()}
    assert got == {"a": {"symbol": "a", "vwap": 1.0}, "b": {"symbol": "b"}}


def chart(text, spark):
    df = spark.createDataFrame([("S", text)], "symbol string, text string")
    return [(int(r["datetime"].timestamp()), *r[2:]) for r in op.chart_bars(df).orderBy("datetime").collect()]


def capture(series, name="sds_1"):
    return f'~m~9~m~{{"m":"du","p":["cs_1",{{"{name}":{{"node":"n","s":{series},"ns":{{}}}}}}]}}'


def test_chart_bars(spark):
    text = capture('[{"i":0,"v":[1704067200.0,1.0,2.0,0.5,1.5,9.0]},'
                   '{"i":1,"v":[1704153600.0,1.5,2.5,1.0,2.0]},{"i":2,"v":[1704240000.0,2.0,3.0,1.5,2.5,7.5]}]')
    assert chart("~m~4~m~~h~1" + text, spark) == [
        (1704067200, 1.0, 2.0, 0.5, 1.5, 9.0),
        (1704153600, 1.5, 2.5, 1.0, 2.0, 0.0),
        (1704240000, 2.0, 3.0, 1.5, 2.5, 7.5),
    ]
    two = capture('[{"i":0,"v":[10,1,2,0.5,1.5,9]}]') + capture('[{"i":1,"v":[20,1,2,0.5,1.5,9]}]', "st_2")
    assert [r[0] for r in chart(two, spark)] == [10, 20]


def test_a_bad_price_costs_one_bar(spark):
    text = capture('[{"i":0,"v":[10,1.0,2.0,"?",1.5,9.0]},{"i":1,"v":[20,1.5,2.5,1.0,2.0,"?"]},{"i":2,"v":[1e30,1,1,1,1]},'
                   '{"i":3,"v":[30,"NaN",1,1,1]}]')
    assert chart(text, spark) == [(20, 1.5, 2.5, 1.0, 2.0, 0.0)]
    df = spark.createDataFrame([("S", text)], "symbol string, text string")
    rejected = op.rejected_chart_bars(df).collect()
    assert [(r["symbol"], json.loads(r["bar"])["i"]) for r in rejected] == [("S", 0), ("S", 2), ("S", 3)]


@pytest.mark.parametrize("text", ["", "no data", '"s":[]', "~m~3~m~{", capture("[]"), capture("null"), '{"m":"x","p":["a"]}', None])
def test_captures_without_bars(spark, text):
    assert chart(text, spark) == []


def test_chart_messages(spark):
    texts = ['~m~1~m~{"p":["qs_1",{"n":"A","v":{"a":"b"}}],"m":"qsd"}~m~1~m~{"m":"x","p":[]}', "~h~1", '{"m":"only"}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    assert [tuple(r) for r in op.chart_messages(df).collect()] == [
        (0, "qsd", '["qs_1",{"n":"A","v":{"a":"b"}}]'), (0, "x", "[]")]


ZONES = """
import datetime as dt, sys
sys.path.insert(0, sys.argv[1])
from candlewick import operators as op, sources
from candlewick.session import build_session
spark = build_session("zones", master="local[1]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 1})
df = spark.sql("SELECT explode(sequence(timestamp'2024-01-31 00:00', timestamp'2024-02-02 23:00', interval 1 hour)) datetime")
sources.write_layer(sources.with_year_month(df), sys.argv[2])
utc = dt.timezone.utc
for start, end in ((dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)),
                   (dt.datetime(2024, 2, 1, tzinfo=dt.timezone(dt.timedelta(hours=2))), None),
                   (None, dt.datetime(2024, 1, 31, 22, tzinfo=dt.timezone(-dt.timedelta(hours=5))))):
    rows = sources.read_bars(spark, sys.argv[2], start, end)
    low = start or dt.datetime(2000, 1, 1)
    high = end or dt.datetime(2100, 1, 1)
    print(rows.count(), op.time_range(df, low, high).count())
"""


def test_bounds_do_not_move_with_the_host_zone(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path
    run = subprocess.run([sys.executable, "-c", ZONES, str(Path(__file__).resolve().parents[1]), str(tmp_path / "bars")],
                         env={**os.environ, "TZ": "Europe/Madrid"}, capture_output=True, text=True, timeout=300)
    assert run.stdout.split("\n")[:3] == ["24 24", "50 50", "27 27"], run.stderr[-800:]


def test_time_range_is_half_open(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-03-30 00:00', timestamp'2024-04-02 00:00', interval 1 day)) t")
    got = op.time_range(df, F.lit("2024-03-31").cast("timestamp"), F.lit("2024-04-02").cast("timestamp"), "t")
    assert [str(r[0].date()) for r in got.orderBy("t").collect()][0] in ("2024-03-31", "2024-03-30")
    assert got.count() == 2
    assert op.with_symbol(got, "A").columns == ["symbol", "t"]


def test_kafka_options():
    plain = kafka.KafkaConfig.from_env({"KAFKA_BOOTSTRAP_SERVERS": "h:1"})
    assert plain.options() == {"kafka.bootstrap.servers": "h:1"}
    secret = kafka.KafkaConfig("h:1", "me", 'p"w')
    options = secret.options()
    assert options["kafka.security.protocol"] == "SASL_PLAINTEXT" and options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"].endswith('username="me" password="p\\"w";')
    assert 'p"w' not in repr(secret)
    assert kafka.stream_options(["a", "b"], "earliest", 10, 4) == {
        "subscribe": "a,b", "startingOffsets": "earliest", "maxOffsetsPerTrigger": 10, "minPartitions": 4}
    assert kafka.partition_options("t", 0, 5) == {
        "assign": '{"t": [0]}', "startingOffsets": '{"t": {"0": 5}}', "endingOffsets": "latest"}


def test_record_preview(spark):
    got = kafka.record_preview(messages(spark, [GOOD])).first()
    assert (got["key"], got["value"], got["offset"]) == ("k", GOOD, 0)
