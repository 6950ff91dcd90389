import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
TICKS = "symbol string, event_time timestamp, seq bigint, close double, volume double"


def ticks(spark, n=500, symbols=("a", "b"), seed=1):
    rng = random.Random(seed)
    rows = [(s, START + dt.timedelta(seconds=rng.randrange(7200)), i, round(rng.uniform(1, 9), 2), float(rng.randrange(5)))
            for s in symbols for i in range(n)]
    return rows, spark.createDataFrame(rows, TICKS).repartition(5)


def five(t):
    return START + dt.timedelta(minutes=(t - START).seconds // 300 * 5)


def test_vwap_matches_plain_sums(spark):
    rows, df = ticks(spark)
    want = {}
    for s, t, _, c, v in rows:
        value, volume = want.get((s, five(t)), (0.0, 0.0))
        want[s, five(t)] = (value + c * v, volume + v)
    got = op.vwap(df).select("symbol", "window.start", "vwap").collect()
    assert len(got) == len(want)
    for s, start, vwap in got:
        value, volume = want[s, start.astimezone(dt.timezone.utc)]
        assert vwap == pytest.approx(value / volume)


def test_zero_volume_gives_no_price_and_no_message(spark):
    df = spark.createDataFrame([("a", START, 1, 2.0, 0.0), ("b", START, 1, 2.0, 1.0), ("c", None, 1, 2.0, 1.0)], TICKS)
    rows = op.vwap_rows(op.vwap(df))
    assert {r["symbol"]: r["vwap"] for r in rows.collect()} == {"a": None, "b": 2.0}
    assert [r["key"] for r in op.encode_vwap(rows).collect()] == ["b"]
    assert [r["symbol"] for r in op.empty_windows(rows).collect()] == ["a"]
    assert rows.filter("symbol = 'b'").select("window_start", "window_end").first()[:] == (
        "2024-01-01 00:00:00", "2024-01-01 00:05:00")


def test_vwap_reduces_before_the_shuffle(spark):
    _, df = ticks(spark)
    plan = op.vwap(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_ticks_to_bars(spark):
    rows, df = ticks(spark)
    want = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        want.setdefault((row[0], five(row[1])), []).append(row)
    got = op.ticks_to_bars(df, "5", tie="seq").collect()
    assert len(got) == len(want)
    for r in got:
        group = want[r["symbol"], r["datetime"].astimezone(dt.timezone.utc)]
        prices = [g[3] for g in group]
        assert (r["open"], r["high"], r["low"], r["close"]) == (prices[0], max(prices), min(prices), prices[-1])
        assert r["volume"] == sum(g[4] for g in group)


def test_bars_of_bars_equal_bars_of_ticks(spark):
    _, df = ticks(spark)
    direct = op.ticks_to_bars(df, "1H", tie="seq")
    twice = op.resample(op.ticks_to_bars(df, "5", tie="seq"), "1H")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, twice.collect()))


def test_bars_stay_in_the_hash_aggregate(spark):
    _, df = ticks(spark)
    for tie in (None, "seq"):
        plan = op.ticks_to_bars(df, "5", tie=tie)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_extreme_ties(spark, kind):
    ties = [-2**63, -1, 0, 2**63 - 1, None] if kind == "bigint" else ["a", "b", "ba", "c", None]
    rows = [("s", year, tie, float(i), 1.0) for year in (1, 9999) for i, tie in enumerate(ties)]
    df = spark.createDataFrame(rows, f"symbol string, year int, seq {kind}, close double, volume double")
    df = df.withColumn("event_time", F.make_timestamp("year", F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59)))
    bars = op.ticks_to_bars(df.repartition(4), "1D", tie="seq").select("open", "close", "volume").collect()
    assert [tuple(r) for r in bars] == [(4.0, 3.0, 5.0)] * 2


def series(spark, n):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "warm").otherwise("cold").alias("symbol"),
        F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(100_003))).alias("datetime"), "id")


@pytest.mark.parametrize("n_bars", [1, 10, 1001, 3000])
def test_latest_bars(spark, n_bars):
    df = series(spark, 7000)
    rows = df.collect()
    want = set()
    for symbol in ("hot", "warm", "cold"):
        mine = sorted((r for r in rows if r["symbol"] == symbol), key=lambda r: r["datetime"], reverse=True)
        want |= {r["id"] for r in mine[:n_bars]}
    got = op.latest_bars(df, n_bars).collect()
    assert len(got) == len(want) and {r["id"] for r in got} == want
    with pytest.raises(ValueError):
        op.latest_bars(df, 0)


def test_latest_bars_cut_before_the_shuffle(spark):
    """No exchange stands on an uncut scan: below each there is a partial count or the join with the cuts."""
    import re
    for n in (10, 5000):
        plan = op.latest_bars(series(spark, 100), n)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        depth = [len(re.match(r"[\s:|+*()\d-]*", line)[0]) for line in lines]
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" not in line:
                continue
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            assert any("BroadcastHashJoin" in b or "partial_count" in b for b in below), plan


def test_rows_without_a_time(spark):
    df = series(spark, 40).withColumn("datetime", F.when(F.col("id") % 4 > 0, F.col("datetime")))
    assert op.latest_bars(df, 100).count() == 40
    got = op.latest_bars(df, 5).collect()
    assert len(got) == 15 and all(r["datetime"] for r in got)
    bars = df.selectExpr("symbol", "datetime", "1D open", "1D high", "1D low", "1D close", "1D volume")
    for interval in ("5", "1D", "1W", "1M"):
        assert op.resample(bars, interval).filter("datetime IS NULL").count() == 0


def test_latest_rows_of_one_series_and_of_equal_hours(spark):
    df = spark.range(3000).selectExpr("'a' symbol", "timestamp_seconds(id % 7) datetime", "id")
    assert op.latest_bars(df, 900, keys=()).filter("datetime >= timestamp_seconds(4)").count() == 900
    assert op.latest_bars(df, 10, tie="id").agg(F.min("id")).first()[0] >= 2900


def test_history_of_one_symbol(spark):
    _, df = ticks(spark)
    bars = op.history(op.ticks_to_bars(df, "1", tie="seq"), "a", interval="15", n_bars=3).orderBy("datetime").collect()
    assert [r["datetime"].astimezone(dt.timezone.utc).strftime("%H:%M") for r in bars] == ["01:15", "01:30", "01:45"]
    assert {r["symbol"] for r in bars} == {"a"}


def test_history_under_the_full_name(spark):
    _, df = ticks(spark, symbols=("EX:a", "EX:a2!", "a"))
    bars = op.ticks_to_bars(df, "1", tie="seq")
    got = [op.history(bars, "a", *exchange, contract=contract, interval="1H", n_bars=1).select("symbol").collect()[0][0]
           for exchange, contract in (([], None), (["EX"], None), (["EX"], 2))]
    assert got == ["a", "EX:a", "EX:a2!"]
