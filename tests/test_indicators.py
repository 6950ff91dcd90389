import datetime as dt
import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import indicators as I
from candlewick.operators import ordered

SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("close", T.DoubleType()),
])
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def make(spark, series, parts=3):
    """series: symbol -> list of close; one bar a minute, shuffled."""
    rows = [(s, START + dt.timedelta(minutes=i), i, v) for s, values in series.items() for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def column(df, name, symbol):
    rows = df.filter(F.col("symbol").eqNullSafe(symbol)).select("seq", name).collect()
    return [v for _, v in sorted((tuple(r) for r in rows), key=lambda r: r[0])]


def same(got, want):
    assert len(got) == len(want)
    for i, (g, w) in enumerate(zip(got, want)):
        assert (g is None) == (w is None), (i, g, w)
        if g is not None:
            assert g == pytest.approx(w, rel=1e-9, abs=1e-9), (i, g, w)


def expected(values):
    line, signal, histogram = brute.macd(values)
    return {
        "sma200": brute.sma(values, 200), "sma5": brute.sma(values, 5), "ema50": brute.ema(values, 50),
        "ema1": brute.ema(values, 1), "rsi14": brute.rsi(values, 14), "macd_line": line, "signal_line": signal,
        "macd_histogram": histogram, "price_change": brute.change(values), "gain": brute.gain(values),
        "loss": brute.loss(values),
    }


ALL = (*I.GOLD, I.Sma(5), I.Ema(1), I.PriceChange(), I.GainLoss())


def noisy(n, seed, nulls=0.2):
    rng = random.Random(seed)
    return [None if rng.random() < nulls else round(rng.uniform(1, 100), 2) for _ in range(n)]


@pytest.fixture(scope="module")
def series():
    return {
        "hot": noisy(3000, 1),
        "late": [None] * 700 + noisy(400, 2),
        "flat": [5.0] * 300,
        "one": [7.0],
        "none": [None, None, None],
        None: noisy(50, 3),
        **{f"s{i}": noisy(7, i) for i in range(60)},
    }


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_all_indicators_match_definitions(spark, series, partitions, monkeypatch):
    monkeypatch.setattr(ordered, "BATCH_ROWS", 97)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = I.with_indicators(make(spark, series), *ALL).toPandas()
        assert len(got) == sum(map(len, series.values()))
        for symbol, values in series.items():
            mine = got[got.symbol.isna() if symbol is None else got.symbol == symbol].sort_values("seq")
            for name, want in expected(values).items():
                want = np.array([np.nan if v is None else v for v in want])
                np.testing.assert_allclose(mine[name].to_numpy(), want, rtol=1e-9, atol=1e-9, err_msg=f"{symbol} {name}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_partitions_smaller_than_the_frames(spark):
    values = noisy(500, 9)
    spark.conf.set("spark.sql.shuffle.partitions", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = I.with_indicators(make(spark, {"a": values}), *ALL)
        assert got.rdd.getNumPartitions() > 20
        for name, want in expected(values).items():
            same(column(got, name, "a"), want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_keys_is_one_series(spark):
    values = noisy(400, 4)
    df = make(spark, {"a": values})
    keyed = I.with_indicators(df, *I.GOLD)
    whole = I.with_indicators(df.drop("symbol"), *I.GOLD, keys=()).withColumn("symbol", F.lit("a"))
    for name in ("sma200", "ema50", "rsi14", "signal_line"):
        same(column(keyed, name, "a"), column(whole, name, "a"))


def test_single_functions_match_the_shared_pass(spark):
    df = make(spark, {"a": noisy(300, 5), "b": noisy(200, 6)})
    shared = I.with_indicators(df, *I.GOLD)
    chained = df.transform(I.sma).transform(I.ema).transform(I.rsi).transform(I.macd)
    assert shared.columns == chained.columns == [
        "symbol", "datetime", "seq", "close", "sma200", "ema50", "rsi14", "macd_line", "signal_line", "macd_histogram"]
    for name in shared.columns[4:]:
        same(column(shared, name, "b"), column(chained, name, "b"))


def test_existing_columns_stay(spark):
    df = make(spark, {"a": noisy(30, 7)})
    marked = df.withColumn("sma5", F.lit(-1.0)).withColumn("signal_line", F.lit(-2.0))
    assert I.sma(marked, 5) is marked
    assert I.macd(marked) is marked
    once = I.ema(marked, 5)
    assert I.ema(once, 5) is once
    assert {r[0] for r in once.select("sma5").collect()} == {-1.0}


def test_user_columns_with_helper_names_survive(spark):
    df = make(spark, {"a": noisy(30, 8)})
    for name in ("diff", "gain", "rs", "ema12", "ema9"):
        df = df.withColumn(name, F.lit(1.5))
    got = df.transform(I.rsi).transform(I.macd)
    assert set(df.columns) < set(got.columns)
    assert got.filter("diff != 1.5 or gain != 1.5 or rs != 1.5 or ema12 != 1.5 or ema9 != 1.5").count() == 0
    same(column(got, "rsi14", "a"), brute.rsi(noisy(30, 8), 14))


def test_macd_with_equal_periods(spark):
    values = noisy(80, 10)
    got = I.macd(make(spark, {"a": values}), fast=9, slow=26, signal=9)
    line, signal, _ = brute.macd(values, 9, 26, 9)
    same(column(got, "macd_line", "a"), line)
    same(column(got, "signal_line", "a"), signal)


def test_equal_times_are_ordered_by_tie(spark):
    rows = [("a", START, i, float(i % 7)) for i in range(200)]
    random.Random(2).shuffle(rows)
    got = I.ema(spark.createDataFrame(rows, SCHEMA), 5, tie="seq")
    same(column(got, "ema5", "a"), brute.ema([float(i % 7) for i in range(200)], 5))


def test_equal_times_without_tie_do_not_depend_on_layout(spark):
    rows = [("a", START, i, float(i * i % 31)) for i in range(200)]
    one = I.ema(spark.createDataFrame(rows, SCHEMA).repartition(1), 5)
    two = I.ema(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), 5)
    same(column(one, "ema5", "a"), column(two, "ema5", "a"))


def test_not_a_number_spreads_as_in_sql(spark):
    values = [1.0, 2.0, float("nan"), 3.0, 4.0, 5.0, 6.0]
    got = I.with_indicators(make(spark, {"a": values, "b": [1.0, 2.0]}), I.Sma(2), I.Ema(3), I.Rsi(2))
    assert [np.isnan(v) for v in column(got, "sma2", "a")] == [False, False, True, True, False, False, False]
    assert [np.isnan(v) for v in column(got, "ema3", "a")] == [False, False, True, True, True, True, True]
    same(column(got, "ema3", "b"), brute.ema([1.0, 2.0], 3))


def test_a_large_value_leaves_no_residue(spark):
    values = [1e15, 0.1, 0.2, 0.3, 0.4, 0.4, 0.4, 0.4]
    got = I.with_indicators(make(spark, {"a": values}), I.Sma(3), I.Rsi(3))
    assert column(got, "sma3", "a")[4] == pytest.approx(0.3, rel=1e-15)
    assert column(got, "rsi3", "a")[-1] == 100.0


@pytest.mark.parametrize("bad", [0, -1, 2.5, None, True])
def test_periods_are_checked(bad):
    for make_one in (I.Sma, I.Ema, I.Rsi, I.Macd):
        with pytest.raises(ValueError):
            make_one(bad)


def test_integer_prices(spark):
    df = make(spark, {"a": [1.0, 2.0, 4.0]}).withColumn("close", F.col("close").cast("decimal(10,2)"))
    same(column(I.sma(df, 2), "sma2", "a"), [1.0, 1.5, 3.0])


def test_one_shuffle_and_no_single_partition(spark):
    df = make(spark, {"a": noisy(50, 1)})
    got = I.with_indicators(df, *I.GOLD)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_no_rows(spark):
    got = I.with_indicators(spark.createDataFrame([], SCHEMA), *I.GOLD)
    assert got.count() == 0 and "macd_histogram" in got.columns


def test_state_bound_limits_partitions():
    assert ordered._partition_limit(I.GOLD) > 5_000
    assert ordered._partition_limit([I.Sma(1_000_000)]) >= 1


def test_one_call_and_many_agree_on_equal_times(spark):
    rows = [("a", START, i, float(i * i % 31)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    one = I.with_indicators(df, I.PriceChange(), I.Ema(3), I.Sma(4))
    chained = df.transform(I.price_change).transform(I.ema, 3).transform(I.sma, 4)
    apart = I.sma(I.ema(I.price_change(df).select("*"), 3).select("*"), 4)
    want = {r["seq"]: tuple(r) for r in one.collect()}
    for got in (chained, apart):
        assert {r["seq"]: tuple(r) for r in got.collect()} == want


def test_a_chain_summarises_only_what_is_new(spark, monkeypatch):
    asked, make_summaries = [], ordered._summaries
    monkeypatch.setattr(ordered, "_summaries", lambda inds: asked.append([type(i).__name__ for i in inds]) or make_summaries(inds))
    df = make(spark, {"a": noisy(200, 4), "b": noisy(90, 5)})
    got = df.transform(I.sma).transform(I.ema).transform(I.macd)
    assert asked == [["Sma"], ["Ema"], ["Macd"]]
    for name in ("sma200", "ema50", "signal_line"):
        same(column(got, name, "a"), expected(noisy(200, 4))[name])


def test_min_periods(spark):
    values = noisy(60, 3)
    got = I.with_indicators(make(spark, {"a": values}), I.Sma(5, 5), I.Ema(7, 20), I.Rsi(4, 10))
    plain = I.with_indicators(make(spark, {"a": values}), I.Sma(5), I.Ema(7), I.Rsi(4))
    for name, first in (("sma5", 5), ("ema7", 20), ("rsi4", 10)):
        want = column(plain, name, "a")
        same(column(got, name, "a"), [None] * (first - 1) + want[first - 1:])


def test_names_are_compared_without_case(spark, caplog):
    df = make(spark, {"a": noisy(10, 1)}).withColumn("SMA5", F.lit(1.0)).withColumn("signal_line", F.lit(1.0))
    assert I.sma(df, 5) is df
    with caplog.at_level("WARNING"):
        assert I.macd(df) is df
    assert "signal_line" in caplog.text


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load().selectExpr("'a' symbol", "timestamp datetime", "1D close")
    with pytest.raises(ValueError, match="stream"):
        I.sma(stream)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(0, 100)), min_size=1, max_size=80), st.integers(1, 90))
def test_rolling_sum_property(pairs, n):
    runs = sorted(p[0] for p in pairs)
    values = np.array([p[1] for p in pairs])
    position = np.array([i - runs.index(r) for i, r in enumerate(runs)])
    want = [values[i - min(n - 1, position[i]):i + 1].sum() for i in range(len(values))]
    assert np.allclose(ordered.rolling_sum(values, position, n), want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.floats(-50, 50)), min_size=1, max_size=70))
def test_affine_scan_property(pairs):
    a, b = np.array([p[0] for p in pairs]), np.array([[p[1]] for p in pairs])
    scan_a, scan_b = ordered.affine_scan(a, b)
    value = 3.0
    for i in range(len(a)):
        value = a[i] * value + b[i, 0]
        assert np.isclose(scan_a[i] * 3.0 + scan_b[i, 0], value, atol=1e-6)


def test_filters_and_limits_after_the_scan_do_not_change_values(spark):
    values = noisy(300, 11)
    got = I.with_indicators(make(spark, {"a": values, "b": noisy(50, 12)}), *I.GOLD)
    want = {i: v for i, v in enumerate(brute.ema(values, 50))}
    some = got.filter("symbol = 'a' AND seq % 7 = 3 AND close > 20").select("seq", "ema50").collect()
    assert len(some) > 20
    for seq, value in some:
        assert value == pytest.approx(want[seq], rel=1e-12)
    for row in got.filter("symbol = 'a'").coalesce(1).limit(40).collect():
        assert (row["ema50"] is None) == (want[row["seq"]] is None)
        assert row["ema50"] is None or row["ema50"] == pytest.approx(want[row["seq"]], rel=1e-12)
    assert got.filter("symbol = 'b'").count() == 50


def test_a_group_of_copies_is_split(spark):
    copies = spark.range(0, 60_000, 1, 8).select(
        F.lit("a").alias("symbol"), F.lit(START).alias("datetime"), F.lit(2.5).alias("close"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = I.with_indicators(copies, *I.GOLD).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 60_000 and max(sizes) <= 30_000
    off = "abs(sma200 - 2.5) > 1e-12 OR abs(ema50 - 2.5) > 1e-12 OR rsi14 != 100 OR abs(macd_line) > 1e-12"
    assert got.filter(off).count() == 0


def test_a_chain_sorts_once(spark, monkeypatch):
    sorts, sort = [], ordered._sort
    monkeypatch.setattr(ordered, "_sort", lambda *args: sorts.append(args) or sort(*args))
    df = make(spark, {"tail": noisy(300, 5), "b": noisy(200, 6)}).withColumnRenamed("symbol", "part")
    chained = df.transform(I.sma, keys=["part"]).transform(I.ema, keys=["part"]).transform(I.macd, keys=["part"])
    assert len(sorts) == 1
    got = chained.withColumnRenamed("part", "symbol")
    assert got.columns == ["symbol", "datetime", "seq", "close", "sma200", "ema50", "macd_line", "signal_line",
                           "macd_histogram"]
    for name in ("sma200", "ema50", "signal_line"):
        same(column(got, name, "b"), expected(noisy(200, 6))[name])
    I.rsi(chained, keys=["part"], value_col="sma200")
    assert len(sorts) == 2
    I.rsi(chained.filter("seq > 5"), keys=["part"])
    assert len(sorts) == 3
