"""Indicators over a series in several runs equal those over the whole of it."""

import datetime as dt
import random
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick import plans, sources
from candlewick.sources.states import StateTable

EVERY = (op.Sma(5), op.Sma(3, min_periods=9), op.Ema(4), op.Ema(7, min_periods=6), op.Rsi(3), op.Rsi(6, min_periods=11), op.Macd(3, 6, 4),
         op.PriceChange(), op.GainLoss())
SCHEMA = "id long, symbol string, at long, price double"


def rows_of(seed, n=400):
    """Series of very different lengths, some of nulls at first or throughout, with equal times and one null key."""
    rng = random.Random(seed)
    names = ["A"] * 12 + ["B"] * 4 + ["C", "D", None, "nulls", "late"]
    rows = []
    for i in range(n):
        name = rng.choice(names)
        price = None if name == "nulls" or rng.random() < 0.15 or (name == "late" and i < n * 0.7) else round(rng.uniform(1, 9), 2)
        rows.append((i, name, i // 3, price))
    return rows


def collected(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: r[columns.index("id")])


def assert_same(one, two):
    assert one[0] == two[0] and len(one[1]) == len(two[1])
    for a, b in zip(one[1], two[1]):
        for x, y in zip(a, b):
            assert x == y or (x is not None and y is not None and not isinstance(x, str) and np.isclose(x, y, rtol=1e-9, atol=1e-9)), (a, b)


def in_runs(spark, rows, cuts, indicators, **series):
    state, out = None, None
    for low, high in zip([0, *cuts], [*cuts, 10 ** 9]):
        part = spark.createDataFrame([r for r in rows if low <= r[2] < high], SCHEMA).repartition(3)
        got, state = op.resume_indicators(part, state, *indicators, time_col="at", value_col="price", **series)
        got = spark.createDataFrame(got.collect(), got.schema)
        state = spark.createDataFrame(state.collect(), state.schema)
        out = got if out is None else out.unionByName(got)
    return out, state


@pytest.mark.parametrize("seed, cuts", [(1, (40,)), (2, (1, 2, 3)), (3, (60, 60, 61, 130)), (4, (0, 90, 200))])
def test_runs_equal_the_whole(spark, seed, cuts):
    rows = rows_of(seed)
    whole = op.with_indicators(spark.createDataFrame(rows, SCHEMA), *EVERY, time_col="at", value_col="price", tie="id")
    got, state = in_runs(spark, rows, cuts, EVERY, tie="id")
    assert_same(collected(got), collected(whole))
    assert state.count() == len({r[1] for r in rows}) and max(len(r["tail"]) for r in state.collect()) <= 11


def test_without_frames_or_averages_or_keys(spark):
    rows = rows_of(5, 120)
    for indicators in ((op.Ema(5),), (op.Sma(4),), (op.Macd(2, 5, 3), op.Ema(9))):
        for keys in (("symbol",), ()):
            whole = op.with_indicators(spark.createDataFrame(rows, SCHEMA), *indicators, time_col="at", value_col="price", keys=keys, tie="id")
            got, _ = in_runs(spark, rows, (13, 25), indicators, keys=keys, tie="id")
            assert_same(collected(got), collected(whole))


def test_order_by_content_and_equal_rows(spark):
    rows = [(i, "A", i // 50, float(i % 7)) for i in range(300)]
    whole = op.with_indicators(spark.createDataFrame(rows, SCHEMA), *EVERY, time_col="at", value_col="price")
    got, _ = in_runs(spark, rows, (2, 4), EVERY)
    assert_same(collected(got), collected(whole))


def test_batches_and_partitions_cut_anywhere(spark, monkeypatch):
    """Small batches: states are handed on within a partition, at its border, and where a series ends with a batch."""
    from candlewick.operators import ordered
    monkeypatch.setattr(ordered, "BATCH_ROWS", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = rows_of(6, 200)
        whole = op.with_indicators(spark.createDataFrame(rows, SCHEMA), *EVERY, time_col="at", value_col="price", tie="id")
        got, _ = in_runs(spark, rows, (20, 41), EVERY, tie="id")
        assert_same(collected(got), collected(whole))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_names_and_nothing(spark):
    df = spark.createDataFrame(rows_of(7, 20), SCHEMA)
    with pytest.raises(ValueError, match="sma5"):
        op.resume_indicators(df.withColumn("SMA5", F.lit(1)), None, op.Sma(5), time_col="at", value_col="price")
    with pytest.raises(ValueError, match="no indicators"):
        op.resume_indicators(df, None, time_col="at", value_col="price")
    got, state = op.resume_indicators(df.limit(0), None, op.Sma(5), op.Ema(3), time_col="at", value_col="price")
    assert got.count() == state.count() == 0


@pytest.fixture(scope="module")
def bars(spark):
    days = spark.sql("SELECT explode(sequence(timestamp'2022-01-01', timestamp'2022-12-31', interval 6 hour)) AS datetime")
    return days.crossJoin(spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")).filter("symbol <> 'C' OR datetime >= '2022-08-15'") \
        .select("symbol", "datetime", *[(F.abs(F.hash("symbol", "datetime", F.lit(i))) % 10_000 / 100).alias(name)
                                        for i, name in enumerate(("open", "high", "low", "close", "volume"))])


def at(*when):
    return dt.datetime(*when, tzinfo=dt.timezone.utc)


def gold_rows(df):
    return collected(df.withColumn("id", F.concat("symbol", F.date_format("datetime", "yyyyMMddHH"))))


def test_gold_in_runs_and_after_a_crash(spark, bars, tmp_path):
    silver, gold, state = (str(tmp_path / name) for name in ("silver", "gold", "state"))
    sources.write_layer(sources.with_year_month(bars), silver)
    plans.extend_gold(spark, silver, gold, state, at(2022, 3, 10, 5))
    plans.extend_gold(spark, silver, gold, state, at(2022, 9, 1))
    # A run whose gold is written, but not its state.
    shutil.copytree(state, f"{state}-before")
    plans.extend_gold(spark, silver, gold, state, at(2022, 9, 2))
    shutil.rmtree(state)
    shutil.move(f"{state}-before", state)
    plans.extend_gold(spark, silver, gold, state)
    plans.extend_gold(spark, silver, gold, state)  # nothing new
    whole = plans.add_gold_columns(sources.with_year_month(bars))
    assert_same(gold_rows(spark.read.parquet(gold)), gold_rows(whole))
    folders = sorted(p.name for p in Path(state).iterdir())
    assert len(folders) == 2
    states = spark.read.parquet(f"{state}/{folders[-1]}")
    assert {r["symbol"]: len(r["tail"]) for r in states.collect()} == {"A": 199, "B": 199, "C": 199}
    # New months, from the state alone: the silver of before is not there any more.
    more = bars.filter("datetime < '2022-02-01'").withColumn("datetime", F.col("datetime") + F.expr("INTERVAL 365 DAYS"))
    sources.write_layer(sources.with_year_month(more), f"{silver}-new")
    got = plans.extend_gold(spark, f"{silver}-new", gold, state)
    both = plans.add_gold_columns(sources.with_year_month(bars.unionByName(more)))
    assert_same(gold_rows(got), gold_rows(both))


def test_states_of_other_indicators_and_incomplete_ones(spark, tmp_path):
    path = str(tmp_path / "s")
    table = StateTable(spark, path, "one")
    assert table.latest() == (None, None)
    table.put(spark.range(2), at(2022, 1, 1))
    table.put(spark.range(3), dt.datetime(2022, 1, 2))  # in the session's zone, UTC
    (Path(path) / "until=9999999999999999").mkdir()
    when, rows = table.latest()
    assert when == at(2022, 1, 2) and rows.count() == 3 and rows.columns == ["id"]
    with pytest.raises(ValueError, match="made for one"):
        StateTable(spark, path, "two").latest()
