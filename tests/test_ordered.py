"""The scan's passes without Spark: any cut of the sorted rows into partitions and batches gives the same columns."""

import datetime as dt
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from candlewick.operators import indicators as I
from candlewick.operators import ordered

INDICATORS = (I.Sma(5), I.Ema(4), I.Rsi(3), I.Macd(2, 5, 3), I.Ema(1), I.PriceChange(), I.GainLoss())


def wanted(series):
    columns = {name: [] for ind in INDICATORS for name in ind.columns}
    for values in series.values():
        line, signal, histogram = brute.macd(values, 2, 5, 3)
        for name, part in {
            "sma5": brute.sma(values, 5), "ema4": brute.ema(values, 4), "rsi3": brute.rsi(values, 3),
            "macd_line": line, "signal_line": signal, "macd_histogram": histogram, "ema1": brute.ema(values, 1),
            "price_change": brute.change(values), "gain": brute.gain(values), "loss": brute.loss(values),
        }.items():
            columns[name] += part
    return columns


def batches(rows, part, size):
    for i in range(0, len(rows), size):
        piece = rows[i:i + size]
        yield (pa.array([v for _, v in piece], pa.float64()), pa.array([part] * len(piece), pa.int32()),
               pa.array([k for k, _ in piece], pa.string()))


def scan(rows, cuts, size):
    borders = [0, *sorted(c % (len(rows) + 1) for c in cuts), len(rows)]
    parts = [rows[a:b] for a, b in zip(borders, borders[1:])]
    summaries = []
    for part, piece in enumerate(parts):
        out = [s for a in ordered._summaries(INDICATORS)(batches(piece, part, size)) for s in a.to_pylist()]
        assert len(out) == len(piece)
        summaries += [Row(symbol=key, part=part, **summary) for (key, _), summary in zip(piece, out) if summary]
    assert len(summaries) <= 2 * len(parts)
    starts = SimpleNamespace(value=ordered._chain(summaries, INDICATORS, 1))
    return [s for part, piece in enumerate(parts)
            for a in ordered._outputs(INDICATORS, starts)(batches(piece, part, size)) for s in a.to_pylist()]


values = st.one_of(st.none(), st.integers(1, 400).map(lambda v: v / 4))
all_series = st.lists(st.lists(values, min_size=1, max_size=25), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(all_series, st.lists(st.integers(0, 200), max_size=12), st.integers(1, 40), st.integers(1, 60))
def test_cuts_do_not_matter(lists, cuts, size, batch_rows):
    series = {None if i == 0 else f"s{i}": v for i, v in enumerate(lists)}
    rows = [(k, v) for k, vs in series.items() for v in vs]
    before, ordered.BATCH_ROWS = ordered.BATCH_ROWS, batch_rows
    try:
        got = scan(rows, cuts, size)
    finally:
        ordered.BATCH_ROWS = before
    for name, want in wanted(series).items():
        mine = [row[name] for row in got]
        assert [v is None for v in mine] == [v is None for v in want], name
        np.testing.assert_allclose([v or 0.0 for v in mine], [v or 0.0 for v in want], rtol=1e-9, atol=1e-9, err_msg=name)


SCHEMA = "id long, symbol string, datetime timestamp, close double"


def frame(spark, n, seed=0):
    """A series with three quarters of the rows and some short ones, with nulls."""
    rng = np.random.default_rng(seed)
    names = rng.choice(["A", "B", "C", "D", None], n, p=[0.75, 0.1, 0.1, 0.04, 0.01])
    rows = [(i, s, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i // 2), None if rng.random() < 0.1 else float(round(rng.uniform(1, 9), 2)))
            for i, s in enumerate(names.tolist())]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("partitions, batch_rows", [(1, 64), (7, 8), (40, 64)])
def test_frames_exchanged_as_rows(spark, monkeypatch, partitions, batch_rows):
    """Frames of a few rows, of several partitions and of more than all rows, with copies of rows in place of values on the driver."""
    df = frame(spark, 900, partitions)
    indicators = (I.Sma(3), I.Sma(90), I.Sma(5000), I.Rsi(250), I.Ema(7, min_periods=400), I.Macd(3, 6, 4), I.PriceChange())
    want = {r["id"]: r for r in I.with_indicators(df, *indicators, tie="id").collect()}
    monkeypatch.setattr(ordered, "STATE_BYTES", 1)
    monkeypatch.setattr(ordered, "BATCH_ROWS", batch_rows)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = I.with_indicators(df.withColumn("other", F.col("id") * 2), *indicators, tie="id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(got) == 900 and all(r["other"] == 2 * r["id"] for r in got)
    for r in got:
        for name in (c for ind in indicators for c in ind.columns):
            a, b = r[name], want[r["id"]][name]
            assert (a is None) == (b is None) and (a is None or np.isclose(a, b, rtol=1e-9, atol=1e-9)), (r, name)


def test_long_frames_keep_the_partitions(spark, monkeypatch):
    """An average over a million rows: as many partitions as are set, and no values of a frame on the driver."""
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # the table is small
    try:
        assert ordered._partition_limit([I.Sma(1_000_000)]) < 60
        seen = []
        chain = ordered._chain
        monkeypatch.setattr(ordered, "_chain", lambda summaries, *rest: seen.extend(summaries) or chain(summaries, *rest))
        got = I.sma(frame(spark, 3000), 1_000_000, tie="id")
        assert got.rdd.getNumPartitions() > 40
        assert len({r["part"] for r in seen}) > 55 and not any(r["tail"] for r in seen)
        rows = [r for r in got.collect() if r["symbol"] == "A"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    rows.sort(key=lambda r: r["id"])
    np.testing.assert_allclose([r["sma1000000"] or 0 for r in rows], [v or 0 for v in brute.sma([r["close"] for r in rows], 1_000_000)], rtol=1e-9)
