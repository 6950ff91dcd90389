"""The batch flow: chart captures -> bronze CSV -> silver Parquet -> gold Parquet with indicators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.functions import format_symbol
from candlewick.operators.bars import latest_bars
from candlewick.operators.decode import chart_bars
from candlewick.operators.indicators import GOLD, resume_indicators, with_indicators
from candlewick.sources.files import PARTITION, read_bars, read_bronze, write_bronze, write_layer
from candlewick.sources.states import StateTable


def build_bronze(captures: DataFrame, path: str, text_col: str = "text", replace: str = "all") -> None:
    """Captures with ``symbol``, ``exchange``, optional ``contract`` and the raw text to bronze CSV files."""
    contract = "contract" if "contract" in captures.columns else None
    named = captures.select(format_symbol("symbol", "exchange", contract).alias("symbol"), text_col)
    write_bronze(chart_bars(named, text_col), path, replace)


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, symbol: str | None = None,
                     source_tz: str | None = None, replace: str = "all") -> DataFrame:
    write_layer(read_bronze(spark, bronze, symbol, source_tz), silver, replace=replace)
    return spark.read.parquet(silver)


def _partitions_last(df: DataFrame) -> DataFrame:
    tail = [name for name in PARTITION if name in df.columns]
    return df.select(*[name for name in df.columns if name not in tail], *tail)


def add_gold_columns(bars: DataFrame, **series) -> DataFrame:
    """All gold indicators in one pass, with the partition columns last."""
    return _partitions_last(with_indicators(bars, *GOLD, **series))


def silver_to_gold(spark: SparkSession, silver: str, gold: str, replace: str = "all", **series) -> DataFrame:
    write_layer(add_gold_columns(read_bars(spark, silver), **series), gold, replace=replace)
    return spark.read.parquet(gold)


def latest_stored_bars(spark: SparkSession, path: str, n_bars: int = 10, keys: Sequence[str] = ("symbol",), time_col: str = "datetime",
                       tie: str | None = None) -> DataFrame:
    """The latest ``n_bars`` rows of every key of a layer; of the months, newest first, only those are read that a key needs.

    How many rows a key has in a month takes the key columns alone. From the newest month on, a key needs months until it has
    ``n_bars`` rows; a key without bars for years needs the old months in which it has them, and only its rows there.
    ``year`` and ``month`` are those of the time, as the layers here have them; rows without a time are left out.
    """
    table = spark.read.parquet(path)
    number = F.col("year") * 12 + F.col("month")
    counts = table.filter(number.isNotNull()).groupBy(*keys, number.alias("__month")).agg(F.count(F.lit(1)).alias("__n"))
    newest = Window.partitionBy(*keys).orderBy(F.col("__month").desc())
    needed = counts.withColumn("__newer", F.sum("__n").over(newest) - F.col("__n")).filter(F.col("__newer") < n_bars)
    # The first month of every key: one row for each key.
    first = needed.groupBy(*[F.col(f"`{key}`").alias(f"__{key}") for key in keys]).agg(F.min("__month").alias("__first"))
    months = [row[0] for row in needed.select("__month").distinct().collect()]  # as many as the calendar has
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"`{key}`").eqNullSafe(F.col(f"__{key}"))
    rows = table.filter(number.isin(months) & F.col(time_col).isNotNull()).join(first, same & (number >= F.col("__first")), "left_semi")
    return latest_bars(rows, n_bars, time_col, keys, tie)


def extend_gold(spark: SparkSession, silver: str, gold: str, state: str, until: dt.datetime | None = None) -> DataFrame:
    """Gold for the bars that came since the last call, from the state that it left: earlier bars are not read again.

    ``state`` is a folder with a row for each series as of a time, below which all bars are in gold. The first call starts with
    the whole of silver. A call takes the bars from that time on and before ``until`` (None: all), merges their gold rows into
    the months they belong to and leaves a new state. A call that died half-way can be repeated: gold rows are merged by symbol
    and time, and a state counts only when it is complete. Bars that arrive late, for times that are in gold already, need
    ``silver_to_gold``; it leaves no state, so start again with another folder then.
    """
    states = StateTable(spark, state, "; ".join(map(repr, GOLD)))
    since, before = states.latest()
    bars = read_bars(spark, silver, since, until).filter(F.col("datetime").isNotNull())
    last = bars.agg(F.max("datetime").alias("last")).select(F.unix_micros("last")).first()[0]
    if last is None:
        return spark.read.parquet(gold) if before is not None else add_gold_columns(bars)
    through = (dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=last + 1)) if until is None else until
    rows, after = resume_indicators(bars, before, *GOLD)
    write_layer(_partitions_last(rows), gold, replace="rows")
    states.put(after, through)
    return spark.read.parquet(gold)
