"""OHLCV bars at an interval, and the latest bars of each symbol."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import bucket_start, format_symbol, instant

# Keys are dealt into so many slots for the cut before the shuffle; a slot's cut is that of its key with the oldest rows.
CUT_SLOTS = 65_536
MERGE_WAYS = 64
# More than the distance of any two bigint values.
TIE_SPAN = Decimal(2 * 10**19)


def resample(
    bars: DataFrame,
    interval: str,
    time_col: str = "datetime",
    keys: Sequence[str] = ("symbol",),
    tie: str | None = None,
) -> DataFrame:
    """Bars to coarser bars: first open, highest high, lowest low, last close, summed volume per key and bucket.

    Rows without a time belong to no bucket and are left out.
    """
    return _bars(bars, interval, time_col, keys, _order(bars, time_col, tie), "open", "high", "low", "close")


def ticks_to_bars(
    ticks: DataFrame,
    interval: str,
    time_col: str = "event_time",
    keys: Sequence[str] = ("symbol",),
    tie: str | None = None,
) -> DataFrame:
    """Ticks to bars. ``tie`` orders ticks of equal time."""
    return _bars(ticks, interval, time_col, keys, _order(ticks, time_col, tie), "close", "close", "close", "close")


def _order(df: DataFrame, time_col: str, tie: str | None) -> Column:
    """Order of the rows in a bucket, of fixed width if possible: only then can the buckets be kept in a hash table.

    A whole-number tie is put behind the microseconds in one number of at most 37 digits.
    """
    if tie is None:
        return F.col(time_col)
    if not isinstance(df.schema[tie].dataType, T.IntegralType):
        return F.struct(time_col, tie)
    micros = F.unix_micros(time_col).cast("decimal(18,0)")
    last = F.coalesce(F.col(tie).cast("decimal(20,0)"), F.lit(Decimal(-2**63 - 1)))
    return (micros * F.lit(TIE_SPAN) + last).cast("decimal(38,0)")


def _bars(df: DataFrame, interval: str, time_col: str, keys: Sequence[str], order: Column,
          first: str, top: str, bottom: str, last: str) -> DataFrame:
    marked = df.filter(F.col(time_col).isNotNull()).withColumn("__order", order)
    return marked.groupBy(*keys, bucket_start(time_col, interval).alias("__bucket")).agg(
        F.min_by(first, "__order").alias("open"),
        F.max(top).alias("high"),
        F.min(bottom).alias("low"),
        F.max_by(last, "__order").alias("close"),
        F.sum("volume").alias("volume"),
    ).select(*keys, F.col("__bucket").alias("datetime"), "open", "high", "low", "close", "volume")


def latest_bars(
    bars: DataFrame,
    n_bars: int = 10,
    time_col: str = "datetime",
    keys: Sequence[str] = ("symbol",),
    tie: str | None = None,
) -> DataFrame:
    """The latest ``n_bars`` rows of every key; rows without a time count as the oldest.

    Rows are counted by key and hour first. From these counts follows, for each slot of keys, an hour before which no row
    can be among the latest; older rows are dropped where they are read (the cuts have a fixed number of rows and are
    broadcast). What is left is ranked in parts of a key, one per group of input tasks, which are then merged, so that a
    key with most of the rows does not meet in one task.
    """
    if n_bars < 1:
        raise ValueError(f"n_bars must be at least 1, not {n_bars}")
    order = [F.col(time_col).desc(), *([F.col(tie).desc()] if tie else [])]
    salts = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _recent(bars, n_bars, time_col, keys).withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    while salts > 1:
        rows = _first_rows(rows, [*keys, "__salt"], order, n_bars)
        rows = rows.withColumn("__salt", F.floor(F.col("__salt") / MERGE_WAYS))
        salts = -(-salts // MERGE_WAYS)
    return _first_rows(rows.drop("__salt"), keys, order, n_bars)


def _recent(bars: DataFrame, n_bars: int, time_col: str, keys: Sequence[str]) -> DataFrame:
    """The rows from the hour on in which the ``n_bars``-th latest row of the key lies, and possibly some older ones."""
    slot = F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(CUT_SLOTS))
    hours = bars.groupBy(*keys, F.date_trunc("hour", time_col).alias("__hour")).agg(F.count(F.lit(1)).alias("__n"))
    newest = Window.partitionBy(*keys).orderBy(F.col("__hour").desc_nulls_last())
    needed = hours.withColumn("__newer", F.sum("__n").over(newest) - F.col("__n")).filter(F.col("__newer") < n_bars)
    # An hour of null among the needed ones: rows without a time count, nothing may be cut.
    cuts = needed.groupBy(slot.alias("__slot")).agg(
        F.when(F.count_if(F.col("__hour").isNull()) == 0, F.min("__hour")).alias("__cut"))
    marked = bars.withColumn("__slot", slot).join(F.broadcast(cuts), "__slot")
    return marked.filter(F.col("__cut").isNull() | (F.col(time_col) >= F.col("__cut"))).select(*bars.columns)


def _first_rows(df: DataFrame, keys: Sequence[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def history(
    bars: DataFrame,
    symbol: str,
    exchange: str | None = None,
    interval: str = "1D",
    n_bars: int = 10,
    contract: int | None = None,
    time_col: str = "datetime",
    since=None,
) -> DataFrame:
    """The latest ``n_bars`` bars of one symbol at an interval, from finer bars.

    ``since``: a bound before which the bars are not looked at (``functions.instant``), so that the scan can skip old files.

    With an ``exchange`` the bars are looked up under the full name, ``EX:SYM`` or ``EX:SYM{contract}!``.
    """
    name = F.lit(symbol) if exchange is None else format_symbol(F.lit(symbol), F.lit(exchange), contract)
    own = bars.filter(F.col("symbol") == name)
    if since is not None:
        own = own.filter(F.col(time_col) >= instant(since))
    return latest_bars(resample(own, interval, time_col), n_bars)
