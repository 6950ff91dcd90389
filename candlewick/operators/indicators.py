"""Technical indicators per series: simple and exponential moving average, RSI, MACD, price change.

Each function appends columns to a frame of bars and works with ``df.transform``. Several indicators share one shuffle,
sort and pass through ``with_indicators``. ``keys=()`` treats the whole frame as one series.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from candlewick.operators.ordered import Indicator, Rows, ema_scan, ordered_scan, resumed_scan, rolling_sum

log = logging.getLogger(__name__)


def _check(**periods: int) -> None:
    for name, n in periods.items():
        if isinstance(n, bool) or not isinstance(n, int) or n < 1:
            raise ValueError(f"{name} must be an integer of at least 1, not {n!r}")


def _divide(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.divide(total, count, out=np.zeros(len(total)), where=count != 0)


def _changes(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Difference to the row before and whether there is one (both values known)."""
    diff = np.zeros(len(rows.x))
    diff[1:] = rows.x[1:] - rows.x[:-1]
    have = np.zeros(len(rows.x), dtype=bool)
    have[1:] = rows.known[1:] & rows.known[:-1] & (rows.position[1:] > 0)
    return diff, have


def _gain_loss(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Rise and fall as positive numbers, 0.0 where there is none. NaN counts as larger than any number, as in SQL."""
    diff, have = _changes(rows)
    return np.where(have & ~(diff <= 0), diff, 0.0), np.where(have & (diff < 0), -diff, 0.0)


def _early(rows: Rows, min_periods: int) -> np.ndarray:
    """New rows before which, themselves included, the series has fewer than ``min_periods`` rows."""
    return rows.position[rows.skip:] + 1 < min_periods


@dataclass(frozen=True)
class Sma(Indicator):
    """Mean of the last ``n`` rows including the current one; the head has shorter frames, nulls are left out."""

    n: int = 200
    min_periods: int = 1

    def __post_init__(self):
        _check(n=self.n, min_periods=self.min_periods)

    @property
    def columns(self):
        return [f"sma{self.n}"]

    @property
    def history(self):
        return max(self.n, self.min_periods) - 1

    def run(self, rows: Rows, carry: np.ndarray):
        total = rolling_sum(rows.x, rows.position, self.n)[rows.skip:]
        count = rolling_sum(rows.known, rows.position, self.n)[rows.skip:]
        return [(_divide(total, count), (count == 0) | _early(rows, self.min_periods))], []


@dataclass(frozen=True)
class Ema(Indicator):
    """Exponential average with alpha = 2 / (n + 1), seeded by the first value; null rows repeat the last average."""

    n: int = 50
    min_periods: int = 1

    def __post_init__(self):
        _check(n=self.n, min_periods=self.min_periods)

    averages = 1

    @property
    def history(self):
        return self.min_periods - 1

    @property
    def columns(self):
        return [f"ema{self.n}"]

    def seed_averages(self, value):
        return [value]

    def run(self, rows: Rows, carry: np.ndarray):
        known = rows.known[rows.skip:]
        average = ema_scan(rows.new_x, known, rows.seed, 2 / (self.n + 1), carry[0], rows.given_average(0))
        return [(average[:, 0], ~rows.seeded | _early(rows, self.min_periods))], [average]


@dataclass(frozen=True)
class Rsi(Indicator):
    """Relative strength index on plain means of the last ``n`` rises and falls; 100 while there is no fall."""

    n: int = 14
    min_periods: int = 1

    def __post_init__(self):
        _check(n=self.n, min_periods=self.min_periods)

    @property
    def columns(self):
        return [f"rsi{self.n}"]

    @property
    def history(self):
        return max(self.n, self.min_periods - 1)

    def run(self, rows: Rows, carry: np.ndarray):
        gain, loss = _gain_loss(rows)
        rise = rolling_sum(gain, rows.position, self.n)[rows.skip:]
        fall = rolling_sum(loss, rows.position, self.n)[rows.skip:]
        strength = _divide(rise, fall)
        index = np.where(fall == 0, 100.0, 100 - 100 / (1 + strength))
        return [(index, _early(rows, self.min_periods))], []


@dataclass(frozen=True)
class Macd(Indicator):
    """Fast minus slow exponential average, its own exponential average, and the difference of the two."""

    fast: int = 12
    slow: int = 26
    signal: int = 9

    def __post_init__(self):
        _check(fast=self.fast, slow=self.slow, signal=self.signal)

    columns = ("macd_line", "signal_line", "macd_histogram")
    averages = 3

    def seed_averages(self, value):
        return [value, value, 0.0]

    def run(self, rows: Rows, carry: np.ndarray):
        known = rows.known[rows.skip:]
        fast = ema_scan(rows.new_x, known, rows.seed, 2 / (self.fast + 1), carry[0], rows.given_average(0))
        slow = ema_scan(rows.new_x, known, rows.seed, 2 / (self.slow + 1), carry[1], rows.given_average(1))
        line = fast - slow
        # The line goes on over null prices, so the signal moves at every row after the first price.
        signal = ema_scan(line, rows.seeded, rows.seed, 2 / (self.signal + 1), carry[2], rows.given_average(2))
        empty = ~rows.seeded
        histogram = line[:, 0] - signal[:, 0]
        return ([(line[:, 0], empty), (signal[:, 0], empty), (histogram, empty)],
                [fast, slow, signal])


@dataclass(frozen=True)
class PriceChange(Indicator):
    """Change to the row before: null on the first row and next to a null."""

    columns = ("price_change",)
    history = 1

    def run(self, rows: Rows, carry: np.ndarray):
        diff, have = _changes(rows)
        return [(diff[rows.skip:], ~have[rows.skip:])], []


@dataclass(frozen=True)
class GainLoss(Indicator):
    """Positive and negative part of the price change, both as positive numbers; 0 where there is no change."""

    columns = ("gain", "loss")
    history = 1

    def run(self, rows: Rows, carry: np.ndarray):
        gain, loss = _gain_loss(rows)
        full = np.zeros(len(gain) - rows.skip, dtype=bool)
        return [(gain[rows.skip:], full), (loss[rows.skip:], full)], []


GOLD = (Sma(200), Ema(50), Rsi(14), Macd(12, 26, 9))


def with_indicators(
    df: DataFrame,
    *indicators,
    time_col: str = "datetime",
    value_col: str = "close",
    keys: Sequence[str] = ("symbol",),
    tie: str | Sequence[str] | None = None,
) -> DataFrame:
    """Append all given indicators in one pass. An indicator with a column that exists already (in any case) is left out.

    Runs jobs when called (``ordered_scan``); streaming frames raise ``ValueError``.
    """
    wanted, present = [], {name.lower() for name in df.columns}
    for indicator in indicators:
        taken = [name for name in indicator.columns if name.lower() in present]
        if taken:
            level = logging.INFO if len(taken) == len(indicator.columns) else logging.WARNING
            log.log(level, "skipping %s with columns %s: %s there already", type(indicator).__name__, ", ".join(indicator.columns),
                    ", ".join(taken))
            continue
        present.update(name.lower() for name in indicator.columns)
        wanted.append(indicator)
    if not wanted:
        return df
    return ordered_scan(df, wanted, time_col=time_col, value_col=value_col, keys=tuple(keys), tie=tie)


def resume_indicators(
    df: DataFrame,
    state: DataFrame | None,
    *indicators,
    time_col: str = "datetime",
    value_col: str = "close",
    keys: Sequence[str] = ("symbol",),
    tie: str | Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The indicators for the later rows ``df`` of series whose earlier rows are in ``state``, and the state after them.

    ``state`` is what the last call gave for the same indicators (None: nothing came before) and has one row for each series: what
    it costs does not depend on how long the series are. Columns of ``df`` must not bear the indicators' names.
    """
    taken = {name.lower() for name in df.columns} & {name.lower() for ind in indicators for name in ind.columns}
    if taken or not indicators:
        raise ValueError(f"columns there already: {', '.join(sorted(taken))}" if taken else "no indicators")
    return resumed_scan(df, indicators, state, time_col=time_col, value_col=value_col, keys=tuple(keys), tie=tie)


def sma(df: DataFrame, n: int = 200, min_periods: int = 1, **series) -> DataFrame:
    """``min_periods``, here and below: rows of the series from which on there is a value."""
    return with_indicators(df, Sma(n, min_periods), **series)


def ema(df: DataFrame, n: int = 50, min_periods: int = 1, **series) -> DataFrame:
    return with_indicators(df, Ema(n, min_periods), **series)


def rsi(df: DataFrame, n: int = 14, min_periods: int = 1, **series) -> DataFrame:
    return with_indicators(df, Rsi(n, min_periods), **series)


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, **series) -> DataFrame:
    return with_indicators(df, Macd(fast, slow, signal), **series)


def price_change(df: DataFrame, **series) -> DataFrame:
    return with_indicators(df, PriceChange(), **series)


def gain_loss(df: DataFrame, **series) -> DataFrame:
    return with_indicators(df, GainLoss(), **series)
