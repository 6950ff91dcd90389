"""Ordered scan: values that depend on all earlier rows of a series, computed in parallel within one series.

A window partitioned by symbol puts a whole symbol into one task, and a running fold is quadratic. Here the rows are
range-partitioned and sorted by (keys, time, tie), so a hot symbol spreads over many partitions, and a series crosses a
partition border at most once per border:

1. range shuffle and sort, frozen with ``checkpoint()`` so that both passes see the same borders;
2. one summary row per partition: what its last series carries over the border, as a function of what comes in;
3. the summaries are chained, giving every partition the state it starts from (one small record per partition);
4. one streaming pass over each partition computes the columns from that state.

The carried moving averages are affine in the incoming state, so step 2 runs the ordinary calculation on affine forms
(coefficients for 1 and for each incoming value) instead of numbers.

A call on the result of another call for the same series starts from the rows sorted there.

The last values that a partition's frames need go through the driver with the summaries while all of them fit into ``STATE_BYTES``. For
longer frames they are exchanged as rows (``_with_halo``): the driver gets counts only, every row that stands within a frame's length
before the begin of a partition is copied there, and pass two meets these copies first. The number of partitions does not depend on
the frames; what is copied is, for each partition, as many rows as the longest frame has.

A scan can hand on its states and a later one go on from them (``resumed_scan``). The last values of a series are then sorted in front of
its new rows as rows of their own, and the last of these gives the running averages, which is one more affine map: a constant.

Both passes are iterator Arrow UDFs: only the keys and the value travel to Python, the other columns stay in the JVM.
They are marked nondeterministic because a row's result depends on the rows before it: no filter may move below them.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import shared_dir

# Upper bound for the carried states of all partitions together, which are chained on the driver and broadcast.
STATE_BYTES = 128 * 1024 * 1024
# Column metadata that marks what a scan appended.
APPENDED = {"candlewick.appended": True}
BATCH_ROWS = 16_384

_PART = "__scan_part"
_VALUE = "__scan_value"
_TIE = "__scan_tie"
_ORIGIN = "__scan_origin"
_ROW = "__scan_row"
_PLACE = "__scan_place"
_GIVEN = "__scan_given"
STATE = "__scan_state"


def affine_scan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix composition of the maps ``e -> a[i] * e + b[i]``; ``b`` has one column per coefficient."""
    a, b = a.copy(), b.copy()
    step = 1
    while step < len(a) and a[step:].any():
        later = a[step:]
        update = later[:, None] * b[:-step]
        update[later == 0] = 0.0
        b[step:] += update
        a[step:] = later * a[:-step]
        step *= 2
    return a, b


def rolling_sum(values: np.ndarray, position: np.ndarray, n: int) -> np.ndarray:
    """Sum over the last ``n`` rows of the same series; ``position`` counts rows from the start of the series.

    Frames are put together from frames of width 1, 2, 4, ..., with additions only: a frame of zeros sums to exactly
    zero, and a large value leaves no rounding residue behind.
    """
    n = min(n, len(values))
    total = np.zeros(len(values))
    part = values.astype("float64")
    done, width = 0, 1
    while n:
        if n & width:
            total[done:] += np.where(position[done:] >= done, part[:len(part) - done], 0.0)
            done += width
        if 2 * width > n:
            break
        part[width:] += np.where(position[width:] >= width, part[:-width], 0.0)
        width *= 2
    return total


def ema_scan(x: np.ndarray, known: np.ndarray, seed: np.ndarray, alpha: float, carry: np.ndarray,
             given: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """E += alpha * (x - E) at known rows, E = x at seed rows, E unchanged elsewhere, starting from ``carry``.

    ``carry`` has one number per coefficient; columns that ``x`` lacks are zero. ``given``: rows, and what E is there whatever came before.
    """
    a = np.where(known, 1.0 - alpha, 1.0)
    a[seed] = 0.0
    b = np.where(known[:, None], alpha * x, 0.0)
    b[seed] = x[seed]
    if given is not None:
        at, values = given
        a[at] = b[at] = 0.0
        b[at, 0] = values
    a, b = affine_scan(a, b)
    averages = np.where(a[:, None] == 0, 0.0, a[:, None] * carry)
    averages[:, :b.shape[1]] += b
    return averages


@dataclass
class Rows:
    """A stretch of sorted rows as the indicators see it: ``skip`` rows of history, then the new rows."""

    x: np.ndarray            # value, 0.0 where null
    known: np.ndarray        # value is not null
    position: np.ndarray     # row number within the series, counted from the first row at hand
    skip: int
    seeded: np.ndarray       # new rows only: the series has had a value
    seed: np.ndarray         # new rows only: the series gets its first value here
    new_x: np.ndarray        # new rows only: the value as a column
    given: tuple[np.ndarray, np.ndarray] | None = None  # new rows that bring averages to go on from, and those of the indicator at hand

    def given_average(self, k: int) -> tuple[np.ndarray, np.ndarray] | None:
        return None if self.given is None else (self.given[0], self.given[1][:, k])


@dataclass
class State:
    """What a series hands on: its last values and its running averages (None before the first value)."""

    x: np.ndarray = field(default_factory=lambda: np.empty(0))
    known: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=bool))
    averages: np.ndarray | None = None


class Indicator:
    """Columns computed along a series. ``history``: earlier rows needed; ``averages``: running averages carried."""

    columns: Sequence[str] = ()
    history = 0
    averages = 0

    def seed_averages(self, value: float) -> list[float]:
        """The running averages just before the first value of a series."""
        return []

    def run(self, rows: Rows, carry: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray]]:
        """(values, is_null) per column and the running averages, both for the new rows."""
        raise NotImplementedError


class _Series:
    """Feeds sorted batches through the indicators and keeps the state of the series at hand."""

    def __init__(self, indicators: Sequence[Indicator], width: int, history: int, state: State | None = None,
                 continues: bool = False):
        self.indicators = indicators
        self.history = history
        self.averages = sum(ind.averages for ind in indicators)
        self.width = width
        self.continues = continues
        self.key: tuple | None = None
        self.state = state or State()

    def feed(self, x: np.ndarray, known: np.ndarray, keys: list[pa.Array],
             given: tuple[np.ndarray, np.ndarray] | None = None):
        """Columns for one batch: a list of (values, is_null) per output column. ``given``: rows that bring averages, and these."""
        first_key = tuple(column[0].as_py() for column in keys)
        starts = _changes(keys, len(x))
        starts[0] = not self.continues if self.key is None else first_key != self.key
        self.continues = True
        if starts[0]:
            self.state = State()
        self.key = tuple(column[len(x) - 1].as_py() for column in keys)

        run = np.maximum.accumulate(np.where(starts, np.arange(len(x)), 0))
        skip = len(self.state.x)
        position = np.arange(len(x)) - run
        position[:_run_end(starts)] += skip
        carried = self.state.averages is not None
        valued = known.copy()
        if given is not None:
            valued[given[0]] = True
        counted = np.cumsum(valued)
        before = np.where(run > 0, counted[run - 1], 0)
        in_run = counted - before
        in_run[:_run_end(starts)] += carried
        rows = Rows(
            x=np.concatenate([self.state.x, x]),
            known=np.concatenate([self.state.known, known]),
            position=np.concatenate([np.arange(skip), position]),
            skip=skip,
            seeded=in_run > 0,
            seed=known & (in_run == 1),
            new_x=x[:, None],
        )
        carry = self.state.averages if carried else np.zeros((self.averages, self.width))
        outputs, averages, offset = [], [], 0
        for indicator in self.indicators:
            rows.given = given and (given[0], given[1][:, offset:offset + indicator.averages])
            columns, running = indicator.run(rows, carry[offset:offset + indicator.averages])
            outputs.extend(columns)
            averages.extend(running)
            offset += indicator.averages
        self.rows, self.running, self.starts = rows, averages, starts
        keep = min(self.history, int(rows.position[-1]) + 1)
        self.state = State(
            x=rows.x[len(rows.x) - keep:],
            known=rows.known[len(rows.known) - keep:],
            averages=np.array([a[-1] for a in averages]).reshape(self.averages, self.width) if rows.seeded[-1] else None,
        )
        return outputs

    def ends(self) -> list[tuple[int, list, list | None]]:
        """Of the batch just fed, for the last row of each of its series: row, last values, averages (None before the first value)."""
        rows, begins = self.rows, np.flatnonzero(self.starts)
        runs = begins if self.starts[0] else np.concatenate([[0], begins])
        out = []
        for begin, end in zip(runs.tolist(), [*runs[1:].tolist(), len(self.starts)]):
            low = 0 if begin == 0 and not self.starts[0] else rows.skip + begin
            frame = slice(max(low, rows.skip + end - self.history), rows.skip + end)
            out.append((end - 1, [v if k else None for v, k in zip(rows.x[frame].tolist(), rows.known[frame])],
                        [float(a[end - 1, 0]) for a in self.running] if rows.seeded[end - 1] else None))
        return out


def _run_end(starts: np.ndarray) -> int:
    """Number of rows that belong to the run of the first row, 0 when that run is new."""
    if starts[0]:
        return 0
    later = np.flatnonzero(starts)
    return int(later[0]) if len(later) else len(starts)


def _changes(keys: list[pa.Array], rows: int) -> np.ndarray:
    """True where any key differs from the row before (null equals null)."""
    changed = np.zeros(rows, dtype=bool)
    for column in keys:
        one, two = column.slice(0, rows - 1), column.slice(1)
        differs = pc.coalesce(pc.not_equal(one, two), pc.xor(pc.is_null(one), pc.is_null(two)))
        changed[1:] |= differs.to_numpy(zero_copy_only=False).astype(bool)
    return changed


def _regroup(batches: Iterator[tuple[pa.Array, ...]], rows: int) -> Iterator[list[pa.Array]]:
    """Join small batches, so that the history put in front of each is small against it."""
    held, count = [], 0
    for batch in batches:
        if len(batch[0]) == 0:
            continue
        held.append(batch)
        count += len(batch[0])
        if count >= rows:
            yield [pa.concat_arrays(parts) for parts in zip(*held)]
            held, count = [], 0
    if held:
        yield [pa.concat_arrays(parts) for parts in zip(*held)]


def _value_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return np.where(known, column.to_numpy(zero_copy_only=False), 0.0), known


SUMMARY = T.StructType([
    T.StructField("is_first", T.BooleanType()),
    T.StructField("is_last", T.BooleanType()),
    T.StructField("one_series", T.BooleanType()),
    T.StructField("seed", T.DoubleType()),
    T.StructField("tail", T.ArrayType(T.DoubleType())),
    T.StructField("averages", T.ArrayType(T.DoubleType())),
    T.StructField("rows", T.LongType()),
    T.StructField("run", T.LongType()),
])
_ARROW_SUMMARY = pa.struct([
    ("is_first", pa.bool_()), ("is_last", pa.bool_()), ("one_series", pa.bool_()), ("seed", pa.float64()),
    ("tail", pa.list_(pa.float64())), ("averages", pa.list_(pa.float64())), ("rows", pa.int64()), ("run", pa.int64()),
])


def _given(columns: list[pa.Array], averages: int) -> tuple[tuple[np.ndarray, np.ndarray] | None, list[pa.Array]]:
    """The rows where the first of ``columns``, lists of averages, is not null, and these averages; and the other columns."""
    lists, *keys = columns
    at = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    if not len(at):
        return None, keys
    return (at, np.array(lists.take(pa.array(at)).to_pylist(), dtype="float64").reshape(len(at), averages)), keys


def _summaries(indicators: Sequence[Indicator], resumed: bool = False, tails: bool = True):
    """Pass one, over (value, part, keys...): null but for the first row (a mark) and the last row (the summary).

    ``resumed``, here and in pass two: in front of the keys is a column of averages to go on from. Without ``tails`` the last
    values are left out. ``rows`` counts the partition's rows, ``run`` those of its last series."""
    carrying = [ind for ind in indicators if ind.averages]
    averages = sum(ind.averages for ind in carrying)
    history = max(ind.history for ind in indicators) if tails else 0
    batch_rows = max(BATCH_ROWS, history)

    def summarize(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        # The first series may go on from an earlier partition: its averages start as the unknowns themselves.
        unknown = State(averages=np.eye(averages, averages + 1, k=1))
        series = _Series(carrying, averages + 1, history, unknown, continues=True)
        one_series, seed, waiting, first, rows, run = True, None, 0, True, 0, 0
        for value, _, *keys in _regroup(batches, batch_rows):
            given, keys = _given(keys, averages) if resumed else (None, keys)
            x, known = _value_arrays(value)
            if waiting:
                yield from _padded({"is_first": True} if first else None, waiting, None)
                first = False
            changes = np.flatnonzero(_changes(keys, len(x)))
            crossed = series.key is not None and series.key != tuple(column[0].as_py() for column in keys)
            head_rows = 0 if crossed else int(changes[0]) if len(changes) else len(x)
            if one_series and seed is None:
                values = x[:head_rows][known[:head_rows]]
                seed = float(values[0]) if len(values) else None
                if seed is None and given is not None and (given[0] < head_rows).any():
                    seed = 0.0  # of no effect, as the averages are given later on
            one_series = one_series and not crossed and not len(changes)
            rows += len(x)
            run = len(x) - int(changes[-1]) if len(changes) else len(x) if crossed else run + len(x)
            series.feed(x, known, keys, given)
            waiting = len(x)
        if not waiting:
            return
        state = series.state
        summary = {
            "is_last": True, "one_series": one_series, "seed": seed,
            "tail": [v if k else None for v, k in zip(state.x.tolist(), state.known)],
            "averages": None if state.averages is None else state.averages.reshape(-1).tolist(),
            "rows": rows, "run": run,
        }
        yield from _padded({"is_first": True} if first else None, waiting, summary)

    return summarize


def _padded(head: dict | None, rows: int, last: dict | None) -> Iterator[pa.Array]:
    """``rows`` summaries: ``head`` in the first row, ``last`` in the last, null between."""
    if rows == 1:
        both = {**(head or {}), **(last or {})}
        yield pa.array([both or None], _ARROW_SUMMARY)
        return
    yield pa.concat_arrays([pa.array([head], _ARROW_SUMMARY), pa.nulls(rows - 2, _ARROW_SUMMARY),
                            pa.array([last], _ARROW_SUMMARY)])


def _chain(summaries: list, indicators: Sequence[Indicator], key_count: int) -> dict[int, tuple]:
    """Partition -> state its first series starts from. Partitions that begin a new series are left out."""
    history = max(ind.history for ind in indicators)
    count = sum(ind.averages for ind in indicators)
    first_keys = {row["part"]: tuple(row)[:key_count] for row in summaries if row["is_first"]}
    starts: dict[int, tuple] = {}
    previous_key, previous = None, State()
    for row in sorted((row for row in summaries if row["is_last"]), key=lambda r: r["part"]):
        incoming = State()
        if previous_key is not None and previous_key == first_keys[row["part"]]:
            incoming = previous
            starts[row["part"]] = (previous.x, previous.known, previous.averages)
        tail_x = np.array([0.0 if v is None else v for v in row["tail"]], dtype="float64")
        tail_known = np.array([v is not None for v in row["tail"]], dtype=bool)
        base = incoming if row["one_series"] else State()
        x = np.concatenate([base.x, tail_x])
        known = np.concatenate([base.known, tail_known])
        keep = min(history, len(x))
        averages = None
        given = base.averages
        if given is None and row["one_series"] and row["seed"] is not None:
            given = np.array([v for ind in indicators for v in ind.seed_averages(row["seed"])]).reshape(count, 1)
        if row["averages"] is not None and (given is not None or not row["one_series"]):
            forms = np.array(row["averages"]).reshape(count, count + 1)
            unknowns = np.zeros((count, 1)) if given is None else given
            averages = forms[:, :1] + forms[:, 1:] @ unknowns
        previous_key = tuple(row)[:key_count]
        previous = State(x=x[len(x) - keep:], known=known[len(known) - keep:], averages=averages)
    return starts


_STATE = pa.struct([("tail", pa.list_(pa.float64())), ("averages", pa.list_(pa.float64()))])


def _outputs(indicators: Sequence[Indicator], starts: Broadcast, resumed: bool = False, states: bool = False):
    """Pass two, over (value, part, keys...): a struct of the indicators' columns for every row.

    ``states``: and the state of the series at the last row that it has in the partition, null at all other rows."""
    history = max(ind.history for ind in indicators)
    batch_rows = max(BATCH_ROWS, history)
    averages = sum(ind.averages for ind in indicators)
    names = [name for ind in indicators for name in ind.columns]

    def built(columns: list, ends: list | None) -> pa.Array:
        arrays = [pa.array(values, mask=is_null) for values, is_null in columns]
        if ends is None:
            return pa.StructArray.from_arrays(arrays, names)
        column = np.full(len(columns[0][0]), None, dtype=object)
        for row, tail, own in ends:
            column[row] = {"tail": tail, "averages": own}
        return pa.StructArray.from_arrays([*arrays, pa.array(column, _STATE)], [*names, STATE])

    def compute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        series, waiting = None, None
        for value, part, *keys in _regroup(batches, batch_rows):
            given, keys = _given(keys, averages) if resumed else (None, keys)
            if series is None:
                start = starts.value.get(part[0].as_py())
                series = _Series(indicators, 1, history, start and State(*start), continues=start is not None)
            columns = series.feed(*_value_arrays(value), keys, given)
            if not states:
                yield built(columns, None)
                continue
            # Whether a batch's last row ends its series shows in the first row of the next.
            if waiting:
                yield built(waiting[0], waiting[1] if series.starts[0] else waiting[1][:-1])
            waiting = columns, series.ends()
        if waiting:
            yield built(*waiting)

    return compute


def _halo_outputs(indicators: Sequence[Indicator], starts: Broadcast):
    """Pass two over (value, part, row, keys...), in order of part and row, where the rows before row 0 are copies from parts before."""
    history = max(ind.history for ind in indicators)
    batch_rows = max(BATCH_ROWS, history)
    names = [name for ind in indicators for name in ind.columns]

    def compute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        series, at, before = None, None, []
        for value, part, row, *keys in _regroup(batches, batch_rows):
            x, known = _value_arrays(value)
            parts, copied = part.to_numpy(), row.to_numpy() < 0
            edges = np.flatnonzero((parts[1:] != parts[:-1]) | (copied[1:] != copied[:-1])) + 1
            out = []
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(x)]):
                if parts[low] != at:
                    series, at, before = None, parts[low], []
                if copied[low]:
                    before.append((x[low:high], known[low:high]))
                    out.append(pa.StructArray.from_arrays([pa.nulls(high - low, pa.float64())] * len(names), names))
                    continue
                if series is None:
                    start = starts.value.get(int(at))
                    state = State(*(np.concatenate(c) for c in zip(*before)) if before else (), averages=start[2]) if start else None
                    series = _Series(indicators, 1, history, state, continues=start is not None)
                columns = series.feed(x[low:high], known[low:high], [key.slice(low, high - low) for key in keys])
                out.append(pa.StructArray.from_arrays([pa.array(values, mask=is_null) for values, is_null in columns], names))
            yield pa.concat_arrays(out)

    return compute


def _with_halo(rows: DataFrame, columns: list[Column], summaries: list, starts: dict[int, tuple], history: int,
               partitions: int) -> DataFrame:
    """``rows`` with, in front of each part that goes on with a series, copies of the ``history`` rows of the series before it, of
    which only ``columns`` are filled.

    Rows are numbered through all parts. A part's copies are the rows from some number on up to its own first row, and both grow with
    the part, so a row goes to the parts next to its own up to a last one, which is found by counting the begins at or below it.
    """
    counts = {row["part"]: row for row in sorted(summaries, key=lambda r: r["part"]) if row["is_last"]}
    order, first, series, begins = list(counts), {}, {}, []
    total = start_of_series = 0
    for i, part in enumerate(order):
        row, first[part] = counts[part], total
        begin = max(total - history, start_of_series) if part in starts else total
        begins.append(max(begin, begins[-1] if begins else 0))
        total += row["rows"]
        if not (row["one_series"] and part in starts):
            start_of_series = total - row["run"]
    table = []
    for i, part in enumerate(order):
        low, high = first[part], first[part] + counts[part]["rows"]
        k = bisect_right(begins, low)
        table.append((part, i, low, k - 1, begins[k:bisect_left(begins, high)]))
    spark = rows.sparkSession
    places = spark.createDataFrame(table, f"{_PART} int, __nth int, __low long, __base int, __inside array<long>")
    parts = spark.createDataFrame([(i, part, first[part]) for i, part in enumerate(order)], "__to int, __to_part int, __begin long")
    number = F.col("__low") + F.col(_ROW)
    last = F.col("__base") + F.size(F.filter("__inside", lambda b: b <= number))
    copies = rows.select(*columns, _PART, _ROW).join(F.broadcast(places), _PART).withColumn("__number", number).where(last > F.col("__nth")) \
        .withColumn("__to", F.explode(F.sequence(F.col("__nth") + 1, last))).join(F.broadcast(parts), "__to") \
        .select(
            *columns, F.col("__to_part").alias(_PART), (F.col("__number") - F.col("__begin")).alias(_ROW))
    return rows.unionByName(copies, allowMissingColumns=True).repartitionByRange(partitions, _PART).sortWithinPartitions(_PART, _ROW)


def _partition_limit(indicators: Sequence[Indicator]) -> int:
    history = max(ind.history for ind in indicators)
    averages = sum(ind.averages for ind in indicators)
    # Collected values are Python floats in lists, with copies in the JVM and in the broadcast.
    return max(1, STATE_BYTES // (1024 + 48 * history + 96 * averages * (averages + 1)))


def _joined(old: dict[int, tuple], new: dict[int, tuple]) -> dict[int, tuple]:
    """The states of two groups of indicators over the same partitions as those of one: the longer history, all averages."""
    out = {}
    for part, (x, known, averages) in new.items():
        old_x, old_known, old_averages = old[part]
        if len(old_x) >= len(x):
            x, known = old_x, old_known
        both = None if averages is None or old_averages is None else np.concatenate([old_averages, averages])
        out[part] = (x, known, both)
    return out


@dataclass(frozen=True)
class _Sorted:
    """Sorted rows behind a result, so that a chain of calls sorts only once."""

    rows: DataFrame
    columns: list[str]       # of the frame that was sorted
    most_partitions: int
    series: tuple            # the series' definition
    indicators: tuple[Indicator, ...]
    starts: dict[int, tuple]  # the state each partition starts from


_SORTED: WeakKeyDictionary[DataFrame, _Sorted] = WeakKeyDictionary()


def _names(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def _sort(df: DataFrame, most_partitions: int, keys: Sequence[str], time_col: str, ties: Sequence[str]) -> DataFrame:
    """The rows with the number of their partition, frozen in order; at most ``most_partitions`` of them."""
    marked = df
    if not ties:
        # Equal times: order by content, so that the result does not depend on arrival order. What earlier scans appended
        # does not count, or a second call would order such rows anew.
        hashed = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, T.AtomicType) and not f.metadata.get(next(iter(APPENDED)))]
        marked = df.withColumn(_TIE, F.xxhash64(*_names(hashed)))
        ties = [_TIE]
    # Rows equal in all of these may be very many: the task they come from lets the ranges cut between them. It is the
    # same when a lost task is repeated.
    marked = marked.withColumn(_ORIGIN, F.spark_partition_id())
    order = _names([*keys, time_col, *ties, _ORIGIN])
    if int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) > most_partitions:
        ranged = marked.repartitionByRange(most_partitions, *order)
    else:
        ranged = marked.repartitionByRange(*order)
    shared_dir(df.sparkSession)
    part = F.spark_partition_id().alias(_PART)
    # The number of the row within its partition.
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(_ROW)
    return ranged.sortWithinPartitions(*order).select(*_names(df.columns), part, row).checkpoint()


def ordered_scan(
    df: DataFrame,
    indicators: Sequence[Indicator],
    *,
    time_col: str,
    value_col: str,
    keys: Sequence[str],
    tie: str | Sequence[str] | None,
) -> DataFrame:
    """Append the indicators' columns (all double) to ``df``; row order of the result is not defined.

    Not lazy: the sort (whose range sampling evaluates the input once more) and pass one run here, pass two with the result.
    """
    spark = df.sparkSession
    if df.isStreaming:
        raise ValueError("indicators need all earlier rows and cannot run on a streaming frame; use foreachBatch on stored bars")
    added = list(indicators)
    ties = [tie] if isinstance(tie, str) else list(tie or [])
    series = (tuple(keys), time_col, value_col, tuple(ties))
    before = _SORTED.get(df)
    if before and before.series == series and before.most_partitions <= _partition_limit(
            [*before.indicators, *indicators]):
        indicators = [*before.indicators, *indicators]
        rows, kept, most_partitions = before.rows, before.columns, before.most_partitions
    else:
        kept = df.columns
        most_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = _sort(df, most_partitions, keys, time_col, ties)

    halo = most_partitions > _partition_limit(indicators)
    key_columns = _names(keys)
    inputs = [F.col(f"`{value_col}`").cast("double"), F.col(_PART), *key_columns]
    summarize = F.arrow_udf(_summaries(added, tails=False) if halo else _summaries(added), SUMMARY).asNondeterministic()
    summaries = (
        rows.select(*[column.alias(f"key{i}") for i, column in enumerate(key_columns)], F.col(_PART).alias("part"),
                    summarize(*inputs).alias("summary"))
        .filter("summary IS NOT NULL")
        .select(*[f"key{i}" for i in range(len(keys))], "part", "summary.*")
        .collect()  # two rows per partition, of a fixed size with a halo, else bounded by STATE_BYTES
    )
    states = _chain(summaries, added, len(keys))
    if len(added) < len(indicators):
        states = _joined(before.starts, states)
    starts = spark.sparkContext.broadcast(states)

    columns = [name for ind in indicators for name in ind.columns]
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in columns])
    if halo:
        around = _with_halo(rows, [*key_columns, F.col(f"`{value_col}`")], summaries, states, max(ind.history for ind in indicators), most_partitions)
        compute = F.arrow_udf(_halo_outputs(indicators, starts), schema).asNondeterministic()
        computed = around.withColumn(_VALUE, compute(*inputs[:2], F.col(_ROW), *key_columns)).filter(F.col(_ROW) >= 0)
    else:
        compute = F.arrow_udf(_outputs(indicators, starts), schema).asNondeterministic()
        computed = rows.withColumn(_VALUE, compute(*inputs))
    result = computed.select(*_names(kept), *[F.col(_VALUE)[name].alias(name, metadata=APPENDED) for name in columns])
    if not halo:
        _SORTED[result] = _Sorted(rows, kept, most_partitions, series, tuple(indicators), states)
    return result


def resumed_scan(
    df: DataFrame,
    indicators: Sequence[Indicator],
    state: DataFrame | None = None,
    *,
    time_col: str,
    value_col: str,
    keys: Sequence[str],
    tie: str | Sequence[str] | None,
) -> tuple[DataFrame, DataFrame]:
    """``ordered_scan`` over the later rows of series whose earlier rows went through scans of the same indicators before.

    ``state`` is what the scan of the earlier rows gave: one row for each series with the keys, the last values (as many as the
    longest frame needs) and the running averages. Series that it lacks begin here. Gives the rows with the indicators'
    columns, and the state after them for all series, those without new rows too. The caller sees to it that ``df``
    holds later rows only.
    """
    spark, indicators = df.sparkSession, list(indicators)
    ties = [tie] if isinstance(tie, str) else list(tie or [])
    if not ties:
        hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
        df_, ties = df.withColumn(_TIE, F.xxhash64(*_names(hashed))), [_TIE]
    else:
        df_ = df
    key_columns, averages = _names(keys), T.ArrayType(T.DoubleType())
    rows = df_.withColumns({_PLACE: F.lit(0), _GIVEN: F.lit(None).cast(averages)})
    if state is not None:
        size = F.size("tail")
        # A series without frames to fill still hands on its averages, with a row of no value.
        tail = F.when(size > 0, F.col("tail")).otherwise(F.array(F.lit(None).cast("double")))
        before = state.select(*key_columns, "averages", tail.alias("tail")).select(
            *key_columns, "averages", F.size("tail").alias("size"), F.posexplode("tail").alias("at", "value")).select(
            *key_columns, F.col("value").cast(df.schema[value_col].dataType).alias(value_col), (F.col("at") - F.col("size")).alias(_PLACE),
            F.when(F.col("at") == F.col("size") - 1, F.col("averages")).alias(_GIVEN))
        rows = rows.unionByName(before, allowMissingColumns=True)
    most = min(int(spark.conf.get("spark.sql.shuffle.partitions")), _partition_limit(indicators))
    # The place comes before the time: the rows of a state are in front of all others of their series.
    rows = _sort(rows, most, keys, _PLACE, [time_col, *ties])
    inputs = [F.col(f"`{value_col}`").cast("double"), F.col(_PART), F.col(_GIVEN), *key_columns]
    summarize = F.arrow_udf(_summaries(indicators, True), SUMMARY).asNondeterministic()
    summaries = (
        rows.select(*[column.alias(f"key{i}") for i, column in enumerate(key_columns)], F.col(_PART).alias("part"),
                    summarize(*inputs).alias("summary"))
        .filter("summary IS NOT NULL")
        .select(*[f"key{i}" for i in range(len(keys))], "part", "summary.*")
        .collect()  # two rows per partition, bounded by STATE_BYTES
    )
    starts = spark.sparkContext.broadcast(_chain(summaries, indicators, len(keys)))
    columns = [name for ind in indicators for name in ind.columns]
    handed = T.StructField(STATE, T.StructType([T.StructField("tail", averages), T.StructField("averages", averages)]))
    schema = T.StructType([*[T.StructField(name, T.DoubleType()) for name in columns], handed])
    compute = F.arrow_udf(_outputs(indicators, starts, True, True), schema).asNondeterministic()
    computed = rows.withColumn(_VALUE, compute(*inputs))
    result = computed.filter(F.col(_PLACE) == 0).select(*_names(df.columns), *[F.col(_VALUE)[name].alias(name) for name in columns])
    ends = computed.filter(F.col(_VALUE)[STATE].isNotNull()).select(*key_columns, _PART, F.col(_VALUE)[STATE].alias(STATE))
    after = ends.groupBy(*key_columns).agg(F.max_by(STATE, _PART).alias(STATE)).select(*key_columns, f"{STATE}.tail", f"{STATE}.averages")
    return result, after
