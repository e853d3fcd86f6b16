"""Operators over rows in order within a recording: rates, islands, debounce, segments, spacing.

All take the recording's key columns and an order that must be total. Operators in a row share
one exchange by the keys: Spark keeps the partitioning from window to window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftrail.functions.session import free_name, importable

Keys = list[str]
ROWS_IN_TASK = 100_000


def _window(keys: Keys, order: Keys):  # noqa: ANN202
    return Window.partitionBy(*keys).orderBy(*order)


def _so_far(keys: Keys, order: Keys):  # noqa: ANN202
    return _window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def dealt(df: DataFrame, keys: Keys, *others: DataFrame) -> DataFrame:
    """Rows dealt by the keys to as many tasks as the rows, with those of ``others``, ask for.

    Left to itself, Spark joins blocks by their packed bytes and never makes more than it is set to, so that what the sorts of
    a task hold grows with the input. Rows are counted, which for a table is read from its footers.
    """
    rows = sum(d.count() for d in (df, *others))
    return df.repartition(rows // ROWS_IN_TASK + 1, *keys)


def first_offset(df: DataFrame, keys: Keys, order: Keys, ts: str, out: str = "offset_us") -> DataFrame:
    """Microseconds since the first row of the recording whose time is known."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    start = F.first(micros, ignorenulls=True).over(_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(out, micros - start)


def at_least(df: DataFrame, keys: Keys, n: int = 2) -> DataFrame:
    """Only recordings with ``n`` rows or more."""
    size = free_name(df, "size")
    return df.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(F.col(size) >= n).drop(size)


def moving_rate(df: DataFrame, keys: Keys, order: Keys, micros: str, distance: Callable[[Callable[[str], Column]], Column], size: int = 5, out: str = "speed_kmh") -> DataFrame:
    """Distance over time of the steps within ``size // 2`` rows of each row, in km/h.

    ``distance`` gets a function from a column's name to its value in the next row and gives the
    metres of the step. Steps that take no time or negative time are ignored; with no time left,
    or with a window of one row or none, the rate is 0. Even sizes act like the next odd one.
    """
    half = size // 2
    if half == 0:
        return df.withColumn(out, F.lit(0.0))
    step = _window(keys, order)
    asked = [micros]
    distance(lambda name: asked.append(name) or F.col(name))
    ahead = {name: free_name(df, f"next_{i}") for i, name in enumerate(dict.fromkeys(asked))}  # each is looked up once, however often the distance has it
    span = F.col(ahead[micros]) - F.col(micros)
    length = distance(lambda name: F.col(ahead[name]))  # null is added to what must not count: below a condition Spark computes shared parts each time
    us, metres = free_name(df, "step_us"), free_name(df, "step_m")
    followed = df.withColumns({ahead[name]: F.lead(name).over(step) for name in ahead})
    stepped = followed.withColumn(us, F.when(span > 0, span)).withColumn(metres, length + F.when(F.col(us).isNotNull(), 0.0)).drop(*ahead.values())
    frame = step.rowsBetween(-half, half - 1)
    rate = F.try_divide(F.sum(metres).over(frame), F.sum(us).over(frame) / 1e6) * 3.6
    return stepped.withColumn(out, F.coalesce(rate, F.lit(0.0))).drop(us, metres)


def islands(df: DataFrame, keys: Keys, order: Keys, active: Column, offset: str, *aggregates: Column) -> DataFrame:
    """One row for each maximal run of rows that are all active: its first and last offset and ``n``."""
    on, island = free_name(df, "on"), free_name(df, "island")
    marked = df.withColumn(on, F.coalesce(active, F.lit(False)))
    runs = marked.withColumn(island, F.sum(F.when(F.col(on), 0).otherwise(1)).over(_so_far(keys, order)))
    place = F.struct(*order)
    found = runs.where(F.col(on)).groupBy(*keys, island).agg(F.min_by(offset, place).alias("start_us"), F.max_by(offset, place).alias("end_us"), F.count("*").alias("n"), *aggregates)
    return found.drop(island)


def long_enough(segments: DataFrame, least_us: int, extent: Column | None = None, least_m: float = 0.0) -> DataFrame:
    """Segments that last ``least_us`` and, if asked, reach over ``least_m``; bounds count."""
    kept = segments.where(F.col("end_us") - F.col("start_us") >= least_us)
    return kept if extent is None else kept.where(extent >= least_m)


def debounce(df: DataFrame, keys: Keys, order: Keys, status: str, interval: int) -> DataFrame:
    """Rows whose status has held for more than ``interval`` rows before them.

    A recording begins with the status false. Of a run that began with a change, the row of the
    change itself is never kept, even with an interval of 0.
    """
    own = F.col(status)
    step = _window(keys, order)
    before = F.coalesce(F.lag(own).over(step), F.lit(False))
    first = F.lag(F.lit(1)).over(step).isNull()
    switch, new, run, k, switched = (free_name(df, x) for x in ("switch", "new", "run", "k", "switched"))
    marked = df.withColumn(switch, own != before).withColumn(new, (own != before) | first)
    marked = marked.withColumn(run, F.sum(F.col(new).cast("int")).over(_so_far(keys, order)))
    within = Window.partitionBy(*keys, run).orderBy(*order)
    marked = marked.withColumn(k, F.row_number().over(within)).withColumn(switched, F.max(switch).over(Window.partitionBy(*keys, run)))
    least = F.when(F.col(switched), F.lit(max(interval + 1, 2))).otherwise(F.lit(interval + 1))
    return marked.where(F.col(k) >= least).drop(switch, new, run, k, switched)


def status_segments(df: DataFrame, keys: Keys, order: Keys, status: str, offset: str, least_us: int) -> DataFrame:
    """Segments from each change to true until the next false status, or the last status of all."""
    step = _window(keys, order)
    whole = Window.partitionBy(*keys)
    last = F.max_by(offset, F.struct(*order)).over(whole)
    marked = df.select(*keys, *[c for c in order if c not in keys], F.col(status).alias("__s"), F.col(offset).alias("__o"), last.alias("__last"), F.lag(status).over(step).alias("__before"))
    turns = marked.where(F.col("__before").isNull() | (F.col("__before") != F.col("__s")))
    ends = turns.withColumn("__end", F.coalesce(F.lead("__o").over(step), F.col("__last")))
    found = ends.where("__s").select(*keys, F.col("__o").alias("start_us"), F.col("__end").alias("end_us"))
    return found.where(F.col("end_us") - F.col("start_us") >= least_us)


def number(segments: DataFrame, keys: Keys, out: str = "seg_idx") -> DataFrame:
    """Segments numbered from 0 by their start within the recording."""
    return segments.withColumn(out, F.row_number().over(_window(keys, ["start_us", "end_us"])) - 1)


def greedy_spacing(df: DataFrame, keys: Keys, place: str, gap: int) -> DataFrame:
    """Rows picked one after another, each at least ``gap`` behind the last one picked.

    The first row of a recording is always picked. The rule looks back at its own choices, so no
    window function expresses it. Rows come sorted and are streamed: what a task remembers is the
    last place picked, however long a recording is. Of rows at one place the first is picked.
    """
    importable(df.sparkSession)
    frame = df.repartition(*keys).sortWithinPartitions(*keys, place)
    names = frame.columns
    key_at, place_at = [names.index(k) for k in keys], names.index(place)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(place_at).to_numpy(zero_copy_only=False)
            new = np.zeros(len(at), bool)
            for k in key_at:
                codes = batch.column(k).dictionary_encode()
                codes = (codes.indices.fill_null(-1)).to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), len(at)]
            picked = []
            for a, b in zip(starts, starts[1:], strict=False):
                if a == b:
                    continue
                key = tuple(batch.column(k)[a].as_py() for k in key_at)
                i = a
                if key == now:
                    i = a + int(np.searchsorted(at[a:b], last + gap))
                while i < b:
                    picked.append(i)
                    last = at[i]
                    i = max(i + 1, a + int(np.searchsorted(at[a:b], last + gap)))
                now = key
            yield batch.take(pa.array(picked, pa.int64()))

    return frame.mapInArrow(run, frame.schema)
