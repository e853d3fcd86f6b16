"""The ordered operators over a stream: what a recording's state machine remembers between batches.

Rows of a recording must come in order within and between batches. Each function keeps a few
numbers for a recording and emits rows as soon as they are certain.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _stateful(rows: DataFrame, keys: list[str], step: Any, out: str, state: str) -> DataFrame:
    return rows.groupBy(*keys).applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)


def _in_order(parts: Iterator[pd.DataFrame], by: str) -> pd.DataFrame:
    return pd.concat(list(parts)).sort_values(by, kind="stable")


def spaced(rows: DataFrame, key: str, place: str, gap: int) -> DataFrame:
    """(key, place) of rows picked at least ``gap`` apart, the first one always."""

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, picked = (state.get[0] if state.exists else None), []
        for at in _in_order(parts, place)[place]:
            if last is None or at >= last + gap:
                last = int(at)
                picked.append(last)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({key: [k[0]] * len(picked), place: picked})

    kind = dict(rows.dtypes)[key]
    return _stateful(rows.select(key, F.col(place).cast("bigint").alias(place)), [key], step, f"{key} {kind}, {place} bigint", "last bigint")


def debounced(rows: DataFrame, key: str, place: str, status: str, interval: int) -> DataFrame:
    """(key, place, status) of statuses held for more than ``interval`` rows before them."""

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, held, switched = state.get if state.exists else (False, 0, False)
        kept = []
        for at, s in _in_order(parts, place)[[place, status]].itertuples(index=False):
            if bool(s) != now:
                now, held, switched = bool(s), 0, True
            held += 1
            if held >= (max(interval + 1, 2) if switched else interval + 1):
                kept.append((k[0], int(at), now))
        state.update((now, held, switched))
        yield pd.DataFrame(kept, columns=[key, place, status])

    kind = dict(rows.dtypes)[key]
    return _stateful(rows.select(key, F.col(place).cast("bigint").alias(place), status), [key], step, f"{key} {kind}, {place} bigint, {status} boolean", "now boolean, held int, switched boolean")


def closed_islands(rows: DataFrame, key: str, place: str, active: str) -> DataFrame:
    """(key, start, end, n) of runs of active rows, each when the next inactive row ends it."""

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, end, n = state.get if state.exists else (0, 0, 0)
        done = []
        for at, on in _in_order(parts, place)[[place, active]].itertuples(index=False):
            if on:
                start, end, n = (int(at) if not n else start), int(at), n + 1
            elif n:
                done.append((k[0], start, end, n))
                n = 0
        if n:
            state.update((start, end, n))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(done, columns=[key, "start", "end", "n"])

    kind = dict(rows.dtypes)[key]
    return _stateful(rows.select(key, F.col(place).cast("bigint").alias(place), active), [key], step, f"{key} {kind}, start bigint, end bigint, n bigint", "start bigint, end bigint, n bigint")


def windowed_counts(rows: DataFrame, ts: str, by: str, late: str = "10 minutes", size: str = "5 minutes") -> DataFrame:
    """Rows by window and key; rows later than ``late`` are passed over."""
    return rows.withWatermark(ts, late).groupBy(F.window(ts, size), by).agg(F.count("*").alias("n"))
