"""Ordered operators over streams whose rows come late and out of order, by event time.

Rows of a recording wait until the watermark has passed them; then they are seen in order of time, ties by a
number. Rows that come behind the watermark are passed over, which Spark counts. A recording is over after
``silence`` without a row: a timer then closes what is open, and nothing of it is remembered. A later row of the
same key begins another recording.

Keys are dealt to ``buckets``, each with one state and one timer: a call to the state costs the same for one key as for a
hundred, and calls for each key took nearly all the time. A visit reads and writes what its bucket remembers, so streams with
many more live keys than rows in a batch want more buckets; a stream keeps the number it began with.

Runs need Spark's RocksDB state store, which ``stateful`` asks the session for while the stream is started.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from siftrail.functions.session import importable

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS, NULLS = 1024, -1  # of keys; rows without a key have a bucket of their own


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Within it, streams that are started keep their state in RocksDB; afterwards the session is as it was."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class Runs:
    """Maximal runs of active rows: (start_us, end_us, n) when a run ends."""

    state, out = "start_us bigint, end_us bigint, n bigint", "start_us bigint, end_us bigint, n bigint"
    begin = (0, 0, 0)

    def step(self, state: tuple, at: int, value: bool) -> tuple[tuple, list[tuple]]:
        start, _, n = state
        if value:
            return ((start if n else at), at, n + 1), []
        return self.begin, self.end(state)

    def end(self, state: tuple) -> list[tuple]:
        return [tuple(state)] if state[2] else []


class Debounced:
    """(at_us, status) of statuses held for more than ``interval`` rows before them."""

    state, out = "now boolean, held bigint, switched boolean", "at_us bigint, status boolean"
    begin = (False, 0, False)

    def __init__(self, interval: int) -> None:
        self.interval = interval

    def step(self, state: tuple, at: int, value: bool) -> tuple[tuple, list[tuple]]:
        now, held, switched = state
        if bool(value) != now:
            now, held, switched = bool(value), 0, True
        held += 1
        kept = held >= (max(self.interval + 1, 2) if switched else self.interval + 1)
        return (now, held, switched), [(at, now)] if kept else []

    def end(self, state: tuple) -> list[tuple]:
        return []


class Spaced:
    """(at_us) of rows at least ``gap`` behind the last one picked; the first is always picked."""

    state, out = "last bigint", "at_us bigint"
    begin = (None,)

    def __init__(self, gap: int) -> None:
        self.gap = gap

    def step(self, state: tuple, at: int, value: bool) -> tuple[tuple, list[tuple]]:
        if state[0] is None or at >= state[0] + self.gap:
            return (at,), [(at,)]
        return state, []

    def end(self, state: tuple) -> list[tuple]:
        return []


def _packed(rows: pd.DataFrame) -> bytes:
    batch, sink = pa.RecordBatch.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes | None) -> list[pd.DataFrame]:
    return [pa.ipc.open_stream(bytes(data)).read_pandas()] if data else []


class InOrder(StatefulProcessor):
    """Feeds machines, one for each key of a bucket, the rows of their keys in order, once the watermark has passed them."""

    def __init__(self, machine: Any, key: str, silence_us: int) -> None:
        self.machine, self.silence = machine, silence_us
        self.open = ["who", "seen", *[c.split()[0] for c in machine.state.split(", ")]]
        self.columns = [key, *[c.split()[0] for c in machine.out.split(", ")]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "waiting binary, open binary, due bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [part[["who", "at", "tie", "value"]] for part in rows]
        if key[0] == NULLS:
            new = [part.assign(who=0) for part in new]
        yield self.advance(key[0], new, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self.advance(key[0], [], timerValues.getCurrentWatermarkInMs() * 1000)

    def advance(self, bucket: int, new: list[pd.DataFrame], watermark: int) -> pd.DataFrame:
        """See all rows up to the watermark, end what has been silent until then, and say when to look again."""
        waiting, known, due = self.kept.get() or (None, None, None)
        rows, known = [*_unpacked(waiting), *new], _unpacked(known)
        rows = pd.concat(rows, ignore_index=True) if rows else pd.DataFrame({"who": [], "at": []})
        is_ready = rows["at"].to_numpy() <= watermark
        ready, left = rows[is_ready], rows[~is_ready]
        codes, names = pd.factorize(pd.concat([*[k["who"] for k in known], ready["who"]], ignore_index=True) if known and len(ready) else known[0]["who"] if known else ready["who"], use_na_sentinel=False)
        live = {who: (seen, tuple(state)) for who, (_, seen, *state) in zip(codes.tolist(), known[0].itertuples(index=False), strict=False)} if known else {}
        found = []
        if len(ready):
            who, at = codes[len(codes) - len(ready) :], ready["at"].to_numpy()
            order = np.lexsort((ready["tie"].to_numpy(), at, who))
            for k, t, value in zip(who[order].tolist(), at[order].tolist(), ready["value"].to_numpy()[order].tolist(), strict=True):
                seen, state = live.get(k, (None, self.machine.begin))
                if seen is not None and t - seen > self.silence:
                    found += [(k, *f) for f in self.machine.end(state)]
                    state = self.machine.begin
                state, more = self.machine.step(state, t, value)
                found += [(k, *f) for f in more]
                live[k] = (t, state)
        for k in [k for k, (seen, _) in live.items() if watermark - seen > self.silence]:
            found += [(k, *f) for f in self.machine.end(live.pop(k)[1])]
        next_times = ([int(left["at"].min())] if len(left) else []) + ([min(seen for seen, _ in live.values()) + self.silence] if live else [])
        then = max(min(next_times), watermark) // 1000 + 1 if next_times else None
        if due != then:
            if due is not None:
                self.handle.deleteTimer(due)
            if then is not None:
                self.handle.registerTimer(then)
        if then is None:
            self.kept.clear()
        else:
            still = pd.DataFrame([(seen, *state) for seen, state in live.values()], columns=self.open[1:])
            still.insert(0, "who", names.take(list(live)))
            self.kept.update((_packed(left) if len(left) else None, _packed(still) if live else None, then))
        out = pd.DataFrame(found, columns=self.columns)
        out[self.columns[0]] = None if bucket == NULLS else names.take(out[self.columns[0]].to_numpy(np.int64))
        return out

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, machine: Any, key: str, ts: str, tie: str, value: str | None, late: str, silence_us: int, buckets: int = BUCKETS) -> DataFrame:
    """The machine's findings for each key, times in microseconds; rows come up to ``late`` behind the latest one."""
    importable(rows.sparkSession)
    kind = dict(rows.dtypes)[key]
    known = rows.where(F.col(ts).isNotNull()).withWatermark(ts, late)
    bucket = F.when(F.col(key).isNull(), NULLS).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    active = F.coalesce(F.col(value).cast("boolean"), F.lit(False)) if value else F.lit(True)
    shaped = known.select(bucket.alias("bucket"), F.col(key).alias("who"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("at"), F.col(tie).cast("bigint").alias("tie"), active.alias("value"))
    return shaped.groupBy("bucket").transformWithStateInPandas(InOrder(machine, key, silence_us), f"{key} {kind}, {machine.out}", "append", "EventTime")


def runs(rows: DataFrame, key: str, ts: str, tie: str, active: str, late: str, silence_us: int) -> DataFrame:
    """(key, start_us, end_us, n) of runs of active rows; a run also ends with its recording."""
    return in_order(rows, Runs(), key, ts, tie, active, late, silence_us)


def debounced(rows: DataFrame, key: str, ts: str, tie: str, status: str, interval: int, late: str, silence_us: int) -> DataFrame:
    """(key, at_us, status) of statuses held for more than ``interval`` rows before them."""
    return in_order(rows, Debounced(interval), key, ts, tie, status, late, silence_us)


def spaced(rows: DataFrame, key: str, ts: str, tie: str, gap_us: int, late: str, silence_us: int) -> DataFrame:
    """(key, at_us) of rows at least ``gap_us`` apart, the first of a recording always."""
    return in_order(rows, Spaced(gap_us), key, ts, tie, None, late, silence_us)
