"""Named queries over ``events`` replayed as a stream, some hours out of order; they equal the batch rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.functions.session import shared_folder
from siftrail.plans.catalog import _query, _table
from siftrail.streaming import timed

SILENCE_US = 2 * 86_400_000_000
PARTS = 3
ROWS_IN_FILE = 250_000


def _blanks(events: DataFrame, files: int, at: int) -> DataFrame:
    """Rows of no user, as many as files, each in a task and so in a file of its own."""
    values = {"event_id": F.lit(-1), "user_id": F.lit(-1), "event_type": F.lit("none"), "value": F.lit(0.0), "active": F.lit(False), "ts": F.timestamp_micros(F.lit(at))}
    return events.sparkSession.range(0, files, 1, files).select(*[values[c].cast(t).alias(c) for c, t in events.dtypes])


def _replayed(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream over the events gives: a micro-batch for each third of the time, every event up to six hours off its place.

    A batch takes a number of files, so all parts are written as that many; blank rows make up for files that a small part
    lacks. Last rows, years later, move the watermark behind all others.
    """
    e = _table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withColumn("active", F.col("event_type").isin("click", "view") & (F.col("value") / 100 >= 0.1))
    span = e.agg(F.unix_micros(F.min("ts")).alias("a"), F.unix_micros(F.max("ts")).alias("z"), F.count("*").alias("n")).first()
    folder, out, state = (shared_folder(spark, label) for label in ("events", "found", "state"))
    begun, end = span["a"] or 0, span["z"] or 0
    length = max(1, (end - begun) // PARTS + 1)
    files = span["n"] // PARTS // ROWS_IN_FILE + 1
    place, off = F.unix_micros("ts") - begun, F.pmod(F.xxhash64("event_id"), F.lit(6 * 3_600_000_000))
    part = F.least(F.floor((place + off) / length), F.floor(place / length) + 1, F.lit(PARTS))
    dealt = e.withColumn("part", part.cast("int"))
    for k in range(PARTS + 1):
        rows = dealt.where(F.col("part") == k).drop("part")
        (rows.repartition(files) if files > 1 else rows.coalesce(1)).write.mode("append").parquet(folder)
        if lacking := files * (k + 1) - len(spark.read.schema(e.schema).parquet(folder).inputFiles()):
            _blanks(e, lacking, begun).write.mode("append").parquet(folder)
    _blanks(e, files, end + 1_000 * 86_400_000_000).write.mode("append").parquet(folder)
    with timed.stateful(spark):
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", files).parquet(folder)
        run = make(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state).start()
        try:
            run.processAllAvailable()
        finally:
            run.stop()
    return spark.read.schema(make(stream).schema).parquet(out).where("NOT user_id <=> -1")


_SESSIONS = f"""
    g AS (SELECT user_id, event_id, epoch_us(ts) AS t, event_type IN ('click', 'view') AND value / 100 >= 0.1 AS active,
                 epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > {SILENCE_US} AS gap FROM events),
    s AS (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS rec FROM g)"""


@_query(f"""
    WITH {_SESSIONS}, i AS (SELECT *, sum(CASE WHEN active THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, rec ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM s)
    SELECT user_id, min(t) AS start_us, max(t) AS end_us, count(*) AS n FROM i WHERE active GROUP BY user_id, rec, run
""")
def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of active events of a stream, closed by an inactive event or by two days of silence."""
    return _replayed(spark, sf_dir, lambda s: timed.runs(s, "user_id", "ts", "event_id", "active", "12 hours", SILENCE_US))


@_query(f"""
    WITH {_SESSIONS}, c AS (SELECT *, coalesce(lag(active) OVER (PARTITION BY user_id, rec ORDER BY t, event_id), false) AS before, row_number() OVER (PARTITION BY user_id, rec ORDER BY t, event_id) AS rn FROM s),
    r AS (SELECT *, sum(CASE WHEN active <> before OR rn = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, rec ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id, rec, run ORDER BY t, event_id) AS k FROM r)
    SELECT user_id, t AS at_us, active AS status FROM k WHERE k >= 2
""")
def stream_debounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of a stream that have held for more than one event."""
    return _replayed(spark, sf_dir, lambda s: timed.debounced(s, "user_id", "ts", "event_id", "active", 1, "12 hours", SILENCE_US))


@_query(f"""
    WITH RECURSIVE {_SESSIONS},
    p AS (SELECT user_id, rec, min(t) AS m FROM s GROUP BY 1, 2
          UNION ALL SELECT p.user_id, p.rec, (SELECT min(x.t) FROM s x WHERE x.user_id = p.user_id AND x.rec = p.rec AND x.t >= p.m + 86400000000) FROM p WHERE p.m IS NOT NULL)
    SELECT user_id, m AS at_us FROM p WHERE m IS NOT NULL
""")
def stream_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a stream at least a day apart."""
    return _replayed(spark, sf_dir, lambda s: timed.spaced(s, "user_id", "ts", "event_id", 86_400_000_000, "12 hours", SILENCE_US))
