"""Recordings on disk: videos and their position logs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftrail.functions import logs
from siftrail.functions.session import cut, importable
from siftrail.operators.ordered import first_offset

WHOLE = 16 << 20  # bytes of a file that is read whole
HELD = 4 << 20  # bytes of lines handed on at once
TASK, CALL = 16 << 20, 16 << 10  # bytes of a task, and bytes that opening a file counts for
PACKED = r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd|xz)$"
BOM = b"\xef\xbb\xbf"


def listing(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, length) of files; their content is never read. Spark passes over files of no length."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select("path", logs.file_name(F.col("path")).alias("name"), "length")


def videos(spark: SparkSession, folder: str, pattern: str = "*.mp4") -> DataFrame:
    """Video files in order of their path."""
    return listing(spark, folder, pattern).orderBy("path")


def recordings(files: DataFrame) -> DataFrame:
    """(prefix, video, log) of each video in a listing that has a position log of its prefix."""
    named = files.withColumn("prefix", logs.recording_prefix(F.col("name"))).where("prefix IS NOT NULL")
    log = files.select(F.col("path").alias("log"), F.regexp_extract("name", r"^(.*)_gps\.log$", 1).alias("prefix")).where("prefix <> ''")
    return named.select("prefix", F.col("path").alias("video")).join(log, "prefix")


def log_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line_no, line) of every line, numbered from 0 in the order of the file.

    Spark splits long logs at any byte range. Lines are numbered within their range as they are read; the
    lines of the ranges before it in the file, counted first, are added. Lines end in a line feed, with or without a
    carriage return before it; the last one may lack it.
    """
    importable(spark)
    meta = F.col("_metadata")
    text = spark.read.option("lineSep", "\n").text(paths)
    text = text.select(logs.plain_path(meta["file_path"]).alias("file"), meta["file_block_start"].alias("start"), F.regexp_replace("value", "\r$", "").alias("line"))
    ranges = text.groupBy("file", "start").count()
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = cut(ranges.select("file", "start", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")), "line-numbers")

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [batch.column(i).dictionary_encode().indices.to_numpy() for i in (0, 1)]
            turns = np.flatnonzero((codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])) + 1
            places = np.empty(batch.num_rows, np.int64)
            for a, b in zip([0, *turns], [*turns, batch.num_rows], strict=True):
                here = (batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
                n = n if here == now else 0
                places[a:b] = np.arange(n, n + b - a)
                now, n = here, n + int(b - a)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], names=["file", "start", "line", "place"])

    numbered = text.mapInArrow(number, "file string, start bigint, line string, place bigint")
    return numbered.join(before, ["file", "start"]).select("file", (F.col("place") + F.col("before")).cast("int").alias("line_no"), "line")


def _numbered(files: list[tuple[str, bytes]]) -> pa.RecordBatch:
    """(file, line_no, line) of whole files; as Spark does, a byte order mark is passed over and bytes are taken as they are."""
    each = [data.removeprefix(BOM).split(b"\n") for _, data in files]
    for lines in each:
        if not lines[-1]:
            lines.pop()
    sizes = [len(lines) for lines in each]
    places = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
    names = pa.array([path for path, _ in files], pa.string()).take(pa.array(np.repeat(np.arange(len(files)), sizes)))
    lines = pa.array([line for lines in each for line in lines], pa.binary()).view(pa.string())
    return pa.RecordBatch.from_arrays([names, pa.array(places), lines], names=["file", "line_no", "line"])


def listed_lines(files: DataFrame) -> DataFrame:
    """(file, line_no, line) as ``log_lines`` gives them, of the files in a table (path, length).

    Files are dealt to tasks by their bytes and by the calls they cost. A file of up to ``WHOLE`` bytes is read whole and once, so
    its lines are numbered as they come; longer and packed ones are read by Spark's ranges, and only their paths pass the driver.
    """
    spark = files.sparkSession
    importable(spark)
    packed = F.col("path").rlike(PACKED)
    ranged = (F.col("length") > WHOLE) | packed
    cost = files.where(~ranged & (F.col("length") > 0)).select("path", "length")
    total = cost.agg(F.sum(F.col("length") + F.lit(CALL)).alias("n")).first()["n"] or 0
    dealt = cost.repartition(total // TASK + 1, "path").select("path")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, store, base = None, None, ""
        for batch in batches:
            held, size = [], 0
            for path in batch.column(0).to_pylist():
                folder, _, name = path.rpartition("/")
                if folder != now:
                    now, (store, base) = folder, fs.FileSystem.from_uri(quote(folder if ":/" in folder else f"file://{folder}", safe="/:@"))
                with store.open_input_stream(f"{base}/{name}", compression=None) as f:
                    held.append((path, f.read()))
                size += len(held[-1][1])
                if size >= HELD:
                    yield _numbered(held)
                    held, size = [], 0
            if held:
                yield _numbered(held)

    whole = dealt.mapInArrow(read, "file string, line_no int, line string").select(F.regexp_replace("file", "^file:/+", "file:/").alias("file"), "line_no", F.regexp_replace("line", "\r$", "").alias("line"))
    long = [r["path"] for r in files.where(ranged & (F.col("length") > 0)).select("path").collect()]
    return whole.unionByName(log_lines(spark, long)) if long else whole


def parsed(lines: DataFrame) -> DataFrame:
    """(file, line_no, line, ts, offset_us, fix) of the lines with a readable time.

    Time zero is the first readable time of the file, whatever its sentence is.
    """
    bare = logs.once(lines.select("file", "line_no", F.col("line").alias("raw")), logs.stripped(F.col("raw")), "line").where("line <> ''")
    halves = logs.once(bare, F.split("line", ";", 2), "halves").where("size(halves) = 2")
    timed = logs.once(halves, logs.timestamp(F.col("halves")[0]), "ts").where("ts IS NOT NULL")
    timed = timed.select("file", "line_no", "line", "ts", F.col("halves")[1].alias("sentence"))
    timed = logs.with_fix(timed, "sentence").drop("sentence")
    return first_offset(timed, ["file"], ["line_no"], "ts")


def points(lines: DataFrame) -> DataFrame:
    """(file, line_no, ts, offset_us, lat, lon) of lines with a fix and both coordinates."""
    good = parsed(lines).where("fix.quality > 0 AND fix.lat IS NOT NULL AND fix.lon IS NOT NULL")
    return good.select("file", "line_no", "ts", "offset_us", "fix.lat", "fix.lon")


def fixed_lines(lines: DataFrame) -> DataFrame:
    """(file, line_no, line, offset_us) of lines with a fix, coordinates or not: what cuts keep."""
    return parsed(lines).where("fix.quality > 0").select("file", "line_no", "line", "offset_us")
