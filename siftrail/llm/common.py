"""What the training-data operators share: the shared folder, written cuts and safe names."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftrail.functions.session import importable

_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only where that is unset and all
    runs on one machine, as in tests, a temporary folder is made and remembered there.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and the executors of {master} share")
        where = "file://" + tempfile.mkdtemp(prefix="siftrail-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, deleted when the driver's process ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_drop_written)
    _WRITTEN.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of ``new_path`` early."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def _drop_written() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_WRITTEN):
        if spark is not None and spark.sparkContext._jsc is not None:
            drop_path(spark, path)
        elif path.startswith("file:"):  # the session was stopped first
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it again."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType, rows: int = 256) -> DataFrame:
    """``df.mapInArrow`` with at most ``rows`` rows at a time.

    Spark bounds the bytes of a batch; this bounds what a function unpacks at once, whatever the
    session's own Arrow settings are.
    """
    importable(df.sparkSession)

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))

    return df.mapInArrow(sliced, schema)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters that end before white space."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def add_columns(df: DataFrame, text: str, make: Callable[[], Callable[[str | None], tuple]], added: list[tuple[str, str]]) -> DataFrame:
    """``df`` with columns computed from one text column, an Arrow batch at a time.

    ``make()`` runs once in each task and gives the function from a text to the new values.
    New columns take the place of old ones with the same name.
    """
    new = {name.lower() for name, _ in added}
    kept = [c for c in df.columns if c.lower() not in new or c == text]
    frame = df.select(*[col(c) for c in kept]).toDF(*[f"c{i}" for i in range(len(kept))])
    at, drop_text = kept.index(text), text.lower() in new
    types = [T._parse_datatype_string(kind) for _, kind in added]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in frame.schema] + [T.StructField(f"n{i}", t, True) for i, t in enumerate(types)])
    arrow_types = [pa_type(t) for t in types]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            got = [one(t.as_py()) for t in batch.column(at)]
            more = [pa.array([g[i] for g in got], t) for i, t in enumerate(arrow_types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *[f"n{i}" for i in range(len(more))]])

    out = map_batches(frame, run, schema).toDF(*kept[:at], "__text" if drop_text else text, *kept[at + 1 :], *[name for name, _ in added])
    return out.drop("__text") if drop_text else out


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
