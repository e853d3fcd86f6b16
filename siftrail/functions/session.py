"""What a session needs before it runs this library's Python functions."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it.

    On a cluster whose machines lack that folder, ship the library with ``--py-files`` instead.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder, as a URI, below the one that driver and executors share (``spark.checkpoint.dir``).

    Where that is unset and all runs on one machine, as in tests, it is a temporary one.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        where = "file://" + tempfile.mkdtemp(prefix="siftrail-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_CUTS: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, deleted when the driver's process ends.

    What follows is computed from the files, on whichever executors are left, and sees the same rows each time.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    if not _CUTS:
        atexit.register(_drop_cuts)
    _CUTS.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop_cuts() -> None:
    for spark, path in _CUTS:
        if spark.sparkContext._jsc is not None:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        elif path.startswith("file:"):  # the session was stopped first
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
