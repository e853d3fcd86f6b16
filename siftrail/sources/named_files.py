"""A Spark data source that writes rows to files of given names, all of them or none.

Rows are (name, content); neighbouring rows of one name go to one file, one after another, so a file may be
larger than any row and than a task's memory. A task writes below a folder of its own attempt; only after the
commit are the files of the attempts that won moved to their names. What an attempt that failed, was run twice or
was lost with its executor has written is deleted, and never seen under a file's name.

``save`` has tasks move the files: a task lists what it wrote in a table beside its files, the commit keeps the tables
of those that won, and the driver sees no name. A writer used by itself moves them in its commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from siftrail.functions.session import cut, importable

STAGED = "_staged-"
LISTED, LISTED_ROWS = pa.schema([("folder", pa.string()), ("name", pa.string()), ("length", pa.int64())]), 50_000
MOVED_IN_TASK = 5_000


@dataclass
class Attempt(WriterCommitMessage):
    """What one attempt at a task has written: its folder, and the names and sizes of its files if no table lists them."""

    folder: str
    files: list[tuple[str, int]]


class NamedFiles(DataSource):
    """``df.write.format("named_files").mode("append").save(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if schema.fieldNames() != ["name", "content"]:
            raise ValueError(f"named files are written from the columns name and content, not {schema.fieldNames()}")
        return NamedFilesWriter(self.options["path"], self.options.get("job"))


class Listed:
    """The names and sizes of an attempt's files, written to a table as they come."""

    def __init__(self, store: fs.FileSystem, folder: str) -> None:
        self.store, self.folder, self.rows, self.out = store, folder, [], None

    def append(self, file: tuple[str, int]) -> None:
        self.rows.append(file)
        if len(self.rows) >= LISTED_ROWS:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            if self.out is None:
                self.store.create_dir(self.folder.rpartition("/")[0], recursive=True)
                self.out = pq.ParquetWriter(f"{self.folder}.parquet", LISTED, filesystem=self.store)
            self.out.write_table(pa.table([[self.folder] * len(self.rows), *map(list, zip(*self.rows, strict=True))], schema=LISTED))
            self.rows = []

    def close(self) -> None:
        self.flush()
        if self.out is not None:
            self.out.close()


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str | None = None) -> None:
        self.path = path
        self.listed = job is not None
        self.job = job or f"{STAGED}{uuid.uuid4().hex}"

    def store(self) -> tuple[fs.FileSystem, str]:
        store, base = fs.FileSystem.from_uri(self.path)
        return store, base.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        store, base = self.store()
        attempt = f"{base}/{self.job}/{uuid.uuid4().hex}"
        files: list[tuple[str, int]] | Listed = Listed(store, attempt) if self.listed else []
        now, out, size, made = None, None, 0, None
        try:
            for batch in iterator:
                for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                    if out is None or name.as_py() != now:
                        if out is not None:
                            out.close()
                            files.append((now, size))
                        now, size = name.as_py(), 0
                        if not now or ".." in now.split("/"):
                            raise ValueError(f"{now!r} is no name of a file below the folder")
                        path = f"{attempt}/{now}"
                        if (folder := path.rpartition("/")[0]) != made:
                            store.create_dir(folder, recursive=True)
                            made = folder
                        out = store.open_output_stream(path, compression=None)
                    if (data := content.as_buffer()) is not None:
                        out.write(data)
                        size += data.size
        finally:
            if out is not None:
                out.close()
        if now is not None:
            files.append((now, size))
        if not self.listed:
            return Attempt(attempt, files)
        files.close()
        return Attempt(attempt if files.out is not None else "", [])

    def commit(self, messages: list[Attempt | None]) -> None:
        store, base = self.store()
        if self.listed:  # a table for each task that has written anything
            store.create_dir(f"{base}/{self.job}/won", recursive=True)
            for m in messages:
                if m is not None and m.folder:
                    store.move(f"{m.folder}.parquet", f"{base}/{self.job}/won/{m.folder.rpartition('/')[2]}.parquet")
            return
        moves = [(f"{m.folder}/{name}", f"{base}/{name}") for m in messages if m is not None for name, _ in m.files]
        if len({to for _, to in moves}) < len(moves):
            self.abort(messages)
            raise ValueError("rows of one name were not neighbours in one task")
        for folder in sorted({to.rpartition("/")[0] for _, to in moves}):
            store.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:  # a move is one call to the store
            list(pool.map(lambda move: store.move(*move), moves))
        self.abort(messages)

    def abort(self, messages: list[Attempt | None]) -> None:
        """Delete everything the job has staged, also by attempts that told nothing."""
        store, base = self.store()
        if store.get_file_info(f"{base}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{base}/{self.job}")


def move(store: fs.FileSystem, source: str, target: str, length: int) -> None:
    """Move a file; that another attempt at the task has moved it already is no fault."""
    try:
        store.move(source, target)
    except OSError:
        found = store.get_file_info([source, target])
        if found[0].type != fs.FileType.NotFound or found[1].type != fs.FileType.File or found[1].size != length:
            raise


def save(rows: DataFrame, folder: str) -> DataFrame:
    """Write (name, content) rows, those of a name neighbours in one task, to files below ``folder``, a URI or a path.

    Gives (path, length) of the files, a written table, so that readers need not list the folder on the driver.
    """
    spark = rows.sparkSession
    importable(spark)
    spark.dataSource.register(NamedFiles)
    uri = (folder if ":/" in folder else f"file://{quote(folder)}").rstrip("/")
    writer = NamedFilesWriter(uri, f"{STAGED}{uuid.uuid4().hex}")

    def moved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = NamedFilesWriter(uri, "").store()
        made = base
        for batch in batches:
            for source, name, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                target = f"{base}/{name}"
                if (place := target.rpartition("/")[0]) != made:
                    store.create_dir(place, recursive=True)
                    made = place
                move(store, f"{source}/{name}", target, length)
            paths = pa.array([f"{unquote(uri)}/{name}" for name in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([paths, batch.column(2)], names=["path", "length"])

    try:
        rows.selectExpr("name", "CAST(content AS BINARY) AS content").write.format("named_files").option("job", writer.job).mode("append").save(uri)
        names = spark.read.schema("folder string, name string, length bigint").parquet(f"{unquote(uri)}/{writer.job}/won")
        tasks = names.count() // MOVED_IN_TASK + 1
        dealt = names.repartition(tasks, "name")
        if not dealt.groupBy("name").count().where("count > 1").isEmpty():
            raise ValueError("rows of one name were not neighbours in one task")
        return cut(dealt.sortWithinPartitions("name").mapInArrow(moved, "path string, length bigint"), "files-written")
    finally:
        writer.abort([])
