"""Files written with a list of them, moved by tasks and read back by the list."""

from __future__ import annotations

import gzip

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs

from siftrail.plans import catalog_files
from siftrail.sources import logs, named_files, sinks


def test_the_driver_gets_a_list_and_no_names(spark, tmp_path):
    df = spark.createDataFrame([(f"v/{i}" if i % 2 else f"ä {i}", "x" * i) for i in range(40)], "name string, content string").repartition(5)
    listed = sinks.listed_label_files(df, str(tmp_path / "a b"))
    got = {r["path"].split("/a b/")[1]: r["length"] for r in listed.collect()}
    assert got == {(f"v/{i}" if i % 2 else f"ä {i}") + ".txt": i for i in range(40)}
    assert {str(p.relative_to(tmp_path / "a b")): p.stat().st_size for p in (tmp_path / "a b").rglob("*") if p.is_file()} == got
    read = logs.listed_lines(listed)
    assert sorted(r["line"] for r in read.collect()) == ["x" * i for i in range(1, 40)]
    writer = named_files.NamedFilesWriter(f"file://{tmp_path}/c", "_staged-1")
    rows = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array([b"1", b"22"])], names=["name", "content"])
    lost, won, none = writer.write(iter([rows])), writer.write(iter([rows])), writer.write(iter([]))
    assert not won.files and lost.folder != won.folder and not none.folder
    writer.commit([won, None, none])
    kept = pq.read_table(f"{tmp_path}/c/_staged-1/won").to_pylist()
    assert [(r["folder"], r["name"], r["length"]) for r in kept] == [(won.folder, "a", 1), (won.folder, "b", 2)]
    writer.abort([])
    assert not list((tmp_path / "c").iterdir())


def test_a_file_that_another_attempt_has_moved_is_no_fault(tmp_path):
    store = fs.LocalFileSystem()
    (tmp_path / "b").write_bytes(b"123")
    named_files.move(store, f"{tmp_path}/a", f"{tmp_path}/b", 3)
    for target, length in (("b", 4), ("c", 3)):
        try:
            named_files.move(store, f"{tmp_path}/a", f"{tmp_path}/{target}", length)
        except OSError:
            continue
        raise AssertionError(target)


def test_listed_lines_are_those_of_log_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(logs, "WHOLE", 3_000)
    monkeypatch.setattr(logs, "TASK", 40_000)
    texts = {"a b.log": b"one\r\n\r\n\nthree\rstill\r\n last", "c.log": b"\n\n", "d.log": b"\xef\xbb\xbfx\ny\r", "e.log": b"\xef\xbb\xbf", "f.log": b"\xef\xbb\xbf\n", "odd.log": b"\xff\xfe\n\0z", "long.log": b"".join(b"line %d\n" % i for i in range(900)), "none.log": b""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    (tmp_path / "p.log.gz").write_bytes(gzip.compress(b"packed\nlines\n"))
    rows = lambda df: sorted((r["file"], r["line_no"], bytes(r["line"])) for r in df.selectExpr("file", "line_no", "CAST(line AS BINARY) AS line").collect())
    got = rows(logs.listed_lines(logs.listing(spark, str(tmp_path)).select("path", "length")))
    assert got == rows(logs.log_lines(spark, str(tmp_path))) and len(got) > 910


def test_queries_list_no_folder(spark, sf_dir, monkeypatch):
    def refuse(*_):
        raise AssertionError("a folder was listed on the driver")

    monkeypatch.setattr(logs, "log_lines", refuse)
    assert catalog_files.written_labels(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
