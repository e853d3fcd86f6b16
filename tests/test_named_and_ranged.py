"""Files of given names written all or none, logs read by ranges, and images measured by a few of their bytes."""

from __future__ import annotations

import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftrail.sources import datasets, logs, named_files, ranged, sinks


def files_of(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["name", "content"])


def test_rows_of_a_name_are_one_file(spark, tmp_path):
    rows = [("a/x.log", i, f"{i}\n") for i in range(50)] + [("y.log", 0, None), ("z ü.log", 0, "only"), ("empty", 0, "")]
    df = spark.createDataFrame(rows, "name string, i int, content string").repartition(7)
    named_files.save(df.repartition("name").sortWithinPartitions("name", "i"), str(tmp_path))
    assert files_of(tmp_path) == {"a/x.log": "".join(f"{i}\n" for i in range(50)).encode(), "y.log": b"", "z ü.log": b"only", "empty": b""}
    named_files.save(df.where("name = 'empty'").withColumn("content", F.lit("more")), str(tmp_path))
    assert files_of(tmp_path)["empty"] == b"more" and len(files_of(tmp_path)) == 4
    named_files.save(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() or files_of(tmp_path / "none") == {}


def test_a_task_that_fails_midway_leaves_nothing(spark, tmp_path):
    bad = F.when(F.col("id") == 177, F.raise_error(F.lit("broken row"))).otherwise(F.lit("x"))
    df = spark.range(0, 200, 1, 4).select(F.format_string("f%03d", "id").alias("name"), bad.cast("string").alias("content"))
    with pytest.raises(Exception, match="broken row"):
        named_files.save(df, str(tmp_path))
    assert files_of(tmp_path) == {}
    with pytest.raises(Exception, match="no name of a file"):
        named_files.save(spark.createDataFrame([("../x", "a")], "name string, content string"), str(tmp_path))
    assert files_of(tmp_path) == {} and not (tmp_path.parent / "x").exists()


def test_of_two_attempts_only_the_one_that_won_is_seen(tmp_path):
    writer = named_files.NamedFilesWriter(f"file://{tmp_path}")

    def dies():
        yield batch([("a", b"half of"), ("b", b"cut o")])
        raise OSError("the executor is lost")

    with pytest.raises(OSError):
        writer.write(dies())
    lost = writer.write(iter([batch([("a", b"speculative"), ("b", b"copy")])]))
    won = writer.write(iter([batch([("a", b"whole")]), batch([("a", b" file"), ("b", b"other")])]))
    assert lost.folder != won.folder and won.files == [("a", 10), ("b", 5)]
    assert not (tmp_path / "a").exists()
    writer.commit([won, None])
    assert files_of(tmp_path) == {"a": b"whole file", "b": b"other"}


def test_rows_of_a_name_in_two_tasks_are_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "name string, content string").coalesce(1)
    with pytest.raises(Exception, match="neighbours"):
        named_files.save(df, str(tmp_path))
    assert files_of(tmp_path) == {}


def test_label_files(spark, tmp_path):
    df = spark.createDataFrame([("v_frame_000001", "0 .1 .2 .3 .4\n1 0 0 1 1"), ("v_frame_000002", "")], "name string, content string")
    assert sinks.write_label_files(df, str(tmp_path)) == 2
    assert files_of(tmp_path) == {"v_frame_000001.txt": b"0 .1 .2 .3 .4\n1 0 0 1 1", "v_frame_000002.txt": b""}


@pytest.mark.parametrize("split_bytes", [64, 5_000, 1 << 27])
def test_lines_are_numbered_over_all_ranges_of_a_log(spark, tmp_path, split_bytes):
    texts = {"a.log": "\n".join(f"line {i} " + "ä" * (i % 40) for i in range(300)) + "\n", "b b.log": "one\r\n\r\n\nthree\rstill\r\n last", "c.log": "\n\n", "d.log": "x" * 9_000 + "\ny"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        read = logs.log_lines(spark, str(tmp_path))
        got = sorted((r["file"].rsplit("/", 1)[1], r["line_no"], r["line"]) for r in read.collect())
        many = spark.read.text(str(tmp_path / "a.log")).rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [(name, i, line) for name, text in texts.items() for i, line in enumerate([x.removesuffix("\r") for x in text.split("\n")])]
    assert got == sorted(w for w in want if w[1] < texts[w[0]].count("\n") or w[2])
    assert many >= 5 or split_bytes > 10_000


def big(head: bytes) -> bytes:
    return head + bytes(20_000_000 - len(head))


def large_images():
    app = b"\xff\xe1" + struct.pack(">H", 65_000) + bytes(64_998)
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, 300, 400, 3) + bytes(9)
    entries = struct.pack("<HHHIHHHHII", 2, 256, 3, 1, 400, 0, 257, 4, 1, 300)
    return {
        "a.png": big(b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 400, 300)),
        "b.jpg": big(b"\xff\xd8" + frame),
        "c.jpeg": big(b"\xff\xd8" + app * 20 + b"\xff" + frame),
        "d.tiff": big(b"II*\0" + struct.pack("<I", 19_000_000))[:19_000_000] + entries + bytes(100),
        "e.bmp": big(b"BM" + bytes(16) + struct.pack("<ii", 400, -300)),
    }


def test_of_a_large_image_a_few_pages_are_read(spark, tmp_path):
    place = tmp_path / "a b" / "train" / "images"
    place.mkdir(parents=True)
    for name, content in large_images().items():
        (place / name).write_bytes(content)
    (place / "gone.png").write_bytes(b"")
    (place / "odd.jpg").write_bytes(b"\xff\xd8\xff\xe1\0\x02\xff")
    files = datasets.dataset_files(spark, str(tmp_path / "a b")).select("path", "name")
    got = {r["name"]: r for r in ranged.sizes(files).collect()}
    assert {n: (got[n]["width"], got[n]["height"]) for n in large_images()} == dict.fromkeys(large_images(), (400, 300))
    for n in ("a.png", "b.jpg", "e.bmp"):
        assert got[n]["bytes_read"] == ranged.PAGE
    assert got["c.jpeg"]["bytes_read"] <= 22 * ranged.PAGE and got["d.tiff"]["bytes_read"] <= 3 * ranged.PAGE
    assert (got["odd.jpg"]["width"], got["odd.jpg"]["height"]) == datasets.FALLBACK
    whole = spark.read.format("binaryFile").load(str(place)).select("path", "content")
    assert {(r["width"], r["height"]) for r in ranged.sizes(whole.where("length > 100"), content="content").collect()} == {(400, 300)}
    lost = spark.createDataFrame([("file:/nowhere/x.png",), (None,)], "path string")
    assert {(r["width"], r["height"], r["bytes_read"]) for r in ranged.sizes(lost).collect()} == {(*datasets.FALLBACK, 0)}


def test_pages_give_the_bytes_of_a_range():
    data = bytes(range(256)) * 50
    for page in (0, 1, 4095, 4096, 12_799, 12_800, 13_000):
        file = ranged.Pages(lambda a, n: data[a : a + n], len(data))
        for size in (0, 1, 4, 5_000):
            assert file.at(page, size) == data[page : page + size]
