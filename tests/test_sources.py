"""Logs, datasets, sinks and pure-driver parts on small files."""

from __future__ import annotations

import json
import struct
import zipfile

import pytest
import yaml
from pyspark.sql import functions as F

from siftrail.functions import boxes, logs
from siftrail.operators import annotations
from siftrail.plans import registry, stages
from siftrail.sources import datasets, sinks
from siftrail.sources import logs as log_source

SENTENCE = "$GPGGA,101500.00,4830.600000,N,01121.000000,E,1,07,0.9,12.0,M,40.0,M,,*00"


def test_log_to_points(spark, tmp_path):
    log = tmp_path / "2025-07-17_14-10-32_gps.log"
    lines = [
        "2025-07-17T14:11:12,000000000+02:00;$GPGSV,x",
        "",
        "no semicolon",
        f"2025-07-17T14:11:13,772495840+02:00;{SENTENCE}",
        f"2025-07-17T14:11:14+02:00;{SENTENCE.replace('$GPGGA', '$GNGGA')}",
        f"2025-07-17T14:11:15+02:00;{SENTENCE.replace(',E,1,', ',E,0,')}",
        "2025-07-17T14:11:16+02:00;$GPGGA,1,,,,,1,04",
        f"yesterday;{SENTENCE}",
        f"2025-07-17T14:11:17+02:00;{SENTENCE.replace(',N,', ',S,').replace(',E,', ',W,')}",
    ]
    log.write_text("\n".join(lines) + "\n")
    read = log_source.log_lines(spark, str(log))
    got = log_source.points(read).orderBy("line_no").collect()
    assert [(r["line_no"], r["offset_us"]) for r in got] == [(3, 1_772_495), (8, 5_000_000)]
    assert got[0]["lat"] == pytest.approx(48.51) and got[0]["lon"] == pytest.approx(11.35)
    assert got[1]["lat"] < 0 and got[1]["lon"] < 0
    kept = [r["line_no"] for r in log_source.fixed_lines(read).orderBy("line_no").collect()]
    assert kept == [3, 6, 8]
    segs = spark.createDataFrame([(r["file"], 0, 1_000_000, 5_000_000) for r in read.limit(1).collect()], "file string, seg_idx int, start_us long, end_us long")
    named = sinks.log_segments(log_source.fixed_lines(read), segs)
    assert sinks.write_log_segments(named, str(tmp_path / "out")) == 1
    (part,) = (tmp_path / "out").glob("*_gps_segment_000.log")
    assert part.read_text().split("\n")[:-1] == [lines[3], lines[6], lines[8]]


def test_recordings(spark, tmp_path):
    for n in ("2025-07-17_14-10-32_video.mkv", "2025-07-17_14-10-32_gps.log", "2025-07-18_14-10-32_video.mp4", "x_video.mkv", "2025-07-17_14-10-32_video.MKV"):
        (tmp_path / n).write_bytes(b"x")
    (row,) = log_source.recordings(log_source.listing(spark, str(tmp_path))).collect()
    assert row["prefix"] == "2025-07-17_14-10-32" and row["video"].endswith("_video.mkv")
    when = spark.createDataFrame([("2025-07-17_14-10-32_video.mkv",), ("other.mkv",)], "n string").select(logs.recording_time(F.col("n")).cast("string").alias("t")).collect()
    assert [r["t"] for r in when] == ["2025-07-17 12:10:32", None]
    assert [r["name"] for r in log_source.videos(spark, str(tmp_path)).collect()] == ["2025-07-18_14-10-32_video.mp4"]


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", w, h) + b"\0" * 9


def dataset(root):
    for split, stem, label in [("train", "a", "0 0.5 0.5 0.5 0.5\n1 .5 .5 .25 .25\n"), ("train", "b", "9 0.5 0.5 0.5 0.5\n"), ("val", "c", "x 1 1 1 1\n0 0.5\n"), ("val", "d", None)]:
        for kind in ("images", "labels"):
            (root / split / kind).mkdir(parents=True, exist_ok=True)
        (root / split / "images" / f"{stem}.PNG").write_bytes(png(128, 128) if stem != "d" else b"broken")
        if label is not None:
            (root / split / "labels" / f"{stem}.txt").write_text(label)
    (root / "train" / "images" / "a.jpg").write_bytes(b"\xff\xd8\xff\xc0\0\x11\x08\0\x40\0\x80")
    (root / "data.yaml").write_text("names: {0: waste, 1: leaf}\n")


def test_dataset_report(spark, tmp_path):
    dataset(tmp_path)
    names = datasets.class_names(datasets.load_mapping(datasets.find_config(str(tmp_path))))
    images, labels, classes = datasets.images(spark, str(tmp_path)), datasets.labels(spark, str(tmp_path)), datasets.class_table(spark, names)
    sizes = {(r["stem"], r["width"], r["height"]) for r in images.collect()}
    assert sizes == {("a", 128, 128), ("a", 128, 64), ("b", 128, 128), ("c", 128, 128), ("d", 1280, 720)}
    totals = {r["split"]: (r["images"], r["empty_images"], r["objects"]) for r in annotations.split_totals(images, labels, classes).collect()}
    assert totals == {"train": (3, 0, 4), "val": (2, 2, 0), None: (5, 2, 4)}
    report = annotations.class_report(images, labels, classes)
    one = {(r["split"], r["class_name"]): r for r in report.collect()}
    assert (one["train", "waste"]["small"], one["train", "waste"]["medium"]) == (0, 2)
    assert (one["train", "leaf"]["small"], one["train", "leaf"]["medium"]) == (1, 1)  # 512 and exactly 1024
    assert one["val", "waste"]["instance_pct"] == 0.0
    sinks.write_document(annotations.report_document(images, labels, classes, "d"), str(tmp_path / "r.json"))
    doc = json.loads((tmp_path / "r.json").read_text())
    assert doc["summary"]["total_empty_images"] == 2 and doc["class_names"] == {"0": "waste", "1": "leaf"}
    assert doc["splits"]["train"]["classes"][0]["size_distribution"] == {"small": 0, "medium": 2, "large": 0}
    text = sinks.printed_report(report, annotations.split_totals(images, labels, classes))
    assert text.index("train:") < text.index("val:")


def test_flat_layout_counts_over_nested(spark, tmp_path):
    for p in ("train/val/images/a.png", "val/images/b.png", "train/train/images/c.png"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(png(4, 4))
    got = {(r["split"], r["stem"]) for r in datasets.dataset_files(spark, str(tmp_path)).collect()}
    assert got == {("val", "b"), ("train", "c")}


def test_raw_layout_and_tables(spark, tmp_path):
    p = tmp_path / "raw/train/s1/images/a.jpg"
    p.parent.mkdir(parents=True)
    p.write_bytes(b"x")
    raw = datasets.raw_files(spark, str(tmp_path))
    assert not datasets.has_test_images(raw)
    (row,) = raw.collect()
    assert (row["split"], row["source"], row["kind"], row["stem"]) == ("train", "s1", "images", "a")
    (tmp_path / "r.csv").write_text("MODEL,precision,recall,map50,map,f1,fitness\nm,0.5,0.6,0.4,0.3,,0.42\n")
    assert datasets.results_table(spark, str(tmp_path / "r.csv")).first()["fitness"] == 0.42
    (tmp_path / "m.json").write_text('{\n "a": 1\n}')
    assert datasets.marker(spark, str(tmp_path / "m.json"), "a int").first()["a"] == 1


def test_class_names_of_odd_configs():
    assert datasets.class_names({"names": ["a", "b"]}) == {0: "a", 1: "b"}
    for odd in ({}, {"names": []}, {"names": 3}):
        with pytest.raises(ValueError):
            datasets.class_names(odd)


def test_sizes(spark):
    df = spark.createDataFrame([(1023.9,), (1024.0,), (9215.9,), (9216.0,), (float("nan"),)], "a double")
    assert [r[0] for r in df.select(boxes.size_class(F.col("a"))).collect()] == ["small", "medium", "medium", "large", "large"]


def odd_images():
    app = b"\xff\xe1" + struct.pack(">H", 65_000) + bytes(64_998)
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, 300, 400, 3) + bytes(9)
    entries = lambda o: struct.pack(o + "HHHIHHHHII", 2, 256, 3, 1, 400, 0, 257, 4, 1, 300)
    big = struct.pack("<HHHHQ", 0x4949, 43, 8, 0, 16) + struct.pack("<QHHQQHHQQ", 2, 256, 4, 1, 400, 257, 16, 1, 300)
    riff = lambda kind, body: b"RIFF\0\0\0\0WEBP" + kind + b"\0\0\0\0" + body
    return {
        "late.jpg": b"\xff\xd8" + app * 3 + b"\xff" + frame,
        "little.tiff": b"II*\0" + struct.pack("<I", 100_008) + bytes(100_000) + entries("<"),
        "motorola.tiff": b"MM\0*" + struct.pack(">I", 8) + entries(">"),
        "big.tiff": big,
        "lossless.webp": riff(b"VP8L", b"\x2f" + struct.pack("<I", 399 | 299 << 14) + bytes(9)),
        "extended.webp": riff(b"VP8X", bytes(4) + (399).to_bytes(3, "little") + (299).to_bytes(3, "little")),
    }


def test_sizes_behind_other_data(spark, tmp_path):
    place = tmp_path / "train" / "images"
    place.mkdir(parents=True)
    for name, content in odd_images().items():
        (place / name).write_bytes(content)
    (place / "cut.tiff").write_bytes(b"II*\0" + struct.pack("<I", 4000))
    assert all(datasets.image_size(content) == (400, 300) for content in odd_images().values())
    got = {r["path"].rsplit("/", 1)[1]: (r["width"], r["height"]) for r in datasets.images(spark, str(tmp_path)).collect()}
    listed = [n for n in odd_images() if not n.endswith(".webp")]  # which the dataset's reader does not take
    assert got == dict.fromkeys(listed, (400, 300)) | {"cut.tiff": datasets.FALLBACK}


def test_zip_and_description(tmp_path):
    (tmp_path / "images").mkdir()
    (tmp_path / "images/a.jpg").write_bytes(b"x" * 100)
    sinks.write_description({0: "w"}, str(tmp_path / "data.yaml"))
    assert sinks.zip_dataset(str(tmp_path), str(tmp_path / "o.zip")) == 2
    with zipfile.ZipFile(tmp_path / "o.zip") as z:
        assert z.getinfo("images/a.jpg").compress_type == zipfile.ZIP_STORED
    assert yaml.safe_load((tmp_path / "data.yaml").read_text())["names"] == ["w"]


def run_folder(root, **extra):
    run = root / "runs/r1"
    (run / "weights").mkdir(parents=True)
    (run / "weights/best.pt").write_bytes(b"weights")
    (run / "metadata.yaml").write_text(yaml.safe_dump({"experiment_name": "e", "model_backend": "rtmdet", "image_size": 320, **extra}))
    (run / "model_config.py").write_text("x = 1")
    return run


def test_promotion(tmp_path):
    run_folder(tmp_path)
    weights, meta = registry.promote(str(tmp_path), run_dir="runs/r1", params={"evaluation": {"baseline_weights_path": "models/best.pt"}}, tag="t")
    data = yaml.safe_load(meta.read_text())
    assert weights.read_bytes() == b"weights" and (weights.parent / "model_config.py").read_text() == "x = 1"
    assert (data["model_config_path"], data["source_run"], data["source_weights"], data["tag"]) == ("model_config.py", "runs/r1", "runs/r1/weights/best.pt", "t")
    assert registry.require_baseline(str(weights))
    weights.unlink()
    with pytest.raises(FileNotFoundError):
        registry.require_baseline(str(weights))
    assert not registry.require_baseline(str(tmp_path / "nowhere/best.pt"))


def test_promotion_checks_first(tmp_path):
    run = run_folder(tmp_path)
    (run / "metadata.yaml").write_text("model_backend: ' '\n")
    with pytest.raises(ValueError):
        registry.promote(str(tmp_path), run_dir="runs/r1", baseline="models/best.pt")
    assert not (tmp_path / "models").exists()
    with pytest.raises(ValueError):
        registry.default_baseline({}, tmp_path)
    with pytest.raises(ValueError):
        registry.find_source(tmp_path)


def test_settings():
    params = {"train": {"model": "a", "epochs": 100, "image_size": 320, "finetune": {}}, "models_defaults": {"yolo": {"epochs": 50, "cache_dir": "c"}}, "models": {"a": {"backend": "yolo", "asset_id": "x", "image_size": 640}, "b": {"backend": "rfdetr", "asset_id": "y"}}}
    assert registry.model_settings(params, "a") == {"epochs": 50, "image_size": 640, "cache_dir": "c", "backend": "yolo", "asset_id": "x"}
    with pytest.raises(ValueError):
        registry.model_settings(params, "b")
    assert registry.backend_differences(params) == (set(), {"rtmdet"})
    assert registry.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}) == {"a": {"b": 3, "c": 2}, "d": 4}


def test_command_line_defaults():
    assert registry.with_project_defaults([], "/p") == ["--stage", "train", "--workspace-root", "/p", "--config", "/p/params.yaml"]
    assert registry.with_project_defaults(["--stage=evaluate", "--config", "c"], "/p") == ["--stage=evaluate", "--config", "c", "--workspace-root", "/p"]


def test_stages(tmp_path):
    log = []
    make = lambda name: lambda params: (log.append(name), (tmp_path / f"{name}.out").write_text(str(params)))
    graph = [
        stages.Stage("train", make("train"), ("train.epochs",), ("prepare.out",), ("train.out",)),
        stages.Stage("prepare", make("prepare"), ("prepare",), ("raw",), ("prepare.out",)),
        stages.Stage("check", make("check"), always=True, outs=("check.out",)),
    ]
    (tmp_path / "raw").mkdir()
    params = {"train": {"epochs": 1, "lr": 2}, "prepare": {"v": 1}}
    assert set(stages.run(graph, params, str(tmp_path))) == {"prepare", "train", "check"}
    assert stages.run(graph, params, str(tmp_path)) == ["check"]
    params["train"]["lr"] = 3
    assert stages.run(graph, params, str(tmp_path)) == ["check"]
    params["train"]["epochs"] = 3
    assert "prepare" not in stages.run(graph, params, str(tmp_path))
    (tmp_path / "raw/x").write_text("new")
    assert "prepare" in stages.run(graph, params, str(tmp_path))
    with pytest.raises(ValueError):
        stages.order([stages.Stage("a", print, outs=("o",)), stages.Stage("b", print, outs=("o",))])
