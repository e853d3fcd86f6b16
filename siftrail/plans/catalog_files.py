"""Named queries that go through files: written from the sample tables, then found, read and promoted.

The files stand for recordings, datasets, result tables and runs; they are written below the folder
that driver and executors share. The SQL says what must come back from the same tables.
"""

from __future__ import annotations

import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.functions.session import cut, shared_folder
from siftrail.operators import annotations, frames, inference, ordered, prepare
from siftrail.plans import catalog_long, catalog_streams, registry, segments, stages  # noqa: F401  the first two add their queries
from siftrail.plans.catalog import _IMAGES_SQL, _POINTS_SQL, _SLOW, _STATS_SQL, ORACLE_SQL, QUERIES, USER, _dataset, _points, _query, _slow, _stats, _table
from siftrail.sources import datasets, logs, sinks
from siftrail.sources import frames as frame_source


__all__ = ["ORACLE_SQL", "QUERIES"]  # those of ``catalog``, with these among them


def _written(files: DataFrame, label: str) -> str:
    """The folder that (name, content) rows were written to."""
    folder = shared_folder(files.sparkSession, label)
    sinks.write_named(files, folder)
    return folder


def _read_back(files: DataFrame, column: str = "file") -> DataFrame:
    """The lines of files in a written list, each with its file's name."""
    return logs.listed_lines(files).withColumn("file", F.element_at(F.split("file", "/"), -1)).withColumnRenamed("file", column)


def _local(folder: str) -> Path:
    """A shared folder as a path, for what reads small files on the driver."""
    path = Path(folder.removeprefix("file://"))
    path.mkdir(parents=True, exist_ok=True)
    return path


# Recordings.

_STAMP_SQL = "strftime(TIMESTAMP '2025-01-01' + to_seconds(s_suppkey * 61), '%Y-%m-%d_%H-%M-%S')"


def _recordings(spark: SparkSession, sf_dir: str) -> str:
    key = F.col("s_suppkey")
    s = _table(spark, sf_dir, "supplier", "s_suppkey").withColumn("stamp", F.date_format(F.timestamp_seconds(F.lit(1735689600) + key * 61), "yyyy-MM-dd_HH-mm-ss"))
    end = F.element_at(F.array(*map(F.lit, ("mkv", "mp4", "avi", "mov"))), (key % 4 + 1).cast("int"))
    video = s.select(F.concat("stamp", F.lit("_video."), end).alias("name"), F.repeat(F.lit("v"), (key % 9 + 1).cast("int")).alias("content"))
    log = s.where("s_suppkey % 3 <> 0").select(F.concat("stamp", F.lit("_gps.log")).alias("name"), F.lit("x").alias("content"))
    return _written(video.unionByName(log), "recordings")


@_query(f"""
    SELECT {_STAMP_SQL} AS prefix, {_STAMP_SQL} || '_video.' || ['mkv', 'mp4', 'avi', 'mov'][s_suppkey % 4 + 1] AS video, {_STAMP_SQL} || '_gps.log' AS log
    FROM supplier WHERE s_suppkey % 4 <> 3 AND s_suppkey % 3 <> 0
""")
def paired_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos with the position log of their prefix."""
    found = logs.recordings(logs.listing(spark, _recordings(spark, sf_dir)))
    name = lambda c: F.element_at(F.split(c, "/"), -1).alias(c)
    return found.select("prefix", name("video"), name("log"))


@_query(f"SELECT {_STAMP_SQL} || '_video.mp4' AS name, s_suppkey % 9 + 1 AS length, row_number() OVER (ORDER BY s_suppkey) AS place FROM supplier WHERE s_suppkey % 4 = 1")
def ordered_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kind of video, in order of the path."""
    rows = logs.videos(spark, _recordings(spark, sf_dir)).select("name", "length").toPandas()  # a list of file names
    return spark.createDataFrame([(r.name, r.length, k) for k, r in enumerate(rows.itertuples(index=False), 1)], "name string, length long, place long")


@_query(f"""
    WITH RECURSIVE {_POINTS_SQL}, {_SLOW}, {_STATS_SQL},
    pick AS (SELECT user_id, min(frame_idx) AS place FROM stats WHERE detection_count >= 2 GROUP BY 1
             UNION ALL SELECT p.user_id, (SELECT min(c.frame_idx) FROM stats c WHERE c.user_id = p.user_id AND c.detection_count >= 2 AND c.frame_idx >= p.place + 3) FROM pick p WHERE p.place IS NOT NULL)
    SELECT (SELECT count(*) FROM supplier WHERE s_suppkey % 4 <> 3 AND s_suppkey % 3 <> 0) AS pairs, (SELECT count(*) FROM slow WHERE n >= 3) AS segments, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 1) AS total_videos,
           (SELECT count(*) FROM stats) AS total_frames_processed, (SELECT count(*) FROM pick WHERE place IS NOT NULL) AS total_frames_saved, 2 AS min_count_threshold, 3 AS min_interval
""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over recordings and videos has done, as one row."""
    folder = _recordings(spark, sf_dir)
    stats = _stats(spark, sf_dir)
    picked = frames.pick_frames(stats, "user_id", "frame_idx", 2, 3)
    return frames.run_counters(logs.recordings(logs.listing(spark, folder)), _slow(spark, sf_dir).where("n >= 3"), logs.listing(spark, folder, "*.mp4"), stats, picked, 2, 3)


# Models: weights by which SQL can do the same.

def _classifier() -> inference.Classifier:
    """Scores in the order of the SQL's own arithmetic, as classes may be equally probable but for the last bit."""

    def probabilities(value: np.ndarray, part: np.ndarray) -> np.ndarray:
        scores = np.exp(np.stack([0.03 * value - part / 100 - 1, -0.02 * value + 4 * part / 100 - 0.5, np.full(len(value), 0.25)], axis=1))
        top = scores.argmax(axis=1)[:, None]
        found = scores / scores.sum(axis=1, keepdims=True)
        # the division may make equal what was less: a class before the top one stays below it
        level = (np.arange(found.shape[1]) < top) & (found >= np.take_along_axis(found, top, axis=1))
        return np.where(level, np.nextafter(found, 0), found)

    return inference.Classifier({0: "active", 1: "idle", 2: "unknown"}, probabilities)


@_query("""
    WITH s AS (SELECT event_id, exp(0.03 * value - 0.01 * (event_id % 97) - 1) AS a, exp(-0.02 * value + 0.04 * (event_id % 97) - 0.5) AS i, exp(0.25) AS u FROM events),
    t AS (SELECT event_id, CASE WHEN a >= i AND a >= u THEN 'active' WHEN i >= u THEN 'idle' ELSE 'unknown' END AS top1, greatest(a, i, u) / (a + i + u) AS confidence FROM s)
    SELECT event_id, top1, round(confidence, 6) AS confidence, top1 = 'active' AND confidence >= 0.5 AS is_active FROM t
""")
def classified_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame's most probable class and its confidence, by a model loaded in the workers."""
    features = _table(spark, sf_dir, "events", "event_id", "value").withColumn("part", (F.col("event_id") % 97).cast("double"))
    judged = inference.classified(features, _classifier, ["value", "part"])
    return judged.select("event_id", "top1", F.round("confidence", 6).alias("confidence"), frames.is_class(F.col("top1"), F.col("confidence"), "active", 0.5).alias("is_active"))


def _detector():  # noqa: ANN202
    def model(value: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        out = []
        for v, k in zip(value, key, strict=True):
            j = np.arange(int(v) % 4)
            out.append(np.stack([(k + j) % 3, 1 / (1 + j + v / 100), (k % 10 + j) / 20, j / 8, np.full(len(j), 0.25), v / 1000 + 0 * j], axis=1))
        return out

    return model


@_query("""
    WITH e AS (SELECT event_id, value, CAST(floor(value) AS BIGINT) % 4 AS n FROM events),
    d AS (SELECT event_id, value, unnest(range(n)) AS j FROM e)
    SELECT event_id, CAST((event_id + j) % 3 AS INTEGER) AS class_id, round(1 / (1 + j + value / 100), 6) AS confidence, round((event_id % 10 + j) / 20, 6) AS xc, j / 8 AS yc, CAST(0.25 AS DOUBLE) AS w, round(value / 1000, 6) AS h FROM d
""")
def detected_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detections of each frame, by a model loaded in the workers."""
    found = inference.detected(_table(spark, sf_dir, "events", "event_id", "value"), _detector, ["value", "event_id"])
    return found.select("event_id", "class_id", *[F.round(c, 6).alias(c) for c in ("confidence", "xc", "yc", "w", "h")])


_LOG_SQL = """
    e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    lines AS (SELECT 'u' || user_id || '.log' AS file, n, ts, event_id,
                     event_id % 17 = 0 AS no_time, event_id % 13 = 0 AS other, event_id % 11 = 0 AS no_fix, event_id % 7 = 0 AS no_place,
                     52 + (event_id % 1000) / 20000.0 AS lat, 10 + (event_id % 777) / 20000.0 AS lon FROM e),
    timed AS (SELECT *, epoch_us(ts) - first_value(epoch_us(ts)) OVER (PARTITION BY file ORDER BY n) AS offset_us FROM lines WHERE NOT no_time),
    points AS (SELECT file, CAST(2 * n - 1 AS INTEGER) AS line_no, ts, offset_us,
                      52 + CAST(printf('%.4f', (lat - 52) * 60) AS DOUBLE) / 60 AS lat, 10 + CAST(printf('%.4f', (lon - 10) * 60) AS DOUBLE) / 60 AS lon
               FROM timed WHERE NOT other AND NOT no_fix AND NOT no_place)"""


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log for each user: every event a line behind a blank one, with faults of all kinds among them."""
    k = F.col("event_id")
    minutes = lambda whole, by: F.format_string(f"{whole}%07.4f", (k % by).cast("double") / 20000 * 60)
    place = F.when(k % 7 == 0, ",,,,").otherwise(F.concat(F.lit(","), minutes("52", 1000), F.lit(",N,"), minutes("010", 777), F.lit(",E")))
    sentence = F.concat(F.when(k % 13 == 0, "$GNGGA").otherwise("$GPGGA"), F.lit(",1"), place, F.when(k % 11 == 0, ",0").otherwise(",2"), F.lit(",08"))
    stamp = F.when(k % 17 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    line = F.concat(F.when(k % 5 == 0, "\t ").otherwise(""), stamp, F.lit(";"), sentence, F.when(k % 3 == 0, " \t").otherwise(""))
    rows = _table(spark, sf_dir, "events", "event_id", "user_id", "ts").select(F.col("user_id"), F.struct(F.col("ts").alias("at"), "event_id", line.alias("line")).alias("row"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda r: F.concat(F.lit(" \n"), r["line"])), "\n")
    return sinks.write_named(rows.groupBy("user_id").agg(text.alias("content")).select(F.concat(F.lit("u"), "user_id", F.lit(".log")).alias("name"), "content"), shared_folder(spark, "logs"))


def _log_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.points(_read_back(_logs(spark, sf_dir)))


@_query(f"WITH {_LOG_SQL} SELECT file, line_no, offset_us, round(lat, 9) AS lat, round(lon, 9) AS lon FROM points")
def log_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs read line by line into points."""
    return _log_points(spark, sf_dir).select("file", "line_no", "offset_us", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


# Distance by the law of haversines on the mean sphere, which shares nothing with the library's own; speeds
# and extents of these rows are further from their bounds than the two differ.
_SPHERE = "2 * 6371008.8 * asin(sqrt(pow(sin(radians(({1}) - ({0})) / 2), 2) + cos(radians({0})) * cos(radians({1})) * pow(sin(radians(({3}) - ({2})) / 2), 2)))"


@_query(f"""
    WITH {_LOG_SQL},
    many AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY file) AS total FROM points WINDOW w AS (PARTITION BY file ORDER BY line_no)),
    steps AS (SELECT *, coalesce({_SPHERE.format('lat', 'lead(lat) OVER w', 'lon', 'lead(lon) OVER w')}, 0) AS step FROM many WHERE total >= 2 WINDOW w AS (PARTITION BY file ORDER BY i)),
    around AS (SELECT *, sum(step) OVER (PARTITION BY file ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS way,
                      first_value(offset_us) OVER v AS t0, last_value(offset_us) OVER v AS t1
               FROM steps WINDOW v AS (PARTITION BY file ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
    speed AS (SELECT *, CASE WHEN t1 > t0 THEN way / ((t1 - t0) / 1e6) * 3.6 ELSE 0 END <= 5.0 AND NOT (lat BETWEEN 52.02 AND 52.05 AND lon BETWEEN 10.01 AND 10.05) AS on_run FROM around),
    runs AS (SELECT *, sum(CASE WHEN on_run THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM speed),
    found AS (SELECT file, min(offset_us) AS start_us, max(offset_us) AS end_us, count(*) AS n, min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS d FROM runs WHERE on_run GROUP BY file, run)
    SELECT file, start_us, end_us, n FROM found WHERE end_us - start_us >= 60000000 AND {_SPHERE.format('a', 'b', 'c', 'd')} >= 20
""")
def slow_segments_of_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs to points to speeds to slow segments."""
    rules = segments.SegmentRules(most_kmh=5.0, area=(52.02, 10.01, 52.05, 10.05))
    points = cut(_log_points(spark, sf_dir), "log-points")  # they are counted and then used
    return segments.slow_segments(ordered.dealt(points, ["file"]), ["file"], ["line_no"], rules).select("file", "start_us", "end_us", "n")


@_query("""
    SELECT n_name || '.mp4' AS video, CAST(i AS BIGINT) AS frame_idx, CAST(i * 40 AS DOUBLE) AS pos_ms, CAST(ord(n_name[i + 1]) AS BIGINT) AS first_byte
    FROM (SELECT n_name, unnest(range(length(n_name))) AS i FROM nation)
""")
def frame_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame of every video, by a decoder that is passed in; here a frame is eight equal bytes."""
    text = F.regexp_replace("n_name", "(.)", "$1" * 8)
    folder = _written(_table(spark, sf_dir, "nation", "n_name").select(F.concat("n_name", F.lit(".mp4")).alias("name"), text.alias("content")), "videos")
    read = frame_source.frames(spark, folder, lambda data: ((40.0 * k, data[8 * k : 8 * k + 8]) for k in range(len(data) // 8)))
    return read.select("video", "frame_idx", "pos_ms", F.ascii(F.col("image").cast("string")).cast("bigint").alias("first_byte"))


@_query("SELECT event_id, value / 500 AS confidence FROM events WHERE value > 100")
def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that is passed in, over frames."""
    def model(part: pd.DataFrame) -> pd.DataFrame:
        hit = part[part["value"] > 100]
        return pd.DataFrame({"event_id": hit["event_id"], "confidence": hit["value"] / 500})

    return frames.detect(_table(spark, sf_dir, "events", "event_id", "value"), model, "event_id bigint, confidence double")


# Image datasets.

_IMAGE_SQL = """
    imgs AS (SELECT s_suppkey AS k, ['train', 'val', 'test'][s_suppkey % 3 + 1] AS split, ['jpg', 'PNG', 'bmp', 'webp', 'txt', 'tiff'][s_suppkey % 6 + 1] AS suffix FROM supplier)"""


def _image_folder(spark: SparkSession, sf_dir: str) -> str:
    """train and test lie nested, val flat and nested; every image is a PNG of its own size or unreadable."""
    key = F.col("s_suppkey").cast("int")
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), key % len(names) + 1)
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), F.unhex(F.lpad(F.hex(F.lit(100) + key), 8, "0")), F.unhex(F.lpad(F.hex(F.lit(200) + key % 50), 8, "0")))
    content = F.when(key % 7 == 0, F.lit("no image").cast("binary")).otherwise(png)
    s = _table(spark, sf_dir, "supplier", "s_suppkey")
    place = pick(("train/train/images/", "val/images/", "train/test/images/"))
    end = pick(("jpg", "PNG", "bmp", "webp", "txt", "tiff"))
    images = s.select(F.concat(place, F.lit("i"), "s_suppkey", F.lit("."), end).alias("name"), content.alias("content"))
    hidden = s.select(F.concat(F.lit("train/val/images/h"), "s_suppkey", F.lit(".png")).alias("name"), content.alias("content"))
    label_place = pick(("train/train/labels/", "val/labels/", "train/test/labels/"))
    text = F.concat(key % 3, F.lit(" x 0.5 0.25\t0.125 9\n\n"), key % 2, F.lit(" 0.5 0.5 half 0.1\nz 1 1 1 1\n"), key % 5, F.lit(" 0.5 0.5 0.5\n 1 .5 .5 .5 .5"))
    labels = s.where("s_suppkey % 4 <> 0").select(F.concat(label_place, F.lit("i"), "s_suppkey", F.lit(".txt")).alias("name"), text.cast("binary").alias("content"))
    return _written(images.unionByName(hidden).unionByName(labels), "dataset")


@_query(f"""
    WITH {_POINTS_SQL}, {_SLOW}, num AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_us, end_us) - 1 AS i FROM slow WHERE n >= 3),
    hit AS (SELECT 'u' || n.user_id || '_segment_' || lpad(CAST(n.i AS VARCHAR), 3, '0') || '.log' AS name, p.event_id, p.event_type
            FROM num n JOIN pts p ON p.user_id = n.user_id AND p.offset_us BETWEEN n.start_us AND n.end_us)
    SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY event_id) - 1 AS INTEGER) AS line_no, event_id || ';' || event_type AS line FROM hit
""")
def written_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K3: the lines of each segment written to its file, and read back."""
    file = F.concat(F.lit("u"), F.col("user_id"), F.lit(".log")).alias("file")
    parts = ordered.number(_slow(spark, sf_dir).where("n >= 3"), USER).select(file, "seg_idx", "start_us", "end_us")
    lines = _points(spark, sf_dir).select(file, F.col("event_id").alias("line_no"), F.concat("event_id", F.lit(";"), "event_type").alias("line"), "offset_us")
    return _read_back(sinks.listed_log_segments(sinks.log_segments(lines, parts), shared_folder(spark, "segments")), "name")


@_query("""
    WITH l AS (SELECT 'v' || c_nationkey || '_frame_' || lpad(CAST(c_custkey // 4 AS VARCHAR), 6, '0') || '.txt' AS name,
                      printf('%d %.6f %.6f %.6f %.6f', c_custkey % 7, c_custkey / 32, 0.5, c_nationkey / 64, 0.25) AS line FROM customer)
    SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY line) - 1 AS INTEGER) AS line_no, line FROM l
""")
def written_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, K5: a label file for each frame, written and read back line by line; a customer is a detection."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    found = _table(spark, sf_dir, "customer", "c_custkey", "c_nationkey").select(F.concat(F.lit("v"), nation).alias("video"), F.expr("c_custkey div 4").alias("frame_idx"), (key % 7).alias("class_id"), F.array(key / 32, F.lit(0.5), nation / 64, F.lit(0.25)).alias("bbox"))
    return _read_back(sinks.listed_label_files(frames.label_files(found, "video", "frame_idx"), shared_folder(spark, "labels")), "name")


@_query(f"""
    WITH {_IMAGE_SQL} SELECT split, 'i' || k AS stem, CASE WHEN k % 7 = 0 THEN 1280 ELSE CAST(100 + k AS INTEGER) END AS width, CASE WHEN k % 7 = 0 THEN 720 ELSE CAST(200 + k % 50 AS INTEGER) END AS height
    FROM imgs WHERE lower(suffix) IN ('jpg', 'jpeg', 'png', 'bmp', 'tiff')
""")
def dataset_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of a dataset laid out both ways, with their sizes."""
    return datasets.images(spark, _image_folder(spark, sf_dir)).select("split", "stem", "width", "height")


@_query(f"""
    WITH {_IMAGE_SQL}, l AS (SELECT split, 'i' || k AS stem, k FROM imgs WHERE k % 4 <> 0)
    SELECT split, stem, CAST(k % 3 AS INTEGER) AS class_id, CAST(NULL AS DOUBLE) AS xc, 0.25::DOUBLE AS w, 0.125::DOUBLE AS h FROM l
    UNION ALL SELECT split, stem, 1, 0.5::DOUBLE, 0.5::DOUBLE, 0.5::DOUBLE FROM l
""")
def dataset_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files, of which lines without a whole class or without a width and height are passed over."""
    return datasets.labels(spark, _image_folder(spark, sf_dir)).select("split", "stem", "class_id", "xc", "w", "h")


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    o = _table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey", "n_name")
    split = F.when(F.col("n_nationkey") % 4 == 0, "test").when(F.col("n_nationkey") % 4 == 3, "other").otherwise("train")
    path = F.concat(split, F.lit("/source"), "n_regionkey", F.lit("/"), F.when(F.col("n_nationkey") % 2 == 0, "images/").otherwise("labels/"), "n_name", F.when(F.col("n_nationkey") % 2 == 0, ".png").otherwise(".txt"))
    return _written(o.select(path.alias("name"), F.lit("x").alias("content")), "raw")


@_query("""
    WITH f AS (SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'test' WHEN n_nationkey % 4 = 3 THEN 'other' ELSE 'train' END AS split, 'source' || n_regionkey AS source,
                      CASE WHEN n_nationkey % 2 = 0 THEN 'images' ELSE 'labels' END AS kind, n_name AS stem FROM nation)
    SELECT split, source, kind, stem, true AS test_folder FROM f WHERE split <> 'other'
""")
def raw_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files by split and source, and whether a test folder has images."""
    files = datasets.raw_files(spark, _raw_folder(spark, sf_dir))
    return files.select("split", "source", "kind", "stem", F.lit(datasets.has_test_images(files)).alias("test_folder"))


@_query("SELECT CAST(r_regionkey AS INTEGER) AS class_id, r_name AS class_name, form, 'train/data.yaml' AS place FROM region, (VALUES ('list'), ('map')) f(form)")
def described_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset's description written, found in the second place, and its classes read."""
    names = {r["r_regionkey"]: r["r_name"] for r in _table(spark, sf_dir, "region").collect()}  # a class list
    out = None
    for form in ("list", "map"):
        root = _local(shared_folder(spark, "described"))
        (root / "train").mkdir()
        (root / "test").mkdir()
        sinks.write_description(names, str(root / "train/data.yaml"))
        sinks.write_description({0: "wrong"}, str(root / "test/data.yaml"))
        if form == "map":
            (root / "train/data.yaml").write_text(yaml.safe_dump({"names": {str(k): v for k, v in names.items()}}))
        found = datasets.find_config(str(root))
        rows = datasets.class_table(spark, datasets.class_names(datasets.load_mapping(found))).withColumns({"form": F.lit(form), "place": F.lit(str(Path(found).relative_to(root)))})
        out = rows if out is None else out.unionByName(rows)
    return out


@_query("SELECT n_name AS model, min(c_acctbal) AS map50, CASE WHEN count(*) % 2 = 0 THEN NULL ELSE max(c_acctbal) END AS f1 FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1")
def result_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table written with its header and read by its schema."""
    rows = _table(spark, sf_dir, "nation", "n_nationkey", "n_name").join(_table(spark, sf_dir, "customer", "c_nationkey", "c_acctbal"), F.col("n_nationkey") == F.col("c_nationkey"))
    best = F.when(F.count("*") % 2 != 0, F.max("c_acctbal"))
    folder = shared_folder(spark, "results")
    sinks.write_rows_csv(rows.groupBy(F.col("n_name").alias("model")).agg(F.min("c_acctbal").alias("map50"), best.alias("f1")), folder)
    return datasets.results_table(spark, folder, "model string, map50 double, f1 double")


@_query("SELECT n_regionkey AS id, count(*) AS n, list_sort(list(n_name)) AS names FROM nation GROUP BY 1")
def json_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as indented JSON, one for each row, and read by a schema."""
    rows = _table(spark, sf_dir, "nation", "n_regionkey", "n_name").groupBy(F.col("n_regionkey").alias("id")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("n_name")).alias("names"))
    root = _local(shared_folder(spark, "markers"))
    for r in rows.select("id").collect():  # a document for each region
        sinks.write_document(rows.where(F.col("id") == r["id"]), str(root / f"{r['id']}.json"))
    return datasets.marker(spark, f"file://{root}", "id int, n bigint, names array<string>")


@_query("""
    SELECT 'images/' || n_name || '.png' AS name, CAST(length(n_name) AS BIGINT) AS size, true AS stored FROM nation
    UNION ALL SELECT 'data.yaml', 2, true
""")
def zipped_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the parts of a dataset in one archive, stored and not packed."""
    root = _local(_written(_table(spark, sf_dir, "nation", "n_name").select(F.concat(F.lit("images/"), "n_name", F.lit(".png")).alias("name"), F.col("n_name").alias("content")), "zipped"))
    (root / "data.yaml").write_text("{}")
    (root / "notes.txt").write_text("not of the dataset")
    archive = f"{root}.zip"
    sinks.zip_dataset(str(root), archive)
    with zipfile.ZipFile(archive) as z:
        found = [(i.filename, i.file_size, i.compress_type == zipfile.ZIP_STORED) for i in z.infolist()]
    return spark.createDataFrame(found, "name string, size long, stored boolean")


@_query(f"""
    WITH {_IMAGES_SQL},
    objects AS (SELECT split, stem, count(*) AS n, count(*) FILTER (class_id < 2) AS good FROM labels GROUP BY ALL),
    per AS (SELECT i.split, count(*) AS images, count(*) FILTER (o.n IS NULL) AS empty, coalesce(sum(good), 0) AS objects FROM images i LEFT JOIN objects o ON i.split = o.split AND i.stem = o.stem GROUP BY 1),
    whole AS (SELECT sum(images) AS images, sum(empty) AS empty, sum(objects) AS objects FROM per),
    c AS (SELECT split, class_name, class_id, count(*) AS n, count(DISTINCT path) AS seen, count(*) FILTER (size = 'small') AS s, count(*) FILTER (size = 'medium') AS m, count(*) FILTER (size = 'large') AS l FROM sized GROUP BY ALL),
    said AS (
        SELECT 0 AS a, 0 AS b, 0 AS k, format('Images: {{:,}}', CAST(images AS BIGINT)) AS line FROM whole
        UNION ALL SELECT 0, 1, 0, format('Objects: {{:,}}', CAST(objects AS BIGINT)) FROM whole
        UNION ALL SELECT 0, 2, 0, format('Empty: {{:,}} ({{:.1f}}%)', CAST(empty AS BIGINT), 100.0 * empty / images) FROM whole
        UNION ALL SELECT CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END, 0, 0, format('{{}}: {{:,}} images, {{:,}} objects, {{:,}} empty ({{:.1f}}%)', split, images, CAST(objects AS BIGINT), empty, 100.0 * empty / images) FROM per
        UNION ALL SELECT CASE c.split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END, 1, class_id,
            format('  {{}}: {{:,}} ({{:.1f}}%), in {{:,}} images ({{:.1f}}%), S/M/L {{:,}}/{{:,}}/{{:,}}', class_name, n, 100.0 * n / objects, seen, 100.0 * seen / images, s, m, l) FROM c JOIN per ON c.split = per.split)
    SELECT row_number() OVER (ORDER BY a, b, k) AS line_no, line FROM said
""")
def console_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as printed, its splits as train, val, test."""
    images, labels, classes = _dataset(spark, sf_dir)
    text = sinks.printed_report(annotations.class_report(images, labels, classes), annotations.split_totals(images, labels, classes))
    return spark.createDataFrame(list(enumerate(text.split("\n"), 1)), "line_no long, line string")


@_query("SELECT event_type AS what, count(*) AS n, false AS failed FROM events GROUP BY 1 UNION ALL SELECT 'nothing', 0, true")
def required_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error if no images are left, the images themselves if some are."""
    e = _table(spark, sf_dir, "events", "event_type")
    kept = prepare.require_rows(e).groupBy(F.col("event_type").alias("what")).agg(F.count("*").alias("n"), F.lit(False).alias("failed"))
    try:
        prepare.require_rows(e.where("event_type = 'nothing'"))
        failed = False
    except ValueError:
        failed = True
    return kept.unionByName(spark.createDataFrame([("nothing", 0, failed)], kept.schema))


# Runs, models and stages: small mappings and files, as many as there are nations or regions.


@_query("SELECT n_name AS model, CAST(n_nationkey AS BIGINT) AS epochs, CASE WHEN n_nationkey % 2 = 0 THEN 'fast' ELSE 'slow' END AS pace, 'adam' AS optimizer, CAST(n_regionkey AS BIGINT) AS depth FROM nation")
def merged_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's settings over its backend's over the shared ones, mapping by mapping."""
    rows = _table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").collect()  # a list of models
    backend = sorted(registry.REQUIRED)[0]
    given = {field: "given" for field in registry.REQUIRED[backend]}
    models = {r["n_name"]: given | {"backend": backend, "epochs": r["n_nationkey"], "tune": {"depth": r["n_regionkey"]}} | ({"pace": "fast"} if r["n_nationkey"] % 2 == 0 else {}) for r in rows}
    params = {"train": {"epochs": -1, "pace": "slow"}, "models_defaults": {backend: {"tune": {"optimizer": "adam", "depth": -1}, "epochs": -2}}, "models": models}
    found = [(k, registry.model_settings(params, k)) for k in models]
    return spark.createDataFrame([(k, s["epochs"], s["pace"], s["tune"]["optimizer"], s["tune"]["depth"]) for k, s in found], "model string, epochs long, pace string, optimizer string, depth long")


@_query("SELECT n_name AS model_key, CASE WHEN n_nationkey % 5 = 0 THEN 'odd' ELSE 'yolo' END AS backend, CAST(n_nationkey AS VARCHAR) AS asset_id, n_nationkey % 5 = 0 AS refused FROM nation")
def registered_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured models as a table, and which of them have a backend that is not supported."""
    rows = _table(spark, sf_dir, "nation", "n_nationkey", "n_name").collect()
    params = {"models": {r["n_name"]: {"backend": "odd" if r["n_nationkey"] % 5 == 0 else "yolo", "asset_id": str(r["n_nationkey"])} for r in rows}}
    unknown, _ = registry.backend_differences(params)
    return registry.model_table(spark, params).select("model_key", "backend", "asset_id", F.col("backend").isin(*unknown).alias("refused"))


@_query("""
    SELECT CAST(i AS BIGINT) AS i, arg, n_name FROM (
        SELECT n_name, unnest(CASE WHEN n_nationkey % 2 = 0 THEN ['--stage', 'eval', '--workspace-root', '/w', '--config', '/w/params.yaml']
                                   ELSE ['--config=' || n_name, '--stage', 'train', '--workspace-root', '/w'] END) AS arg,
               unnest(CASE WHEN n_nationkey % 2 = 0 THEN range(6) ELSE range(5) END) AS i FROM nation)
""")
def project_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arguments that are not given are added."""
    rows = _table(spark, sf_dir, "nation", "n_nationkey", "n_name").collect()
    found = [(i, a, r["n_name"]) for r in rows for i, a in enumerate(registry.with_project_defaults(["--stage", "eval"] if r["n_nationkey"] % 2 == 0 else [f"--config={r['n_name']}"], "/w"))]
    return spark.createDataFrame(found, "i long, arg string, n_name string")


@_query("""
    SELECT n_name AS run, md5(n_name) AS weights_md5, CASE WHEN n_nationkey % 2 = 0 THEN 'rtmdet' ELSE 'yolo' END AS backend,
           'runs/' || n_name AS source_run, CASE WHEN n_nationkey % 2 = 0 THEN 'model_config.py' END AS config, 'none' AS before, 'usable' AS after, 'missing' AS gone
    FROM nation
""")
def promoted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's weights promoted from their default places, with metadata and configuration."""
    import hashlib

    root, found = _local(shared_folder(spark, "runs")), []
    for r in _table(spark, sf_dir, "nation", "n_nationkey", "n_name").collect():
        name, own = r["n_name"], r["n_nationkey"] % 2 == 0
        run = root / "runs" / name
        (run / "weights").mkdir(parents=True)
        (run / "weights/best.pt").write_text(name)
        (run / "metadata.yaml").write_text(yaml.safe_dump({"model_backend": "rtmdet" if own else "yolo"}))
        if own:
            (run / "model_config.py").write_text(f"model = {name!r}")
        params = {"evaluation": {"baseline_weights_path": f"best/{name}/best.pt"}}
        place = str(registry.default_baseline(params, root))
        before = registry.baseline_state(place)
        target, meta = registry.promote(str(root), run_dir=f"runs/{name}", params=params)
        data, after = datasets.load_mapping(str(meta)), registry.baseline_state(place)
        if own and (target.parent / "model_config.py").read_text() != f"model = {name!r}":
            data["model_config_path"] = "not copied"
        md5 = hashlib.md5(target.read_bytes()).hexdigest()
        target.unlink()
        found.append((name, md5, data["model_backend"], data["source_run"], data.get("model_config_path"), before, after, registry.baseline_state(place)))
    return spark.createDataFrame(found, "run string, weights_md5 string, backend string, source_run string, config string, before string, after string, gone string")


@_query("""
    SELECT 'first' AS round, r_name AS stage FROM region UNION ALL SELECT 'first', 'all'
    UNION ALL SELECT 'changed', (SELECT r_name FROM region ORDER BY r_regionkey LIMIT 1) UNION ALL SELECT 'changed', 'all'
    UNION ALL SELECT 'lost', (SELECT r_name FROM region ORDER BY r_regionkey DESC LIMIT 1)
""")
def rerun_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages in order of what they need, run again only if that has changed."""
    root = _local(shared_folder(spark, "stages"))
    names = [r["r_name"] for r in _table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]
    made = [stages.Stage(n, lambda p, n=n: (root / n).write_text(str(p["data"][n])) and None, params=(f"data.{n}",), outs=(n,)) for n in names]
    last = stages.Stage("all", lambda p: (root / "all").write_text("".join((root / n).read_text() for n in names)) and None, deps=tuple(names), outs=("all",))
    params = {"data": dict.fromkeys(names, 1)}
    ran = {"first": stages.run([last, *made], params, str(root)), "nothing": stages.run([last, *made], params, str(root))}
    params["data"][names[0]] = 2
    ran["changed"] = stages.run([last, *made], params, str(root))
    (root / names[-1]).unlink()
    ran["lost"] = stages.run([last, *made], params, str(root))
    return spark.createDataFrame([(k, s) for k, found in ran.items() for s in found], "round string, stage string")
