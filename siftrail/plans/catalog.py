"""Named queries over the sample tables, one or more for each operator, and SQL that says the same.

``events`` stand for ordered points of a recording (a user), ``orders`` for images and ``lineitem``
for their annotations; names, sentences and boxes are made from their columns by plain rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.functions import boxes, geo, logs
from siftrail.operators import annotations, frames, intervals, metrics, ordered, prepare
from siftrail.plans import registry, segments
from siftrail.sources import datasets, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
USER, BY_TIME = ["user_id"], ["ts", "event_id"]
AREA = (52.02, 10.01, 52.05, 10.05)


def _query(sql: str | None) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as points: offset, speed, and a position made from id and value."""
    e = _table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withColumn("lat", 52 + (F.col("event_id") % 1000) / 10000 + F.col("value") / 100000).withColumn("lon", 10 + (F.col("event_id") % 777) / 10000)
    return ordered.first_offset(ordered.dealt(e, USER), USER, BY_TIME, "ts")


_POINTS_SQL = """
    pts AS (SELECT event_id, ts, user_id, event_type, value,
                   52 + (event_id % 1000) / 10000 + value / 100000 AS lat, 10 + (event_id % 777) / 10000 AS lon,
                   epoch_us(ts) - first_value(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS offset_us
            FROM events)"""


def _islands_sql(active: str, name: str, more: str = "") -> str:
    return f"""
    {name}_m AS (SELECT *, coalesce({active}, false) AS is_on FROM pts),
    {name}_r AS (SELECT *, sum(CASE WHEN is_on THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM {name}_m),
    {name} AS (SELECT user_id, min(offset_us) AS start_us, max(offset_us) AS end_us, count(*) AS n {more}
               FROM {name}_r WHERE is_on GROUP BY user_id, isl)"""


def _slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.islands(_points(spark, sf_dir), USER, BY_TIME, F.col("value") <= 60, "offset_us")


_SLOW = _islands_sql("value <= 60", "slow")
_QUIET = _islands_sql("event_type <> 'error'", "quiet")


@_query(f"WITH {_POINTS_SQL}, {_islands_sql('value <= 60', 'slow', ', round(sum(value), 2) AS value_sum')} SELECT * FROM slow WHERE n >= 2")
def islands_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    return ordered.islands(points, USER, BY_TIME, F.col("value") <= 60, "offset_us", F.round(F.sum("value"), 2).alias("value_sum")).where("n >= 2")


_BOX = ", min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max"


@_query(f"""
    WITH {_POINTS_SQL}, {_islands_sql(f'value <= 60 AND NOT (lat BETWEEN {AREA[0]} AND {AREA[2]} AND lon BETWEEN {AREA[1]} AND {AREA[3]})', 'runs', _BOX)},
    wide AS (SELECT *, {geo.distance_sql('lat_min', 'lon_min', 'lat_max', 'lon_max')} AS m FROM runs)
    SELECT user_id, start_us, end_us, n, round(m, 3) AS extent_m FROM wide WHERE end_us - start_us >= 60000000 AND m >= 500
""")
def islands_geofence(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = [f(c).alias(f"{c}_{n}") for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))]
    active = (F.col("value") <= 60) & ~geo.in_area(F.col("lat"), F.col("lon"), AREA)
    found = ordered.islands(_points(spark, sf_dir), USER, BY_TIME, active, "offset_us", *box).withColumn("m", segments.extent_m())
    kept = ordered.long_enough(found, 60_000_000, F.col("m"), 500.0)
    return kept.select("user_id", "start_us", "end_us", "n", F.round("m", 3).alias("extent_m"))


def _rate_sql(half: int) -> str:
    return f"""
    WITH {_POINTS_SQL},
    ahead AS (SELECT *, lead(offset_us) OVER w - offset_us AS us, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM pts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    steps AS (SELECT *, CASE WHEN us > 0 THEN us END AS step_us, CASE WHEN us > 0 THEN {geo.distance_sql('lat', 'lon', 'lat2', 'lon2')} END AS m FROM ahead),
    sums AS (SELECT user_id, event_id, sum(m) OVER f AS m, sum(step_us) OVER f AS us
             FROM steps WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {half} PRECEDING AND {half - 1} FOLLOWING))
    SELECT user_id, event_id, round(coalesce(m / (us / 1e6) * 3.6, 0), 4) AS speed_kmh FROM sums"""


def _rate(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    moving = segments.speeds(_points(spark, sf_dir), USER, BY_TIME, size)
    return moving.select("user_id", "event_id", F.round("speed_kmh", 4).alias("speed_kmh"))


@_query(_rate_sql(2))
def moving_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 5)


@_query(_rate_sql(2))
def moving_rate_even_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 4)


@_query("SELECT user_id, event_id, CAST(0 AS DOUBLE) AS speed_kmh FROM events")
def moving_rate_no_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 1)


@_query(f"WITH {_POINTS_SQL}, n AS (SELECT user_id FROM pts GROUP BY 1 HAVING count(*) >= 60) SELECT user_id, event_id, offset_us FROM pts WHERE user_id IN (SELECT user_id FROM n)")
def first_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.at_least(_points(spark, sf_dir), USER, 60).select("user_id", "event_id", "offset_us")


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = F.when(F.col("event_type").isin("click", "view"), "active").otherwise("idle")
    return _points(spark, sf_dir).withColumn("is_active", frames.is_class(top, F.col("value") / 100, "active", 0.1))


_HELD = f"""{_POINTS_SQL},
    st AS (SELECT *, event_type IN ('click', 'view') AND value / 100 >= 0.1 AS is_active FROM pts),
    ch AS (SELECT *, coalesce(lag(is_active) OVER w, false) AS before, row_number() OVER w AS rn FROM st WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    ru AS (SELECT *, is_active <> before AS sw, sum(CASE WHEN is_active <> before OR rn = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM ch),
    kk AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS k, bool_or(sw) OVER (PARTITION BY user_id, run) AS switched FROM ru),
    held AS (SELECT user_id, event_id, ts, offset_us, is_active FROM kk WHERE k >= CASE WHEN switched THEN greatest(@D + 1, 2) ELSE @D + 1 END)"""


@_query(f"WITH {_HELD.replace('@D', '1')} SELECT user_id, event_id, offset_us, is_active FROM held")
def debounce_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = ordered.debounce(_statuses(spark, sf_dir), USER, BY_TIME, "is_active", 1)
    return held.select("user_id", "event_id", "offset_us", "is_active")


@_query(f"WITH {_HELD.replace('@D', '0')} SELECT user_id, event_id, offset_us, is_active FROM held")
def debounce_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = ordered.debounce(_statuses(spark, sf_dir), USER, BY_TIME, "is_active", 0)
    return held.select("user_id", "event_id", "offset_us", "is_active")


_VISUAL = f"""{_HELD.replace('@D', '1')},
    tt AS (SELECT *, lag(is_active) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b, last_value(offset_us) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_us FROM held),
    te AS (SELECT *, coalesce(lead(offset_us) OVER (PARTITION BY user_id ORDER BY ts, event_id), last_us) AS end_us FROM tt WHERE b IS NULL OR b <> is_active),
    visual AS (SELECT user_id, offset_us AS start_us, end_us FROM te WHERE is_active AND end_us - offset_us >= 60000000)"""


@_query(f"WITH {_VISUAL} SELECT * FROM visual")
def status_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.visual_segments(_statuses(spark, sf_dir), USER, BY_TIME, 1, 60.0)


@_query(f"""
    WITH RECURSIVE {_POINTS_SQL},
    cand AS (SELECT user_id, offset_us // 1000000 AS at, min(event_id) AS event_id FROM pts WHERE value >= 20 GROUP BY 1, 2),
    pick AS (SELECT user_id, min(at) AS at FROM cand GROUP BY 1
             UNION ALL
             SELECT p.user_id, (SELECT min(c.at) FROM cand c WHERE c.user_id = p.user_id AND c.at >= p.at + 86400) FROM pick p WHERE p.at IS NOT NULL)
    SELECT user_id, at AS place, event_id FROM pick JOIN cand USING (user_id, at)
""".replace(" at", " moment").replace(".at", ".moment").replace("(at)", "(moment)"))
def greedy_min_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _points(spark, sf_dir).where("value >= 20").groupBy("user_id", F.expr("offset_us div 1000000").alias("place")).agg(F.min("event_id").alias("event_id"))
    return ordered.greedy_spacing(seen, USER, "place", 86_400)


@_query(f"""
    WITH {_POINTS_SQL}, {_SLOW}, {_QUIET}
    SELECT a.user_id, greatest(a.start_us, b.start_us) AS start_us, least(a.end_us, b.end_us) AS end_us
    FROM slow a JOIN quiet b ON a.user_id = b.user_id AND least(a.end_us, b.end_us) - greatest(a.start_us, b.start_us) >= 0
""")
def interval_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    quiet = ordered.islands(_points(spark, sf_dir), USER, BY_TIME, F.col("event_type") != "error", "offset_us")
    return intervals.intersect(_slow(spark, sf_dir), quiet, USER, 0)


@_query(f"""
    WITH {_POINTS_SQL}, {_SLOW}, {_QUIET}
    SELECT a.user_id, greatest(a.start_us, b.start_us) AS start_us, least(a.end_us, b.end_us) AS end_us
    FROM slow a JOIN quiet b ON a.user_id = b.user_id AND least(a.end_us, b.end_us) - greatest(a.start_us, b.start_us) >= -3600000000
""")
def interval_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    quiet = ordered.islands(_points(spark, sf_dir), USER, BY_TIME, F.col("event_type") != "error", "offset_us")
    return intervals.intersect(_slow(spark, sf_dir), quiet, USER, -3_600_000_000)


@_query(f"""
    WITH {_POINTS_SQL}, {_SLOW}
    SELECT p.user_id, p.event_id, s.start_us, s.end_us FROM pts p JOIN slow s ON p.user_id = s.user_id AND p.offset_us BETWEEN s.start_us AND s.end_us
""")
def segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _points(spark, sf_dir).select("user_id", "event_id", "offset_us")
    return intervals.rows_inside(rows, _slow(spark, sf_dir).select("user_id", "start_us", "end_us"), USER).select("user_id", "event_id", "start_us", "end_us")


@_query(f"""
    WITH {_VISUAL}, {_SLOW}, gate AS (SELECT DISTINCT user_id FROM slow WHERE n >= 8)
    SELECT user_id, start_us, end_us FROM visual WHERE user_id IN (SELECT user_id FROM gate)
    UNION ALL SELECT user_id, start_us, end_us FROM slow WHERE user_id NOT IN (SELECT user_id FROM gate)
""")
def gate_then_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    slow = _slow(spark, sf_dir)
    seen = intervals.gated(_statuses(spark, sf_dir), slow.where("n >= 8"), USER)
    return intervals.replaced(slow, segments.visual_segments(seen, USER, BY_TIME, 1, 60.0), seen, USER)


@_query(f"""
    WITH {_POINTS_SQL}, {_SLOW},
    num AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_us, end_us) - 1 AS seg_idx FROM slow)
    SELECT user_id, CAST(seg_idx AS INTEGER) AS seg_idx, 'user' || user_id || '_segment_' || CASE WHEN seg_idx < 1000 THEN lpad(CAST(seg_idx AS VARCHAR), 3, '0') ELSE CAST(seg_idx AS VARCHAR) END || '.log' AS name,
           start_us / 1e6 AS seek_s, (end_us - start_us) / 1e6 AS keep_s
    FROM num WHERE start_us >= 0 AND end_us - start_us > 0
""")
def segment_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = intervals.cut_list(ordered.number(_slow(spark, sf_dir), USER))
    name = intervals.segment_name(F.concat(F.lit("user"), "user_id"), F.col("seg_idx"), F.lit(".log"))
    return cuts.select("user_id", "seg_idx", name.alias("name"), "seek_s", "keep_s")


# Text of logs, names and labels.

_SENTENCE = """CASE WHEN event_id % 11 = 0 THEN '$GNGGA' ELSE '$GPGGA' END || ',061233.00,' ||
    CASE WHEN event_id % 13 = 0 THEN '' ELSE lpad(CAST(event_id % 90 AS VARCHAR), 2, '0') || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || '.' || CAST(event_id % 1000 AS VARCHAR) END ||
    CASE WHEN event_id % 2 = 0 THEN ',N,' ELSE ',S,' END || '0' || lpad(CAST(event_id % 80 AS VARCHAR), 2, '0') || '30.5' ||
    CASE WHEN event_id % 3 = 0 THEN ',E,' ELSE ',W,' END || CASE WHEN event_id % 7 = 0 THEN 'x' ELSE CAST(event_id % 3 AS VARCHAR) END || ',04'"""


@_query(f"""
    WITH s AS (SELECT event_id, string_split({_SENTENCE}, ',') AS f FROM events),
    q AS (SELECT event_id, f, CASE WHEN regexp_full_match(f[7], '[0-9]+') THEN CAST(f[7] AS INTEGER) ELSE 0 END AS quality FROM s WHERE f[1] = '$GPGGA'),
    d AS (SELECT event_id, quality, try_cast(regexp_extract(f[3], '^(\\d*)(\\d{{2}}\\.\\d*)$', 1) AS DOUBLE) + try_cast(regexp_extract(f[3], '^(\\d*)(\\d{{2}}\\.\\d*)$', 2) AS DOUBLE) / 60 AS lat,
                 CASE WHEN f[4] = 'S' THEN -1.0 ELSE 1.0 END AS ns,
                 try_cast(regexp_extract(f[5], '^(\\d*)(\\d{{2}}\\.\\d*)$', 1) AS DOUBLE) + try_cast(regexp_extract(f[5], '^(\\d*)(\\d{{2}}\\.\\d*)$', 2) AS DOUBLE) / 60 AS lon,
                 CASE WHEN f[6] = 'W' THEN -1.0 ELSE 1.0 END AS ew FROM q)
    SELECT event_id, quality, round(lat * ns, 7) AS lat, round(lon * ew, 7) AS lon FROM d WHERE quality > 0
""".replace("\\\\", "\\"))
def nmea_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("2025-07-17T14:11:13,772495840+02:00;"), F.expr(_SENTENCE.replace("VARCHAR", "STRING")))
    sentence = logs.split_line(line)[1]
    read = logs.with_fix(_table(spark, sf_dir, "events", "event_id").select("event_id", sentence.alias("sentence")), "sentence", "f")
    return read.where("f.quality > 0").select("event_id", "f.quality", F.round("f.lat", 7).alias("lat"), F.round("f.lon", 7).alias("lon"))


@_query("""
    WITH e AS (SELECT event_id, epoch_us(ts) AS us, event_id % 5 = 4 AS broken FROM events)
    SELECT event_id, CASE WHEN broken THEN NULL ELSE us - 7200000000 END AS us FROM e
""")
def log_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    text = F.concat(F.date_format(ts, "yyyy-MM-dd"), F.when(F.col("event_id") % 5 == 4, "x").otherwise("T"), F.date_format(ts, "HH:mm:ss,SSSSSS"), F.lit("789+02:00"))
    return _table(spark, sf_dir, "events", "event_id", "ts").select("event_id", F.unix_micros(logs.timestamp(text)).alias("us"))


_STAMP = "strftime(o_orderdate, '%Y-%m-%d') || '_12-00-' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')"


@_query(f"""
    WITH f AS (SELECT o_orderkey, o_orderdate, {_STAMP} AS stamp FROM orders),
    g AS (SELECT DISTINCT {_STAMP} AS stamp FROM orders WHERE o_orderkey % 3 = 0)
    SELECT o_orderkey, stamp AS prefix, stamp || '_video.mkv' AS video,
           epoch_us(timezone('Europe/Berlin', CAST(strptime(stamp, '%Y-%m-%d_%H-%M-%S') AS TIMESTAMP))) AS began_us
    FROM f WHERE stamp IN (SELECT stamp FROM g) AND o_orderkey % 7 <> 0
""")
def filename_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_12-00-"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"))
    video = o.select("o_orderkey", F.concat(stamp, F.when(F.col("o_orderkey") % 7 == 0, "_video.MKV").otherwise("_video.mkv")).alias("name"))
    named = video.withColumn("prefix", logs.recording_prefix(F.col("name"))).where("prefix IS NOT NULL")
    log = o.where("o_orderkey % 3 = 0").select(stamp.alias("prefix")).distinct()
    return named.join(log, "prefix").select("o_orderkey", "prefix", F.col("name").alias("video"), F.unix_micros(logs.recording_time(F.col("name"))).alias("began_us"))


@_query("""
    WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame_no FROM events)
    SELECT user_id, event_id, frame_no FROM r WHERE frame_no % 12 = 0
""")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = ordered.number(_table(spark, sf_dir, "events", "user_id", "event_id", "ts").select("*", F.col("ts").alias("start_us"), F.col("event_id").alias("end_us")), USER, "i")
    return frames.every_nth(numbered.withColumn("frame_no", (F.col("i") + 1).cast("bigint")), "frame_no", 0.5, 25.0).select("user_id", "event_id", "frame_no")


@_query("""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey % 100 AS w100 FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_partkey % 10 <> 0)
    SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS INTEGER) AS class_id, CASE WHEN l_partkey % 10 = 2 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS xc, CAST(0.25 AS DOUBLE) AS yc, w100 / 100.0 AS w, CAST(0.125 AS DOUBLE) AS h FROM t
""".replace("w100 / 100.0", "CAST(w100 AS DOUBLE) / 100"))
def label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    text = F.concat(
        F.when(F.col("l_orderkey") % 9 == 0, "junk").when(F.col("l_orderkey") % 9 == 1, "  ").otherwise(""), F.col("l_linenumber").cast("string"), F.when(F.col("l_partkey") % 10 == 2, " x").otherwise(" 0.5"),
        F.when(F.col("l_partkey") % 10 == 0, "").otherwise("\t0.25  "), (F.col("l_suppkey") % 100 / 100).cast("string"), F.lit(" 0.125"),
        F.when(F.col("l_partkey") % 10 == 1, " 0.7 0.8 0.9").otherwise(""),
    )
    rows = lines.select("l_orderkey", "l_linenumber", text.alias("value"))
    return datasets.label_rows(rows).select("l_orderkey", "l_linenumber", "class_id", "xc", "yc", "w", "h")


# Annotations: orders are images, lineitem their labels.

_CLASSES = [(0, "A"), (1, "N")]
_IMAGES_SQL = """
    images AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'train' WHEN 'F' THEN 'val' ELSE 'test' END AS split, o_orderkey AS path, o_orderkey AS stem FROM orders),
    labels AS (SELECT i.split, l.l_orderkey AS stem, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 7 END AS class_id, l_quantity / 100 AS w, l_discount + 0.01 AS h
               FROM lineitem l JOIN images i ON l.l_orderkey = i.stem),
    classes AS (SELECT * FROM (VALUES (0, 'A'), (1, 'N')) c(class_id, class_name)),
    known AS (SELECT i.split, i.path, class_id, class_name, (w * 1280) * (h * 720) AS area FROM images i JOIN labels l ON i.split = l.split AND i.stem = l.stem JOIN classes USING (class_id)),
    sized AS (SELECT *, CASE WHEN area < 1024 THEN 'small' WHEN area < 9216 THEN 'medium' ELSE 'large' END AS size FROM known)"""


def _dataset(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    o = _table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    split = F.when(F.col("o_orderstatus") == "O", "train").when(F.col("o_orderstatus") == "F", "val").otherwise("test")
    images = o.select(split.alias("split"), F.col("o_orderkey").alias("path"), F.col("o_orderkey").alias("stem"), F.lit(1280).alias("width"), F.lit(720).alias("height"))
    line = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_quantity", "l_discount")
    class_id = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(7)
    labels = line.select(F.col("l_orderkey").alias("stem"), class_id.alias("class_id"), (F.col("l_quantity") / 100).alias("w"), (F.col("l_discount") + 0.01).alias("h"))
    labels = labels.join(images.select("split", "stem"), "stem").select("split", "stem", "class_id", "w", "h")
    return images, labels, datasets.class_table(spark, dict(_CLASSES))


@_query(f"""
    WITH {_IMAGES_SQL} SELECT split, class_id, count(*) AS instances, count(*) FILTER (size = 'small') AS small, count(*) FILTER (size = 'medium') AS medium, count(*) FILTER (size = 'large') AS large
    FROM sized GROUP BY split, class_id
""")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, labels, classes = _dataset(spark, sf_dir)
    return annotations.class_counts(annotations.known(annotations.annotated(images, labels), classes))


@_query(f"WITH {_IMAGES_SQL} SELECT split, class_id, count(DISTINCT path) AS images FROM sized GROUP BY split, class_id")
def images_with_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, labels, classes = _dataset(spark, sf_dir)
    return annotations.images_with_class(annotations.known(annotations.annotated(images, labels), classes))


_TOTALS = f"""WITH {_IMAGES_SQL},
    per AS (SELECT i.split, i.path, count(l.class_id) AS n, count(c.class_id) AS n_known FROM images i LEFT JOIN labels l ON i.split = l.split AND i.stem = l.stem LEFT JOIN classes c ON l.class_id = c.class_id GROUP BY 1, 2),
    totals AS (SELECT split, count(*) AS images, count(*) FILTER (n = 0) AS empty_images, CAST(sum(n_known) AS BIGINT) AS objects FROM per GROUP BY ROLLUP (split))"""


@_query(f"{_TOTALS} SELECT split, images, empty_images, objects, round(empty_images / images * 100, 4) AS empty_pct FROM totals")
def split_totals_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations.split_totals(*_dataset(spark, sf_dir)).withColumn("empty_pct", F.round("empty_pct", 4))


_REPORT = f"""{_TOTALS},
    counts AS (SELECT split, class_id, count(*) AS instances, count(DISTINCT path) AS images_with_class, count(*) FILTER (size = 'small') AS small, count(*) FILTER (size = 'medium') AS medium, count(*) FILTER (size = 'large') AS large FROM sized GROUP BY 1, 2),
    report AS (SELECT t.split, c.class_id, c.class_name, coalesce(instances, 0) AS instances, coalesce(images_with_class, 0) AS images_with_class, coalesce(small, 0) AS small, coalesce(medium, 0) AS medium, coalesce(large, 0) AS large,
                      round(coalesce(coalesce(instances, 0) / nullif(objects, 0) * 100, 0), 4) AS instance_pct, round(coalesce(coalesce(images_with_class, 0) / nullif(images, 0) * 100, 0), 4) AS image_pct
               FROM totals t CROSS JOIN classes c LEFT JOIN counts n ON t.split = n.split AND c.class_id = n.class_id WHERE t.split IS NOT NULL)"""


@_query(f"{_REPORT} SELECT * FROM report")
def class_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = annotations.class_report(*_dataset(spark, sf_dir))
    return report.withColumns({c: F.round(c, 4) for c in ("instance_pct", "image_pct")})


@_query(f"{_REPORT}, o AS (SELECT class_id, class_name, CAST(sum(instances) AS BIGINT) AS total_instances FROM report GROUP BY 1, 2) SELECT *, round(coalesce(total_instances / nullif((SELECT sum(total_instances) FROM o), 0) * 100, 0), 4) AS percentage FROM o")
def overall_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations.overall_classes(annotations.class_report(*_dataset(spark, sf_dir))).withColumn("percentage", F.round("percentage", 4))


@_query(f"WITH {_IMAGES_SQL} SELECT split, path FROM images i WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.stem = i.stem AND l.split = i.split)")
def empty_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, labels, _ = _dataset(spark, sf_dir)
    return annotations.annotated(images, labels).where("class_id IS NULL").select("split", "path")


@_query(f"""{_TOTALS}, {_REPORT.split(_TOTALS)[1].strip().lstrip(',')}
    SELECT (SELECT images FROM totals WHERE split IS NULL) AS total_images, (SELECT objects FROM totals WHERE split IS NULL) AS total_objects, split, class_name, instances FROM report""")
def report_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = annotations.report_document(*_dataset(spark, sf_dir), "sample")
    text = one.select(F.from_json(F.to_json(F.struct("*")), one.schema.simpleString()).alias("r"))
    each = text.select(F.col("r.summary").alias("s"), F.explode("r.splits").alias("split", "d")).select("s", "split", F.explode("d.classes").alias("c"))
    return each.select("s.total_images", "s.total_objects", "split", "c.class_name", F.col("c.total_instances").alias("instances"))


@_query("""
    WITH l AS (SELECT page_id, 'split' || page_id % 7 AS split, page_id % 3 = 0 AS flat FROM pages),
    r AS (SELECT *, rank() OVER (PARTITION BY split ORDER BY flat DESC) AS r FROM l)
    SELECT page_id, split, flat FROM r WHERE r = 1
""")
def split_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _table(spark, sf_dir, "pages", "page_id").select("page_id", F.concat(F.lit("split"), F.col("page_id") % 7).alias("split"), (F.col("page_id") % 3 == 0).alias("flat"))
    return datasets.first_choice(listed, ["split"], F.col("flat").cast("int"))


@_query("""
    SELECT l_orderkey, l_linenumber, CAST(trunc((x - w / 2) * 1280) AS INTEGER) AS x1, CAST(trunc((y - h / 2) * 720) AS INTEGER) AS y1, CAST(trunc((x + w / 2) * 1280) AS INTEGER) AS x2, CAST(trunc((y + h / 2) * 720) AS INTEGER) AS y2
    FROM (SELECT l_orderkey, l_linenumber, l_discount * 5 AS x, l_tax * 5 AS y, l_quantity / 100 AS w, l_quantity / 50 AS h FROM lineitem)
""")
def bbox_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity")
    box = boxes.pixel_box(F.col("l_discount") * 5, F.col("l_tax") * 5, F.col("l_quantity") / 100, F.col("l_quantity") / 50, F.lit(1280), F.lit(720))
    return line.select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", "b.*")


@_query("""
    WITH d AS (SELECT l_orderkey AS k, printf('%d %.6f %.6f %.6f %.6f', l_linenumber, l_discount, l_tax, l_quantity / 64, 0.5) AS line FROM lineitem)
    SELECT 'v' || k % 10 || '_frame_' || lpad(CAST(k AS VARCHAR), CAST(greatest(6, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS name, string_agg(line, chr(10) ORDER BY line) AS content FROM d GROUP BY k
""")
def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity")
    found = line.select(F.concat(F.lit("v"), F.col("l_orderkey") % 10).alias("video"), F.col("l_orderkey").alias("frame_idx"), F.col("l_linenumber").alias("class_id"), F.array("l_discount", "l_tax", F.col("l_quantity") / 64, F.lit(0.5)).alias("bbox"))
    return frames.label_files(found, "video", "frame_idx")


# Frames and detections: a user's day is a frame, its events are detections.

_STATS_SQL = """
    f AS (SELECT user_id, day(ts) AS frame_idx, value / 500 AS confidence FROM events),
    stats AS (SELECT user_id, CAST(frame_idx AS INTEGER) AS frame_idx, count(*) FILTER (confidence >= 0.1) AS detection_count, list(confidence ORDER BY confidence) FILTER (confidence >= 0.1) AS confidences FROM f GROUP BY 1, 2)"""


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "events", "user_id", "ts", "value").select("user_id", F.dayofmonth("ts").alias("frame_idx"), (F.col("value") / 500).alias("confidence"))
    return frames.frame_stats(found.select("user_id", "frame_idx"), found, ["user_id", "frame_idx"], 0.1)


@_query(f"WITH {_STATS_SQL} SELECT user_id, frame_idx, detection_count, round(list_sum(confidences), 4) AS confidence_sum FROM stats".replace("list_sum(confidences)", "coalesce(list_sum(confidences), 0)"))
def frame_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate("confidences", F.lit(0.0), lambda a, x: a + x)
    return _stats(spark, sf_dir).select("user_id", "frame_idx", "detection_count", F.round(total, 4).alias("confidence_sum"))


@_query(f"""
    WITH {_STATS_SQL}, c AS (SELECT unnest(confidences) AS x FROM stats), s AS (SELECT * FROM stats WHERE detection_count >= 3)
    SELECT (SELECT count(*) FROM stats) AS frames, (SELECT CAST(sum(detection_count) AS BIGINT) FROM stats) AS detections, (SELECT min(detection_count) FROM stats) AS count_min, (SELECT max(detection_count) FROM stats) AS count_max,
           round((SELECT avg(detection_count) FROM stats), 6) AS count_avg, (SELECT min(x) FROM c) AS confidence_min, (SELECT max(x) FROM c) AS confidence_max, round((SELECT avg(x) FROM c), 6) AS confidence_avg,
           (SELECT count(*) FROM s) AS selected, (SELECT min(detection_count) FROM s) AS selected_min, (SELECT max(detection_count) FROM s) AS selected_max, round((SELECT avg(detection_count) FROM s), 6) AS selected_avg
""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _stats(spark, sf_dir)
    one = frames.count_summary(stats, stats.where("detection_count >= 3"))
    return one.withColumns({c: F.round(c, 6) for c in ("count_avg", "confidence_avg", "selected_avg")})


@_query(f"""
    WITH RECURSIVE {_STATS_SQL}, c AS (SELECT user_id, frame_idx FROM stats WHERE detection_count >= 2),
    p AS (SELECT user_id, min(frame_idx) AS frame_idx FROM c GROUP BY 1 UNION ALL
          SELECT p.user_id, (SELECT min(c.frame_idx) FROM c WHERE c.user_id = p.user_id AND c.frame_idx >= p.frame_idx + 4) FROM p WHERE p.frame_idx IS NOT NULL)
    SELECT user_id, frame_idx, 'u' || user_id || '_frame_' || lpad(CAST(frame_idx AS VARCHAR), 6, '0') AS name FROM p WHERE frame_idx IS NOT NULL
""")
def pick_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = frames.pick_frames(_stats(spark, sf_dir).select("user_id", "frame_idx", "detection_count"), "user_id", "frame_idx", 2, 4)
    return picked.select("user_id", "frame_idx", frames.frame_name(F.concat(F.lit("u"), "user_id"), F.col("frame_idx")).alias("name"))


def _auto_sql(source: str, whole: bool) -> str:
    width = "least(greatest(2 * (q3 - q1) * pow(n, -1.0 / 3), (hi - lo) / sqrt(n) / 2), (hi - lo) / (log2(n) + 1))"
    if whole:
        width = f"greatest({width}, 1.0)"
    return f"""
    v AS ({source}),
    s AS (SELECT count(x) AS n, CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi, quantile_cont(CAST(x AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(x AS DOUBLE), 0.75) AS q3 FROM v),
    b AS (SELECT lo, hi, CAST(ceil((hi - lo) / ({width})) AS INTEGER) AS k FROM s),
    c AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / k)), k - 1) AS INTEGER) AS bin, count(*) AS n FROM v, b GROUP BY 1)
    SELECT CAST(r.i AS INTEGER) AS bin, round(lo + r.i * ((hi - lo) / k), 6) AS low, round(lo + (r.i + 1) * ((hi - lo) / k), 6) AS high, coalesce(c.n, 0) AS n
    FROM b, range(b.k) r(i) LEFT JOIN c ON c.bin = r.i"""


def _rounded(h: DataFrame) -> DataFrame:
    return h.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@_query("WITH " + _auto_sql("SELECT value AS x FROM events", False))
def hist_1d_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(frames.histogram(_table(spark, sf_dir, "events", "value"), "value"))


@_query(f"WITH {_STATS_SQL}, " + _auto_sql("SELECT detection_count AS x FROM stats", True))
def hist_1d_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(frames.histogram(_stats(spark, sf_dir), "detection_count"))


@_query(f"WITH {_STATS_SQL}, c AS (SELECT detection_count AS count, unnest(confidences) AS x FROM stats) SELECT count, CAST(least(floor(x * 10), 9) AS INTEGER) AS part, count(*) AS n FROM c WHERE x BETWEEN 0 AND 1 GROUP BY 1, 2")
def hist_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _stats(spark, sf_dir).select("detection_count", F.explode("confidences").alias("confidence"))
    return frames.histogram_2d(flat, "detection_count", "confidence")


@_query("SELECT event_type AS video, count(*) AS n_frames, CAST(sum(user_id) AS BIGINT) AS checksum FROM events GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders GROUP BY 1")
def union_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _table(spark, sf_dir, "events").select(F.col("event_type").alias("video"), F.col("user_id").alias("frame"))
    b = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("frame"), F.col("o_orderpriority").alias("video"))
    return a.unionByName(b).groupBy("video").agg(F.count("*").alias("n_frames"), F.sum("frame").alias("checksum"))


# Preparation.


@_query("SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 END AS target FROM events WHERE event_type IN ('click', 'view', 'error', 'purchase')")
def class_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"look": ["click", "view"], "error": ["error"], "buy": ["purchase"]}
    merged = prepare.merge_classes(_table(spark, sf_dir, "events", "event_id", "event_type"), "event_type", ["click", "view", "error", "purchase", "signup"], mapping, by_name=True)
    return merged.select("event_id", "target")


_SHARE = "CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT) / 4294967296.0"


@_query(f"WITH s AS (SELECT doc_id, {_SHARE.format(seed=42, key='doc_id')} AS at_share FROM documents) SELECT doc_id, CASE WHEN at_share < 0.1 THEN 'test' WHEN at_share < 0.2 THEN 'val' ELSE 'train' END AS split FROM s")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.hash_split(_table(spark, sf_dir, "documents", "doc_id"), "doc_id", 0.1, 0.1)


@_query(f"WITH s AS (SELECT doc_id, {_SHARE.format(seed=42, key='doc_id')} AS at_share FROM documents) SELECT doc_id, CASE WHEN at_share < 0.1 THEN 'val' ELSE 'train' END AS split FROM s")
def hash_split_with_test_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.hash_split(_table(spark, sf_dir, "documents", "doc_id"), "doc_id", 0.1, 0.1, has_test=True)


@_query(f"""
    WITH w AS (SELECT doc_id, source, CASE source WHEN 'src0' THEN 0 WHEN 'src1' THEN 0.25 WHEN 'src2' THEN 1.5 WHEN 'src3' THEN 2.0 ELSE 1 END AS w, {_SHARE.format(seed='weight 42', key='doc_id')} AS s FROM documents),
    n AS (SELECT doc_id, source, CAST(floor(w) + CASE WHEN s < w - floor(w) THEN 1 ELSE 0 END AS INTEGER) AS n FROM w)
    SELECT doc_id, source, CAST(c AS INTEGER) AS copy, CAST(v AS INTEGER) AS variant FROM n, range(2) r(v), LATERAL (SELECT unnest(range(n.n)) AS c) x
""")
def folder_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = prepare.folder_weights(_table(spark, sf_dir, "documents", "doc_id", "source"), "source", "doc_id", {"src0": 0, "src1": 0.25, "src2": 1.5, "src3": 2.0})
    return prepare.multiplied(weighed, 2).select("doc_id", "source", "copy", "variant")


_MODELS = [("m1", "yolo", 640, None), ("m2", "yolo", None, None), ("m3", "rfdetr", None, 150), ("m4", "rtmdet", None, None)]
_DEFAULTS = [("yolo", None, 90), ("rfdetr", 1280, 80)]


@_query("""
    WITH m AS (SELECT * FROM (VALUES ('m1', 'yolo', 640, NULL), ('m2', 'yolo', NULL, NULL), ('m3', 'rfdetr', NULL, 150), ('m4', 'rtmdet', NULL, NULL)) t(model_key, backend, image_size, epochs)),
    d AS (SELECT * FROM (VALUES ('yolo', NULL, 90), ('rfdetr', 1280, 80)) t(backend, image_size, epochs))
    SELECT model_key, m.backend, coalesce(m.image_size, d.image_size, 320) AS image_size, coalesce(m.epochs, d.epochs, 100) AS epochs FROM m LEFT JOIN d ON m.backend = d.backend
""")
def config_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = spark.createDataFrame(_MODELS, "model_key string, backend string, image_size int, epochs int")
    defaults = spark.createDataFrame(_DEFAULTS, "backend string, image_size int, epochs int")
    return registry.precedence(models, defaults, {"image_size": 320, "epochs": 100}, ["image_size", "epochs"])


@_query("""
    WITH e AS (SELECT user_id AS exp, round(avg(value), 6) AS fitness FROM events GROUP BY 1),
    old AS (SELECT user_id AS exp, CAST(count(*) AS DOUBLE) AS fitness FROM events WHERE user_id % 2 = 0 GROUP BY 1)
    SELECT * FROM e WHERE exp % 3 = 0 UNION ALL SELECT * FROM old WHERE exp % 3 <> 0
""")
def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events", "user_id", "value").withColumnRenamed("user_id", "exp")
    new = e.where("exp % 3 = 0").groupBy("exp").agg(F.round(F.avg("value"), 6).alias("fitness"))
    old = e.where("exp % 2 = 0").groupBy("exp").agg(F.count("*").cast("double").alias("fitness"))
    return registry.upserted(old, new, "exp")


# Metrics: lineitem boxes are labels, and shifted ones predictions.

_BOXES_SQL = """
    labels AS (SELECT l_orderkey AS image, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100000 + l_suppkey AS label_id, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS class_id,
                      (l_partkey % 10) / 10 AS xc, (l_suppkey % 10) / 10 AS yc, 0.2 + l_discount AS w, 0.2 + l_tax AS h, l_quantity FROM lineitem),
    preds AS (SELECT image, label_id AS pred_id, CASE WHEN label_id % 6 = 5 THEN (class_id + 1) % 3 ELSE class_id END AS class_id, (l_quantity * 7 + image) % 97 / 97 AS confidence,
                     xc + (image % 5) / 50 AS xc, yc, w, h * (1 + (image % 3) / 4) AS h FROM labels WHERE label_id % 4 <> 0),
    pairs AS (SELECT p.image, p.class_id, p.pred_id, p.confidence, l.label_id,
                     greatest(least(p.xc + p.w / 2, l.xc + l.w / 2) - greatest(p.xc - p.w / 2, l.xc - l.w / 2), 0.0) * greatest(least(p.yc + p.h / 2, l.yc + l.h / 2) - greatest(p.yc - p.h / 2, l.yc - l.h / 2), 0.0) AS both_area,
                     p.w * p.h AS pa, l.w * l.h AS la FROM preds p JOIN labels l ON p.image = l.image AND p.class_id = l.class_id),
    over AS (SELECT *, round(coalesce(both_area / nullif(pa + la - both_area, 0), 0), 9) AS overlap FROM pairs),
    best AS (SELECT * FROM over WHERE overlap >= 0.5 QUALIFY row_number() OVER (PARTITION BY image, class_id, pred_id ORDER BY overlap DESC, label_id) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY image, class_id, label_id ORDER BY confidence DESC, pred_id) AS r FROM best),
    judged AS (SELECT p.image, p.class_id, p.pred_id, p.confidence, r.label_id, round(r.overlap, 6) AS overlap, coalesce(r.r = 1, false) AS is_tp FROM preds p LEFT JOIN ranked r USING (image, class_id, pred_id))""".replace("over AS", "ovl AS").replace("FROM over", "FROM ovl")


def _boxes(spark: SparkSession, sf_dir: str, crowd: int = 1) -> tuple[DataFrame, DataFrame]:
    """Predictions and labels: an order is an image, or ``crowd`` neighbouring order keys are one of small boxes."""
    scale = 1 if crowd == 1 else 8
    line = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_quantity")
    class_id = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    own = F.col("l_linenumber").cast("bigint") * 10_000_000_000 + F.col("l_partkey") * 100_000 + F.col("l_suppkey") if crowd == 1 else (F.col("l_orderkey") % crowd * 8 + F.col("l_linenumber")) * 10_000_000_000 + F.col("l_partkey") * 100_000 + F.col("l_suppkey")
    image = F.col("l_orderkey") if crowd == 1 else F.expr(f"l_orderkey div {crowd}")
    full = line.select(image.alias("image"), own.alias("label_id"), class_id.alias("class_id"), (F.col("l_partkey") % 10 / 10).alias("xc"), (F.col("l_suppkey") % 10 / 10).alias("yc"), ((0.2 + F.col("l_discount")) / scale).alias("w"), ((0.2 + F.col("l_tax")) / scale).alias("h"), "l_quantity")
    moved = full.where("label_id % 4 <> 0").select("image", F.col("label_id").alias("pred_id"), F.when(F.col("label_id") % 6 == 5, (F.col("class_id") + 1) % 3).otherwise(F.col("class_id")).alias("class_id"), ((F.col("l_quantity") * 7 + F.col("image")) % 97 / 97).alias("confidence"), (F.col("xc") + F.col("image") % 5 / (50 * scale)).alias("xc"), "yc", "w", (F.col("h") * (1 + F.col("image") % 3 / 4)).alias("h"))
    return moved, full.drop("l_quantity")


@_query(f"WITH {_BOXES_SQL} SELECT * FROM judged")
def iou_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.matches(*_boxes(spark, sf_dir), ["image"]).withColumn("overlap", F.round("overlap", 6))


_CROWDED = _BOXES_SQL.replace("l_orderkey AS image", "l_orderkey // 400 AS image").replace("CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100000 + l_suppkey AS label_id", "(l_orderkey % 400 * 8 + l_linenumber) * 10000000000 + l_partkey * 100000 + l_suppkey AS label_id").replace("0.2 + l_discount AS w, 0.2 + l_tax AS h", "(0.2 + l_discount) / 8 AS w, (0.2 + l_tax) / 8 AS h").replace("/ 50 AS xc", "/ 400 AS xc").split("best AS")[0].rstrip().rstrip(",")


@_query(f"""
    WITH RECURSIVE {_CROWDED},
    cand AS (SELECT image, class_id, pred_id, list(label_id ORDER BY overlap DESC, label_id) AS cands FROM ovl WHERE overlap >= 0.5 GROUP BY ALL),
    turn AS (SELECT p.image, p.class_id, p.pred_id, coalesce(cands, []) AS cands, row_number() OVER (PARTITION BY p.image, p.class_id ORDER BY p.confidence DESC, p.pred_id) AS k FROM preds p LEFT JOIN cand USING (image, class_id, pred_id)),
    took AS (SELECT image, class_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS pred_id, CAST(NULL AS BIGINT) AS label_id, CAST([] AS BIGINT[]) AS used FROM turn GROUP BY ALL
             UNION ALL
             SELECT t.image, t.class_id, t.k, t.pred_id, list_filter(t.cands, lambda x: NOT list_contains(g.used, x))[1],
                    CASE WHEN len(list_filter(t.cands, lambda x: NOT list_contains(g.used, x))) > 0 THEN list_append(g.used, list_filter(t.cands, lambda x: NOT list_contains(g.used, x))[1]) ELSE g.used END
             FROM took g JOIN turn t ON t.image = g.image AND t.class_id = g.class_id AND t.k = g.k + 1)
    SELECT image, class_id, pred_id, label_id, label_id IS NOT NULL AS is_tp FROM took WHERE k > 0
""")
def iou_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12 in crowded images: predictions take free labels in order of confidence; pairs come from a grid."""
    return metrics.assigned(*_boxes(spark, sf_dir, 400), ["image"]).select("image", "class_id", "pred_id", "label_id", "is_tp")


_AP_SQL = f"""{_BOXES_SQL},
    totals AS (SELECT class_id, count(*) AS n_labels FROM labels GROUP BY 1),
    pts AS (SELECT class_id, confidence, count(*) FILTER (is_tp) AS tp, count(*) FILTER (NOT is_tp) AS fp FROM judged GROUP BY 1, 2),
    cum AS (SELECT class_id, confidence, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp FROM pts WINDOW w AS (PARTITION BY class_id ORDER BY confidence DESC)),
    rated AS (SELECT class_id, confidence, tp, fp, n_labels, tp / n_labels AS recall, tp / (tp + fp) AS prec FROM cum JOIN totals USING (class_id)),
    env AS (SELECT *, max(prec) OVER (PARTITION BY class_id ORDER BY confidence) AS envelope, recall - coalesce(lag(recall) OVER (PARTITION BY class_id ORDER BY confidence DESC), 0) AS gained FROM rated)"""


@_query(f"WITH {_AP_SQL} SELECT class_id, confidence, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(recall, 6) AS recall, round(prec, 6) AS precision, round(envelope, 6) AS envelope FROM env")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds, labels = _boxes(spark, sf_dir)
    points = metrics.curve(metrics.matches(preds, labels, ["image"]), labels.groupBy("class_id").agg(F.count("*").alias("n_labels")), ["class_id"])
    return points.select("class_id", "confidence", "tp", "fp", *[F.round(c, 6).alias(c) for c in ("recall", "precision", "envelope")])


_AP_TABLE = f"""{_AP_SQL},
    area AS (SELECT class_id, sum(gained * envelope) AS ap FROM env GROUP BY 1),
    plain AS (SELECT class_id, count(*) FILTER (is_tp) AS tp, count(*) AS n FROM judged GROUP BY 1),
    pr AS (SELECT class_id, n_labels, coalesce(ap, 0) AS ap, coalesce(tp / n, 0) AS p, coalesce(tp / n_labels, 0) AS r FROM totals LEFT JOIN area USING (class_id) LEFT JOIN plain USING (class_id))"""


@_query(f"WITH {_AP_TABLE} SELECT class_id, n_labels, round(ap, 6) AS ap, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM pr")
def pr_curve_ap(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds, labels = _boxes(spark, sf_dir)
    out = metrics.average_precision(metrics.matches(preds, labels, ["image"]), labels, ["class_id"])
    return out.withColumns({c: F.round(c, 6) for c in ("ap", "precision", "recall", "f1")})


@_query(f"""
    WITH {_AP_TABLE}, named AS (SELECT CASE class_id WHEN 0 THEN 'waste_as_waste' ELSE 'cigarette_as_waste' END AS s, * FROM pr WHERE class_id < 2)
    SELECT s || '_ap50' AS metric, round(ap, 6) AS value FROM named UNION ALL SELECT s || '_n_objects', CAST(n_labels AS DOUBLE) FROM named
""")
def merged_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds, labels = _boxes(spark, sf_dir)
    each = metrics.average_precision(metrics.matches(preds, labels, ["image"]), labels, ["class_id"])
    return metrics.merged_breakdown(each, {0: "waste", 1: "cigarette"}, {0: "waste", 1: "waste"}).withColumn("value", F.round("value", 6))


def _ap_at(threshold: float) -> str:
    table = _AP_TABLE.replace("overlap >= 0.5", f"overlap >= {threshold}")
    return f"SELECT * FROM (WITH {table} SELECT class_id, {threshold} AS t, ap FROM pr) x{round(threshold * 100)}"


@_query(f"""
    WITH each_t AS ({" UNION ALL ".join(map(_ap_at, (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)))})
    SELECT class_id, round(max(CASE WHEN t = 0.5 THEN ap END), 6) AS ap50, round(avg(ap), 6) AS ap FROM each_t GROUP BY class_id
""")
def mean_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.mean_over_thresholds(*_boxes(spark, sf_dir), ["image"])
    return out.select("class_id", F.round("ap50", 6).alias("ap50"), F.round("ap", 6).alias("ap"))


@_query("SELECT o_orderkey, o_orderkey % 7 / 10 AS pre, 1.5 AS inf, o_custkey % 3 / 10 AS post, o_orderkey % 7 / 10 + 1.5 + o_custkey % 3 / 10 AS ms_per_frame FROM orders".replace("1.5 AS inf", "CAST(1.5 AS DOUBLE) AS inf"))
def frame_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select("o_orderkey", (F.col("o_orderkey") % 7 / 10).alias("pre"), F.lit(1.5).alias("inf"), (F.col("o_custkey") % 3 / 10).alias("post"))
    return o.withColumn("ms_per_frame", metrics.total_ms("pre", "inf", "post"))


@_query("""
    WITH k AS (SELECT event_id AS key, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value / 500 END AS confidence, event_type = 'error' AS is_error, event_type = 'signup' AS is_empty, event_id % 11 AS age FROM events WHERE event_id % 5 <> 0),
    hard AS (SELECT key, CAST(age AS BIGINT) AS age FROM k WHERE is_error OR confidence < 0.35 OR is_empty ORDER BY CASE WHEN is_error THEN 0.0 WHEN is_empty THEN 2.0 ELSE confidence + 0.5 END, key LIMIT 200),
    both_sets AS (SELECT * FROM hard UNION ALL SELECT event_id, event_id % 13 + 1 FROM events WHERE event_id % 25 = 0)
    SELECT key, age FROM both_sets ORDER BY age, key LIMIT 300
""")
def replay_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events", "event_id", "event_type", "value")
    kind = F.col("event_type")
    found = e.where("event_id % 5 <> 0").select(F.col("event_id").alias("key"), F.when(~kind.isin("error", "signup"), F.col("value") / 500).alias("confidence"), (kind == "error").alias("is_error"), (kind == "signup").alias("is_empty"), (F.col("event_id") % 11).alias("age"))
    return prepare.replay(found, e.where("event_id % 25 = 0").select(F.col("event_id").alias("key"), (F.col("event_id") % 13 + 1).alias("age")), 200, 300, 0.35)


@_query("SELECT CAST(user_id AS VARCHAR) AS model, round(avg(value), 6) AS fitness FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _table(spark, sf_dir, "events", "user_id", "value").groupBy(F.col("user_id").cast("string").alias("model")).agg(F.round(F.avg("value"), 6).alias("fitness"))
    return metrics.leaderboard(scores, n=20)


@_query("""
    WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events)
    SELECT user_id, event_id, value, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3
""")
def hardest_per_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.top_by(_table(spark, sf_dir, "events", "user_id", "event_id", "value"), USER, [F.desc("value"), F.col("event_id")], 3)


@_query("""
    WITH a AS (SELECT l_returnflag AS class_name, round(avg(l_discount), 6) AS p FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT l_returnflag AS class_name, round(avg(l_discount), 6) AS p FROM lineitem WHERE l_orderkey % 2 = 1 AND l_returnflag <> 'R' GROUP BY 1)
    SELECT class_name, a.p, b.p AS baseline_p, round(a.p - b.p, 6) AS p_gain FROM a FULL JOIN b USING (class_name)
""")
def compared_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount").withColumnRenamed("l_returnflag", "class_name")
    one = lambda d: d.groupBy("class_name").agg(F.round(F.avg("l_discount"), 6).alias("p"))
    out = metrics.compared(one(line.where("l_orderkey % 2 = 0")), one(line.where("l_orderkey % 2 = 1 AND class_name <> 'R'")), ["class_name"], ["p"])
    return out.withColumn("p_gain", F.round("p_gain", 6))


@_query("""
    SELECT 'shared' AS what, count(*) AS n FROM (SELECT n_regionkey FROM nation INTERSECT SELECT r_regionkey FROM region WHERE r_regionkey <> 2)
    UNION ALL SELECT 'only_left', count(*) FROM (SELECT n_regionkey FROM nation EXCEPT SELECT r_regionkey FROM region WHERE r_regionkey <> 2)
    UNION ALL SELECT 'only_right', count(*) FROM (SELECT r_regionkey FROM region WHERE r_regionkey <> 2 EXCEPT SELECT n_regionkey FROM nation)
""")
def set_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _table(spark, sf_dir, "nation", "n_regionkey"), _table(spark, sf_dir, "region", "r_regionkey").where("r_regionkey <> 2")
    count = lambda df, what: df.agg(F.lit(what).alias("what"), F.count("*").alias("n"))
    return count(left.intersect(right), "shared").unionByName(count(left.subtract(right), "only_left")).unionByName(count(right.subtract(left), "only_right"))


@_query(f"""
    WITH {_POINTS_SQL}, {_SLOW}, num AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_us, end_us) - 1 AS i FROM slow WHERE n >= 3),
    hit AS (SELECT n.user_id, n.i, count(p.event_id) AS n_lines FROM num n LEFT JOIN pts p ON p.user_id = n.user_id AND p.offset_us BETWEEN n.start_us AND n.end_us AND p.event_type = 'error' GROUP BY 1, 2)
    SELECT 'u' || user_id || '_segment_' || lpad(CAST(i AS VARCHAR), 3, '0') || '.log' AS name, n_lines > 0 AS written, n_lines FROM hit
""")
def log_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.concat(F.lit("u"), F.col("user_id"), F.lit(".log")).alias("file")
    cut = ordered.number(_slow(spark, sf_dir).where("n >= 3"), USER).select(file, "seg_idx", "start_us", "end_us")
    lines = _points(spark, sf_dir).where("event_type = 'error'").select(file, F.col("event_id").alias("line_no"), F.col("event_type").alias("line"), "offset_us")
    named = sinks.log_segments(lines, cut)
    counts = named.groupBy("name").agg(F.count("*").alias("n_lines"))
    all_names = cut.select(intervals.segment_name(F.regexp_extract("file", r"^(.*)\.log$", 1), F.col("seg_idx"), F.lit(".log")).alias("name"))
    return sinks.segments_written(named, all_names).join(counts, "name", "left").select("name", "written", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


@_query("""
    SELECT page_id, length(html) AS size, md5(html) AS md5 FROM pages
""")
def content_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _table(spark, sf_dir, "pages", "page_id", "html").select(F.col("page_id").cast("string").alias("path"), F.col("html").cast("binary").alias("content"))
    found = registry.pointers(files)
    return found.select(F.col("path").cast("bigint").alias("page_id"), "size", "md5")


ORACLE_SQL["content_pointers"] = "SELECT page_id, octet_length(encode(html)) AS size, md5(html) AS md5 FROM pages"


@_query(f"WITH {_POINTS_SQL} SELECT user_id, event_id, lat, lon, lat BETWEEN {AREA[0]} AND {AREA[2]} AND lon BETWEEN {AREA[1]} AND {AREA[3]} AS inside FROM pts")
def geofence(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = geo.parse_area(f"{AREA[2]},{AREA[1]},{AREA[0]},{AREA[3]}")
    return _points(spark, sf_dir).select("user_id", "event_id", "lat", "lon", geo.in_area(F.col("lat"), F.col("lon"), turned).alias("inside"))
