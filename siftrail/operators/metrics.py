"""Detection metrics: one-to-one matches, precision and recall curves, comparisons of models.

The definitions are public ones and this library's choice. A prediction goes to the label of its
image and class that it overlaps best; of the predictions at one label the most confident is a true
positive and the others are false. Average precision is the area below the precision envelope.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type as pa_type

from siftrail.functions.boxes import iou
from siftrail.functions.session import importable
from siftrail.operators import ordered

BOX = ("xc", "yc", "w", "h")
STEPS = 1024
PAIRS = 1 << 18  # pairs of boxes looked at together
BUCKETS = 1 << 16  # of images and classes, by which boxes are counted
GROWTH = 2.000002  # a grid's cells over those of the next finer one: just over 2, so boxes that overlap by a half are one grid apart at most


def matches(predictions: DataFrame, labels: DataFrame, image: list[str], threshold: float = 0.5, least_confidence: float = 0.0) -> DataFrame:
    """(image, class_id, pred_id, confidence, label_id, overlap, is_tp) of every prediction.

    Predictions have (image, pred_id, class_id, confidence, box), labels (image, label_id,
    class_id, box). Overlaps are compared to nine decimals; ties go to the smaller id.
    """
    return matches_at(predictions, labels, image, (threshold,), least_confidence).drop("threshold")


def matches_at(predictions: DataFrame, labels: DataFrame, image: list[str], thresholds: tuple[float, ...], least_confidence: float = 0.0) -> DataFrame:
    """The rows of ``matches`` for each threshold; boxes are joined once for all of them."""
    preds = predictions.where(F.col("confidence") >= least_confidence)
    truth = labels.select(*image, "class_id", "label_id", *[F.col(c).alias(f"t_{c}") for c in BOX])
    overlap = F.round(iou(tuple(map(F.col, BOX)), tuple(F.col(f"t_{c}") for c in BOX)), 9)
    keys = [*image, "class_id"]
    met = ordered.dealt(preds, keys, truth).join(ordered.dealt(truth, keys, preds), keys, "left").withColumn("overlap", overlap)
    met = met.withColumn("overlap", F.when(F.col("overlap") >= min(map(float, thresholds)), F.col("overlap")))
    met = met.withColumn("label_id", F.when(F.col("overlap").isNotNull(), F.col("label_id")))
    # Both windows keep within an image and class, as the join has dealt the rows already. A prediction's best
    # label is the same at every threshold that their overlap reaches, so one pair of each goes on.
    by_pred = Window.partitionBy(*image, "class_id", "pred_id").orderBy(F.desc_nulls_last("overlap"), "label_id")
    best = met.withColumn("place", F.row_number().over(by_pred)).where("place = 1").withColumn("threshold", F.explode(_list(thresholds)))
    best = best.withColumn("overlap", F.when(F.col("overlap") >= F.col("threshold"), F.col("overlap"))).withColumn("label_id", F.when(F.col("overlap").isNotNull(), F.col("label_id")))
    by_label = Window.partitionBy(*image, "class_id", "threshold", "label_id").orderBy(F.desc("confidence"), "pred_id")
    first = F.col("label_id").isNotNull() & (F.row_number().over(by_label) == 1)
    return best.select("threshold", *image, "class_id", "pred_id", "confidence", "label_id", "overlap", first.alias("is_tp"))


def candidates(predictions: DataFrame, labels: DataFrame, image: list[str], least: float) -> DataFrame:
    """Pairs of a prediction and a label of one image and class that may overlap by ``least``, which is over 0.

    Boxes that overlap by a share t differ in their longer side by a factor of 1/t at most. So a box is dealt to the
    cells it covers of the grid whose cells are about as long as its longer side, and of the next coarser ones up to that
    factor; a pair meets in the grid of its larger box alone, in the cell that holds the lower corner of their
    overlap. An image of n boxes costs some n copies and the pairs of neighbours, not all pairs.
    """
    reach = math.ceil(math.log(1 / (least - 1e-9)) / math.log(GROWTH) + 1e-9)  # overlaps are compared to nine decimals

    def level(p: str = "") -> Column:
        return F.ceil(F.log(F.greatest(f"{p}w", f"{p}h")) / math.log(GROWTH)).cast("int")

    def edge(c: str, side: str, sign: int, p: str = "") -> Column:
        return F.col(f"{p}{c}") + sign * F.col(f"{p}{side}") / 2

    def cell(at: Column) -> Column:
        return F.floor(at / F.pow(F.lit(GROWTH), F.col("level")))

    def dealt(boxes: DataFrame) -> DataFrame:
        """Only the boxes themselves are exchanged; what follows from them is computed again where they meet."""
        longer = F.greatest("w", "h")
        out = boxes.where((longer > 0) & (longer < math.inf)).withColumn("level", F.explode(F.sequence(level(), level() + reach)))
        for name, c, side in (("cell_x", "xc", "w"), ("cell_y", "yc", "h")):
            out = out.withColumn(name, F.explode(F.sequence(cell(edge(c, side, -1)), cell(edge(c, side, 1)))))
        return out

    preds = dealt(predictions.select(*image, "class_id", "pred_id", "confidence", *BOX)).withColumnsRenamed({c: f"p_{c}" for c in BOX})
    truth = dealt(labels.select(*image, "class_id", "label_id", *BOX)).withColumnsRenamed({c: f"t_{c}" for c in BOX})
    met = preds.join(truth, [*image, "class_id", "level", "cell_x", "cell_y"])
    corner = lambda c, side: cell(F.greatest(edge(c, side, -1, "p_"), edge(c, side, -1, "t_")))
    once = (F.col("level") == F.greatest(level("p_"), level("t_"))) & (F.col("cell_x") == corner("xc", "w")) & (F.col("cell_y") == corner("yc", "h"))
    return met.where(once).select(*image, "class_id", "pred_id", "confidence", "label_id", *[f"{k}{c}" for k in ("p_", "t_") for c in BOX])


def _rounded(x: np.ndarray) -> np.ndarray:
    """To nine decimals, halves up, as Spark rounds what is printed of a double."""
    scaled = x * 1e9
    out = np.rint(scaled) / 1e9
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal("1e-9"), ROUND_HALF_UP))
    return out


def _overlapping(p: np.ndarray, t: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of boxes of ``p`` and of ``t``, columns of xc, yc, w and h, that overlap by ``least``, and by how much.

    The centres of boxes that overlap by a share s are at most (1 - s) / 2s of a side apart, so a box meets
    those of a stretch in order of xc. Boxes without a size, or that are no number, overlap nothing.
    """
    at_p, at_t = (np.flatnonzero(np.isfinite(x).all(0) & (x[2] > 0) & (x[3] > 0)) for x in (p, t))
    at_t = at_t[np.argsort(t[0, at_t], kind="stable")]
    p, t, share = p[:, at_p], t[:, at_t], least - 1e-9  # overlaps are compared to nine decimals
    near = [p[k + 2] * (1 - share) / (2 * share) + 1e-9 * (np.abs(p[k]) + p[k + 2]) for k in (0, 1)]
    lows = np.searchsorted(t[0], p[0] - near[0], "left")
    counts = np.maximum(np.searchsorted(t[0], p[0] + near[0], "right") - lows, 0)
    total = np.concatenate([[0], np.cumsum(counts)])
    found, a = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
    while a < len(counts):
        z = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(a, z), counts[a:z])
        j = np.arange(total[a], total[z]) + np.repeat(lows[a:z] - total[a:z], counts[a:z])
        close = np.abs(t[1, j] - p[1, i]) <= near[1][i]
        i, j = i[close], j[close]
        side = [np.maximum(np.minimum(p[k, i] + p[k + 2, i] / 2, t[k, j] + t[k + 2, j] / 2) - np.maximum(p[k, i] - p[k + 2, i] / 2, t[k, j] - t[k + 2, j] / 2), 0.0) for k in (0, 1)]
        both = side[0] * side[1]
        overlap = _rounded(both / (p[2, i] * p[3, i] + t[2, j] * t[3, j] - both))
        good = overlap >= least
        found.append((at_p[i[good]], at_t[j[good]], overlap[good]))
        a = z
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _greedy(pairs: pa.Table) -> list[int]:
    """Places of the pairs that come about where the most confident prediction takes its best free label first."""
    order = pc.sort_indices(pairs, sort_keys=[("confidence", "descending"), ("pred_id", "ascending"), ("overlap", "descending"), ("label_id", "ascending")])
    rows, used, done = [], set(), set()
    for i, p, t in zip(order.to_pylist(), pairs.column("pred_id").take(order).to_pylist(), pairs.column("label_id").take(order).to_pylist(), strict=True):
        if p not in done and t not in used:
            done.add(p)
            used.add(t)
            rows.append(i)
    return rows


def assigned(predictions: DataFrame, labels: DataFrame, image: list[str], threshold: float = 0.5, least_confidence: float = 0.0, crowd: int = 100_000) -> DataFrame:
    """(image, class_id, pred_id, confidence, label_id, overlap, is_tp) of every prediction, labels used up by confidence.

    In order of falling confidence, ties by id, a prediction takes the label it overlaps best of those that are
    still free and overlap it by ``threshold`` (over 0) or more, ties by id; without one it is false. Unlike in ``matches``,
    a prediction whose best label is gone may take another. The boxes of an image and class meet in one task, each exchanged
    once. Where they may be more than ``crowd``, a grid finds their pairs (``candidates``), and what one task holds are these.
    """
    keys = [*image, "class_id"]
    preds = predictions.where(F.col("confidence") >= least_confidence).select(*keys, "pred_id", "confidence", *BOX)
    truth = labels.select(*keys, "label_id", *BOX)
    own = {c: preds.schema[c].dataType for c in keys}
    kinds = preds.select(*keys).unionByName(truth.select(*keys)).schema
    preds, truth = (d.withColumns({c: F.col(c).cast(kinds[c].dataType) for c in keys if d.schema[c].dataType != kinds[c].dataType}) for d in (preds, truth))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    sizes = preds.select(bucket.alias("b")).unionAll(truth.select(bucket.alias("b"))).groupBy("b").count().toArrow()  # a row a bucket at most
    large = sizes.column("b").filter(pc.greater(sizes.column("count"), crowd)).to_pylist()
    tasks = (pc.sum(sizes.column("count")).as_py() or 0) // ordered.ROWS_IN_TASK + 1
    if large:
        crowded = bucket.isin(large)
        parts = [_met_in_groups(preds.where(~crowded), truth.where(~crowded), keys, threshold, tasks), _met_in_grids(preds.where(crowded), truth.where(crowded), image, threshold)]
        out = parts[0].unionByName(parts[1])
    else:
        out = _met_in_groups(preds, truth, keys, threshold, tasks)
    return out.select(*[F.col(c).cast(own[c]).alias(c) for c in keys], "pred_id", "confidence", "label_id", "overlap", F.col("label_id").isNotNull().alias("is_tp"))


def _met_in_groups(preds: DataFrame, truth: DataFrame, keys: list[str], threshold: float, tasks: int) -> DataFrame:
    """Predictions with label_id and overlap, all boxes of an image and class in a task."""
    preds, truth = (d.withColumns({c: F.col(c).cast("double") for c in BOX}) for d in (preds, truth))
    importable(preds.sparkSession)
    fields = [*preds.drop(*BOX).schema, truth.schema["label_id"], T.StructField("overlap", T.DoubleType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    id_kind = pa_type(schema["label_id"].dataType)

    def boxes(table: pa.Table) -> np.ndarray:
        return np.array([pc.fill_null(table.column(c), math.nan).to_numpy() for c in BOX]).reshape(4, -1)

    def assign(key: tuple, p: pa.Table, t: pa.Table) -> pa.Table:
        label, overlap = [None] * p.num_rows, [None] * p.num_rows
        if p.num_rows and t.num_rows and all(k.is_valid for k in key):
            i, j, share = _overlapping(boxes(p), boxes(t), threshold)
            pairs = pa.table({"confidence": p.column("confidence").take(pa.array(i)), "pred_id": p.column("pred_id").take(pa.array(i)), "overlap": pa.array(share), "label_id": t.column("label_id").take(pa.array(j))})
            rows = pa.array(_greedy(pairs), pa.int64())
            won = dict(zip(*[pairs.column(c).take(rows).to_pylist() for c in ("pred_id", "label_id")], strict=True))
            best = dict(zip(*[pairs.column(c).take(rows).to_pylist() for c in ("pred_id", "overlap")], strict=True))
            ids = p.column("pred_id").to_pylist()
            label, overlap = [None if k is None else won.get(k) for k in ids], [None if k is None else best.get(k) for k in ids]
        return p.select(kept).append_column("label_id", pa.array(label, id_kind)).append_column("overlap", pa.array(overlap, pa.float64()))

    kept = schema.names[:-2]
    dealt = [d.repartition(tasks, *keys).groupBy(*keys) for d in (preds, truth)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(assign, schema)


def _met_in_grids(preds: DataFrame, truth: DataFrame, image: list[str], threshold: float) -> DataFrame:
    """The same, pairs found by a grid."""
    overlap = F.round(iou(tuple(F.col(f"p_{c}") for c in BOX), tuple(F.col(f"t_{c}") for c in BOX)), 9)
    pairs = candidates(preds, truth, image, threshold).select(*image, "class_id", "pred_id", "confidence", "label_id", overlap.alias("overlap")).where(F.col("overlap") >= threshold)
    importable(preds.sparkSession)
    schema = pairs.drop("confidence").schema
    names = schema.names

    def assign(table: pa.Table) -> pa.Table:
        return table.take(pa.array(_greedy(table), pa.int64())).select(names)

    taken = pairs.groupBy(*image, "class_id").applyInArrow(assign, schema)
    return preds.drop(*BOX).join(taken, [*image, "class_id", "pred_id"], "left")


def _list(thresholds: tuple[float, ...]) -> Column:
    return F.array(*[F.lit(float(t)) for t in thresholds])


def curve(judged: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, confidence, tp, fp, recall, precision, envelope) at each distinct confidence.

    Running sums are taken in two levels, over steps of the confidence and within a step, so no
    task holds all predictions of a class. ``totals`` has (keys, n_labels).
    """
    step = F.least(F.floor(F.col("confidence") * STEPS), F.lit(STEPS)).cast("int")
    points = judged.groupBy(*keys, "confidence").agg(F.count_if("is_tp").alias("tp"), F.count_if(~F.col("is_tp")).alias("fp")).withColumn("step", step)
    inner = Window.partitionBy(*keys, "step").orderBy(F.desc("confidence")).rowsBetween(Window.unboundedPreceding, 0)
    upto = Window.partitionBy(*keys).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    by_step = points.groupBy(*keys, "step").agg(F.sum("tp").alias("s_tp"), F.sum("fp").alias("s_fp"))
    before = by_step.select(*keys, "step", *[F.coalesce(F.sum(f"s_{c}").over(upto), F.lit(0)).alias(f"b_{c}") for c in ("tp", "fp")])
    summed = points.select(*keys, "step", "confidence", *[F.sum(c).over(inner).alias(c) for c in ("tp", "fp")]).join(before, [*keys, "step"])
    summed = summed.select(*keys, "step", "confidence", (F.col("tp") + F.col("b_tp")).alias("tp"), (F.col("fp") + F.col("b_fp")).alias("fp")).join(totals, keys)
    rated = summed.withColumn("recall", F.coalesce(F.try_divide("tp", "n_labels"), F.lit(0.0))).withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp")))
    rest = Window.partitionBy(*keys, "step").orderBy("confidence").rowsBetween(Window.unboundedPreceding, 0)
    below = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    tops = rated.groupBy(*keys, "step").agg(F.max("precision").alias("top"), F.max("recall").alias("reach"))
    over = Window.partitionBy(*keys).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*keys, "step", F.max("top").over(below).alias("later"), F.coalesce(F.max("reach").over(over), F.lit(0.0)).alias("from"))
    joined = rated.join(tops, [*keys, "step"])
    envelope = F.greatest(F.max("precision").over(rest), F.coalesce("later", F.lit(0.0)))
    back = Window.partitionBy(*keys, "step").orderBy(F.desc("confidence"))
    gained = F.col("recall") - F.coalesce(F.lag("recall").over(back), F.col("from"))
    return joined.select(*keys, "confidence", "tp", "fp", "recall", "precision", envelope.alias("envelope"), gained.alias("gained"))


def average_precision(judged: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_labels, ap, precision, recall, f1) of every class that has labels."""
    totals = labels.groupBy(*keys).agg(F.count("*").alias("n_labels"))
    areas = curve(judged, totals, keys).groupBy(*keys).agg(F.sum(F.col("gained") * F.col("envelope")).alias("ap"))
    plain = judged.groupBy(*keys).agg(F.count_if("is_tp").alias("tp"), F.count("*").alias("n"))
    out = totals.join(areas, keys, "left").join(plain, keys, "left")
    p, r = F.coalesce(F.try_divide("tp", "n"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "n_labels"), F.lit(0.0))
    return out.select(*keys, "n_labels", F.coalesce("ap", F.lit(0.0)).alias("ap"), p.alias("precision"), r.alias("recall"), f1(p, r).alias("f1"))


def f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def mean_over_thresholds(predictions: DataFrame, labels: DataFrame, image: list[str], thresholds: tuple[float, ...] = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)) -> DataFrame:
    """(class_id, ap50, ap): average precision at the first threshold and over all of them."""
    judged = matches_at(predictions, labels, image, thresholds)
    wanted = labels.select("class_id", F.explode(_list(thresholds)).alias("threshold"))
    each = average_precision(judged, wanted, ["class_id", "threshold"])
    return each.groupBy("class_id").agg(F.max(F.when(F.col("threshold") == float(thresholds[0]), F.col("ap"))).alias("ap50"), F.avg("ap").alias("ap"))


def merged_breakdown(per_source: DataFrame, names: dict[int, str], merged: dict[int, str]) -> DataFrame:
    """(metric, value): ``{source}_as_{target}_ap50`` and ``..._n_objects`` of merged classes."""
    lookup = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    stem = F.concat_ws("_as_", F.element_at(lookup(names), F.col("class_id")), F.element_at(lookup(merged), F.col("class_id")))
    pairs = F.array(F.struct(F.concat(stem, F.lit("_ap50")).alias("metric"), F.col("ap").alias("value")), F.struct(F.concat(stem, F.lit("_n_objects")).alias("metric"), F.col("n_labels").cast("double").alias("value")))
    return per_source.where(F.col("class_id").isin(*merged)).select(F.inline(pairs))


def total_ms(*parts: str) -> Column:
    """Milliseconds of a frame: those of all stages together."""
    out = F.col(parts[0])
    for p in parts[1:]:
        out = out + F.col(p)
    return out


def leaderboard(results: DataFrame, metric: str = "fitness", n: int | None = None) -> DataFrame:
    """Experiments by falling metric, unmeasured ones last."""
    ranked = results.orderBy(F.desc_nulls_last(metric), "model")
    return ranked if n is None else ranked.limit(n)


def compared(trained: DataFrame, baseline: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Metrics of two models on one test set side by side, with what was gained."""
    old = baseline.select(*keys, *[F.col(m).alias(f"baseline_{m}") for m in metrics])
    out = trained.select(*keys, *metrics).join(old, keys, "full")
    return out.select(*keys, *metrics, *[f"baseline_{m}" for m in metrics], *[(F.col(m) - F.col(f"baseline_{m}")).alias(f"{m}_gain") for m in metrics])
