"""Models over frames: a detector and a classifier, loaded once in each Python worker and fed in batches.

A model comes as a function that loads it; it runs in a worker when the first batch arrives there, and what
it gives serves all later tasks of that worker. Filters on frames belong before these calls.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftrail.functions.session import free_name, importable
from siftrail.operators.frames import is_class

BOX = ("xc", "yc", "w", "h")


@dataclass(frozen=True)
class Classifier:
    """Class names by index, and a function from a column's batch, or several columns' batches, to probabilities (rows x classes)."""

    names: dict[int, str]
    probabilities: Callable[..., np.ndarray]


def classified(frames: DataFrame, load: Callable[[], Classifier], columns: list[str], batch_size: int = 64, top: str = "top1", confidence: str = "confidence") -> DataFrame:
    """``frames`` with the name of the most probable class and its probability; of equal ones the first class.

    Old columns of these names are replaced. Rows with a null or NaN among ``columns`` have no class and confidence 0.
    """
    importable(frames.sparkSession)

    def make() -> Callable:
        model = load()
        names = np.array([model.names[k] for k in range(len(model.names))], object)

        def predict(*batch: np.ndarray) -> dict[str, np.ndarray]:
            found = np.asarray(model.probabilities(*batch), float)
            best = found.argmax(axis=1)
            return {"top": names[best], "confidence": found[np.arange(len(best)), best]}

        return _of_columns(predict, n_columns)

    n_columns = len(columns)
    run = predict_batch_udf(make, return_type=T._parse_datatype_string("top string, confidence double"), batch_size=batch_size)
    return _judged(frames, run, columns, {top: ("top", None), confidence: ("confidence", F.lit(0.0))})


def _of_columns(predict: Callable, n: int) -> Callable:
    """Spark passes a function as many columns as it has parameters."""
    predict.__signature__ = inspect.Signature([inspect.Parameter(f"c{i}", inspect.Parameter.POSITIONAL_ONLY) for i in range(n)])
    return predict


def _judged(frames: DataFrame, run: Callable, columns: list[str], added: dict) -> DataFrame:
    sound = F.lit(True)
    for c in columns:
        sound = sound & F.col(c).isNotNull() & (~F.isnan(c) if dict(frames.dtypes)[c] in ("double", "float") else F.lit(True))
    found = free_name(frames, "found")
    kept = [c for c in frames.columns if c.lower() not in {a.lower() for a in added}]
    # a null would turn a batch of whole numbers into floats, so such rows do not go to the model
    seen = frames.where(sound).withColumn(found, run(*columns))
    seen = seen.select(*kept, *[F.col(found)[f].alias(out) for out, (f, _) in added.items()])
    types = dict(seen.dtypes)
    unseen = frames.where(~sound).select(*kept, *[(F.lit(None) if default is None else default).cast(types[out]).alias(out) for out, (_, default) in added.items()])
    return seen.unionByName(unseen)


def statuses(frames: DataFrame, load: Callable[[], Classifier], columns: list[str], wanted: str, least: float, batch_size: int = 64, out: str = "is_active") -> DataFrame:
    """``frames`` with whether the classifier takes them for ``wanted`` with a confidence of ``least`` or more.

    The class is found by its name; a model without it is an error, told before any frame is read.
    """
    names = load().names
    if wanted not in names.values():
        raise ValueError(f"the classifier has no class {wanted!r}, only {sorted(names.values())}")
    top, confidence = free_name(frames, "top1"), free_name(frames, "confidence")
    judged = classified(frames, load, columns, batch_size, top, confidence)
    return judged.withColumn(out, is_class(F.col(top), F.col(confidence), wanted, least)).drop(top, confidence)


def detected(frames: DataFrame, load: Callable[[], Callable[..., list[np.ndarray]]], columns: list[str], batch_size: int = 16) -> DataFrame:
    """A row for each detection: the frame's columns, class_id, confidence and the box (xc, yc, w, h).

    The loaded model takes the columns' batches and gives for each frame an array of rows (class, confidence, xc, yc, w, h), which
    may have none. Old columns of the new ones' names are replaced. Frames with a null or NaN among ``columns`` are not shown to it and have no detections.
    """
    importable(frames.sparkSession)

    def make() -> Callable:
        model = load()

        def predict(*batch: np.ndarray) -> list[dict[str, np.ndarray]]:
            return [{"class_id": rows[:, 0].astype(np.int32), **{k: rows[:, i] for i, k in enumerate(("confidence", *BOX), 1)}} for rows in (np.asarray(r, float).reshape(-1, 6) for r in model(*batch))]

        return _of_columns(predict, n_columns)

    n_columns = len(columns)
    kind = T._parse_datatype_string("class_id array<int>, confidence array<double>, " + ", ".join(f"{c} array<double>" for c in BOX))
    run = predict_batch_udf(make, return_type=kind, batch_size=batch_size)
    names = ("class_id", "confidence", *BOX)
    seen = _judged(frames, run, columns, {f"__{c}": (c, None) for c in names})
    kept = [c for c in frames.columns if c.lower() not in names]
    each = seen.select(*kept, F.inline(F.arrays_zip(*[F.col(f"__{c}").alias(c) for c in names])))
    return each.toDF(*kept, *names)
