"""Dataset preparation: splits, folder weights, class merges, replay sets.

The rules are declared by configuration alone; how rows are drawn is this library's own choice: by
a hash of the row's key and a seed, so that a row's part never depends on the order of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftrail.functions.session import free_name

SEED = 42


def share(key: Column, seed: int | str = SEED) -> Column:
    """A number in [0, 1) that follows from the key and the seed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("bigint") / float(1 << 32)


def hash_split(df: DataFrame, key: str, val_split: float, test_split: float, has_test: bool = False, seed: int = SEED, out: str = "split") -> DataFrame:
    """Rows marked test, val or train; with a test folder of its own no row is marked test."""
    at = share(F.col(key), seed)
    test = 0.0 if has_test else test_split
    return df.withColumn(out, F.when(at < test, "test").when(at < test + val_split, "val").otherwise("train"))


def folder_weights(df: DataFrame, folder: str, key: str, weights: dict[str, float], seed: int = SEED, out: str = "copy") -> DataFrame:
    """Rows as often as their folder weighs: a share, all, or whole and part copies; 0 drops it.

    Folders that are not listed keep all rows. ``out`` numbers the copies from 0.
    """
    weight = F.lit(1.0)
    for name, w in weights.items():
        weight = F.when(F.col(folder) == name, float(w)).otherwise(weight)
    whole = F.floor(weight)
    n = (whole + F.when(share(F.col(key), f"weight {seed}") < weight - whole, 1).otherwise(0)).cast("int")
    times = free_name(df, "times")
    return df.withColumn(times, n).where(F.col(times) > 0).withColumn(out, F.explode(F.sequence(F.lit(0), F.col(times) - 1))).drop(times)


def multiplied(df: DataFrame, times: int, out: str = "variant") -> DataFrame:
    """Every row ``times`` times, numbered from 0, for augmentation to vary."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(times - 1)))) if times > 0 else df.withColumn(out, F.lit(0)).limit(0)


def merge_classes(df: DataFrame, column: str, classes: list[str], mapping: dict[str, list[str]], by_name: bool = False, out: str = "target") -> DataFrame:
    """``column``, an index into ``classes`` or a name, as the index of the class it is merged into.

    The order of ``mapping`` gives the target indices. Classes in no target are dropped. A class in
    two targets is an error.
    """
    targets = {}
    for index, (name, sources) in enumerate(mapping.items()):
        for source in sources:
            if targets.setdefault(source, index) != index:
                raise ValueError(f"class {source!r} is merged into two targets")
    unknown = set(targets) - set(classes)
    if unknown:
        raise ValueError(f"no such classes: {sorted(unknown)}")
    pairs = [(c if by_name else i, targets[c]) for i, c in enumerate(classes) if c in targets]
    if not pairs:
        return df.withColumn(out, F.lit(None).cast("int")).limit(0)
    lookup = F.create_map(*[F.lit(x) for p in pairs for x in p])
    return df.withColumn(out, F.try_element_at(lookup, F.col(column)).cast("int")).where(F.col(out).isNotNull())


def require_rows(df: DataFrame, what: str = "training images") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what} remain")
    return df


def replay(candidates: DataFrame, existing: DataFrame, max_new: int, max_total: int, border: float, include_empty: bool = True) -> DataFrame:
    """A replay set: the hardest new frames on top of the old ones, the oldest of all pruned.

    Candidates have (key, confidence, is_error, is_empty, age); an error is hardest, then true
    finds below ``border`` by rising confidence, then empty frames if they are wanted. Existing
    rows have (key, age); ``age`` grows with time since a frame came in, and ties go by key.
    """
    hardness = F.when(F.col("is_error"), F.lit(0.0)).when(F.col("is_empty"), F.lit(2.0)).otherwise(F.col("confidence") + 0.5)
    hard = F.col("is_error") | (F.col("confidence") < border) | (F.col("is_empty") & F.lit(include_empty))
    fresh = candidates.where(F.coalesce(hard, F.lit(False))).join(existing.select("key"), "key", "left_anti")
    new = fresh.orderBy(hardness, "key").limit(max_new).select("key", "age")
    return existing.select("key", "age").unionByName(new).orderBy("age", "key").limit(max_total)


def replay_candidates(images: DataFrame, judged: DataFrame, labels: DataFrame, image: str = "image", age: str = "age") -> DataFrame:
    """(key, confidence, is_error, is_empty, age) of each image, from predictions matched to labels.

    An image is an error if it has a false prediction or a label that no prediction found; its
    confidence is that of its least certain true find; it is empty without labels and predictions.
    """
    found = judged.groupBy(image).agg(F.count_if("is_tp").alias("hits"), F.count_if(~F.col("is_tp")).alias("false"), F.min(F.when(F.col("is_tp"), F.col("confidence"))).alias("confidence"))
    wanted = labels.groupBy(image).agg(F.count("*").alias("wanted"))
    rows = images.select(image, age).join(found, image, "left").join(wanted, image, "left").na.fill(0, ["hits", "false", "wanted"])
    error = (F.col("false") > 0) | (F.col("hits") < F.col("wanted"))
    empty = (F.col("wanted") == 0) & (F.col("hits") + F.col("false") == 0)
    return rows.select(F.col(image).alias("key"), "confidence", error.alias("is_error"), empty.alias("is_empty"), F.col(age).alias("age"))


def top_by(df: DataFrame, group: list[str], order: list[Column], n: int, out: str = "place") -> DataFrame:
    """The first ``n`` rows of each group; Spark drops rows beyond it before it exchanges any."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(out) <= n)
