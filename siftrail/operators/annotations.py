"""Statistics of image annotations by split and class.

Images have (split, path, stem, width, height), labels (split, stem, class_id, w, h) with sizes as
shares of the image, classes (class_id, class_name). Images are told apart by path: two images of
one stem share its labels and both count. An image is empty if it has no readable label at all; one
with labels of unknown classes only is not empty and adds no object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.functions.boxes import SIZES, area_px, size_class

SPLITS = ("train", "val", "test")


def annotated(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Every image with each of its labels; images without one stay, with null labels."""
    return images.join(labels, ["split", "stem"], "left")


def known(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Labels of known classes with their name, area and size class.

    The class dictionary, a list of names, is sent to the labels. By its own choice Spark would deal the labels by their
    class, as so few rows leave most partitions empty, and one task would get all of the most frequent class.
    """
    named = rows.join(F.broadcast(classes), "class_id")
    return named.withColumn("area", area_px(F.col("w"), F.col("h"), F.col("width"), F.col("height"))).withColumn("size_class", size_class(F.col("area")))


def class_counts(rows: DataFrame) -> DataFrame:
    """Instances of each split and class, by size class too, from rows of ``known``."""
    return rows.groupBy("split", "class_id").agg(F.count("*").alias("instances"), *[F.count_if(F.col("size_class") == s).alias(s) for s in SIZES])


def counts_and_images(rows: DataFrame) -> DataFrame:
    """Both of the above and below from one pass: first by image, then by split and class."""
    by_image = rows.groupBy("split", "class_id", "path").agg(F.count("*").alias("instances"), *[F.count_if(F.col("size_class") == s).alias(s) for s in SIZES])
    return by_image.groupBy("split", "class_id").agg(*[F.sum(c).alias(c) for c in ("instances", *SIZES)], F.count("*").alias("images"))


def images_with_class(rows: DataFrame) -> DataFrame:
    """Images of each split that show a class at least once."""
    return rows.select("split", "class_id", "path").distinct().groupBy("split", "class_id").agg(F.count("*").alias("images"))


def split_totals(images: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Images, empty images and known objects of each split, and of all of them (split null)."""
    flagged = classes.select("class_id").distinct().withColumn("is_known", F.lit(True))
    objects = labels.join(F.broadcast(flagged), "class_id", "left").groupBy("split", "stem").agg(F.count("*").alias("n"), F.count("is_known").alias("n_known"))
    joined = images.join(objects, ["split", "stem"], "left")
    totals = joined.rollup("split").agg(
        F.count("*").alias("images"),
        F.count_if(F.col("n").isNull()).alias("empty_images"),
        F.coalesce(F.sum("n_known"), F.lit(0)).cast("bigint").alias("objects"),
    )
    return totals.withColumn("empty_pct", percent(F.col("empty_images"), F.col("images")))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; 0 of nothing."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def scaffold(images: DataFrame, classes: DataFrame) -> DataFrame:
    """A row for each split and class, seen together or not; both sides are short lists."""
    return images.select("split").distinct().crossJoin(classes)


def class_report(images: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Counts, sizes and percentages of every split and class, zero where there is nothing."""
    rows = known(annotated(images, labels), classes)
    totals = split_totals(images, labels, classes).where("split IS NOT NULL").select("split", F.col("images").alias("total_images"), F.col("objects").alias("total_objects"))
    out = scaffold(images, classes).join(counts_and_images(rows), ["split", "class_id"], "left")
    out = out.na.fill(0, ["instances", *SIZES, "images"]).join(totals, "split")
    return out.select(
        "split", "class_id", "class_name", "instances", F.col("images").alias("images_with_class"), *SIZES,
        percent(F.col("instances"), F.col("total_objects")).alias("instance_pct"),
        percent(F.col("images"), F.col("total_images")).alias("image_pct"),
    )


def overall_classes(report: DataFrame) -> DataFrame:
    """Instances of each class over all splits and their share of all objects."""
    by_class = report.groupBy("class_id", "class_name").agg(F.sum("instances").alias("total_instances"))
    whole = by_class.agg(F.coalesce(F.sum("total_instances"), F.lit(0)).alias("all_instances"))  # one row
    shared = by_class.crossJoin(whole)
    return shared.select("class_id", "class_name", "total_instances", percent(F.col("total_instances"), F.col("all_instances")).alias("percentage"))


def report_document(images: DataFrame, labels: DataFrame, classes: DataFrame, dataset_path: str) -> DataFrame:
    """The nested report as one row: the summary and a map from split to its totals and classes."""
    report = class_report(images, labels, classes)
    totals = split_totals(images, labels, classes)
    detail = F.struct(
        "class_id", "class_name", F.col("instances").alias("total_instances"), "images_with_class",
        F.col("instance_pct").alias("instance_percentage"), F.col("image_pct").alias("image_percentage"),
        F.struct(*SIZES).alias("size_distribution"),
    )
    per_split = report.groupBy("split").agg(F.array_sort(F.collect_list(detail)).alias("classes")).join(totals.where("split IS NOT NULL"), "split")
    splits = per_split.agg(F.map_from_entries(F.collect_list(F.struct("split", F.struct(F.col("images").alias("total_images"), F.col("objects").alias("total_objects"), "empty_images", "classes")))).alias("splits"))
    overall = overall_classes(report).agg(F.array_sort(F.collect_list(F.struct("class_id", "class_name", "total_instances", "percentage"))).alias("classes"))
    names = classes.agg(F.map_from_entries(F.collect_list(F.struct(F.col("class_id").cast("string"), "class_name"))).alias("class_names"))
    whole = totals.where("split IS NULL")
    one = whole.crossJoin(overall).crossJoin(splits).crossJoin(names)  # one row each
    summary = F.struct(F.col("images").alias("total_images"), F.col("objects").alias("total_objects"), F.col("empty_images").alias("total_empty_images"), "classes")
    return one.select(F.lit(dataset_path).alias("dataset_path"), "class_names", summary.alias("summary"), "splits")


def in_report_order(report: DataFrame) -> DataFrame:
    """Splits as train, val, test and then by name."""
    place = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split"))
    return report.orderBy(F.when(place == 0, len(SPLITS) + 1).otherwise(place), "split", "class_id")
