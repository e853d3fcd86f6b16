"""Image datasets on disk: splits, images, label files, class names, result tables."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftrail.functions import logs
from siftrail.functions.session import free_name
from siftrail.sources import ranged
from siftrail.sources.logs import listing

IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tiff")
FALLBACK = ranged.FALLBACK
CONFIG_PLACES = ("data.yaml", "train/data.yaml", "test/data.yaml")


def find_config(root: str) -> str | None:
    """The dataset's description: the first that exists of root, train and test."""
    return next((str(p) for place in CONFIG_PLACES if (p := Path(root) / place).is_file()), None)


def load_mapping(path: str) -> dict:
    """A YAML mapping; an empty file is an empty mapping, anything else an error."""
    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ValueError(f"{path} must hold a mapping")
    return data


def class_names(config: dict) -> dict[int, str]:
    """Class names by index, from a list or from a map with numeric keys."""
    names = config.get("names")
    if isinstance(names, list) and names:
        return dict(enumerate(map(str, names)))
    if isinstance(names, dict) and names:
        return {int(k): str(v) for k, v in names.items()}
    raise ValueError("the dataset's description must name its classes in a list or a map")


def class_table(spark: SparkSession, names: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(list(names.items()), "class_id int, class_name string")


def first_choice(df: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """Of rows with the same keys, those of the highest priority."""
    top = Window.partitionBy(*keys).orderBy(priority.desc())
    rank = free_name(df, "rank")
    return df.withColumn(rank, F.rank().over(top)).where(F.col(rank) == 1).drop(rank)


def dataset_files(spark: SparkSession, root: str) -> DataFrame:
    """(split, kind, path, name, stem, suffix) of the files of a prepared dataset.

    Splits may lie nested (train/val/images) or flat (val/images); where both have a split of one
    name, the flat one counts.
    """
    files = listing(spark, root, recursive=True)
    group = lambda n: F.regexp_extract("path", r"/(?:(train|test)/)?(train|val|test)/(images|labels)/[^/]+$", n)
    laid = files.select(group(2).alias("split"), group(3).alias("kind"), (group(1) == "").alias("flat"), "path", "name").where("split <> ''")
    chosen = first_choice(laid, ["split"], F.col("flat").cast("int")).drop("flat")
    return chosen.withColumn("stem", logs.stem(F.col("path"))).withColumn("suffix", F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1)))


def raw_files(spark: SparkSession, root: str) -> DataFrame:
    """(split, source, kind, path, name, stem) of raw data laid out as split/source/kind/file."""
    files = listing(spark, root, recursive=True)
    group = lambda n: F.regexp_extract("path", r"/(train|test)/([^/]+)/(images|labels)/[^/]+$", n)
    return files.select(group(1).alias("split"), group(2).alias("source"), group(3).alias("kind"), "path", "name", logs.stem(F.col("path")).alias("stem")).where("split <> ''")


def has_test_images(files: DataFrame) -> bool:
    """Whether raw files have a test folder with images, which then is the test split."""
    suffix = F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1))
    return not files.where((F.col("split") == "test") & (F.col("kind") == "images") & suffix.isin(*IMAGE_SUFFIXES)).isEmpty()


def image_size(content: bytes) -> tuple[int, int] | None:
    """Width and height of an image held in memory; None if it is none."""
    return ranged.image_size(ranged.Pages(lambda start, size: content[start : start + size], len(content)))


def images(spark: SparkSession, root: str) -> DataFrame:
    """(split, path, stem, width, height) of the images of a dataset, in order of split and path.

    Of each image only the pages that tell its size are read; where Arrow cannot open the files' store, whole
    images are.
    """
    files = dataset_files(spark, root).where((F.col("kind") == "images") & F.col("suffix").isin(*IMAGE_SUFFIXES))
    if ranged.reachable(root):
        sized = ranged.sizes(files.select("split", "path", "stem"))
    else:
        any_case = ",".join("*." + "".join(f"[{c}{c.upper()}]" for c in s) for s in IMAGE_SUFFIXES)
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"{{{any_case}}}").load(root)
        sized = files.join(ranged.sizes(found.select("path", "content"), content="content"), "path")
    return sized.select("split", "path", "stem", "width", "height").orderBy("split", "path")


def label_rows(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines of label text as (class_id, xc, yc, w, h); lines that are no label are passed over.

    A label has five tokens or more, of which the first is a whole number and the fourth and fifth, width
    and height, are numbers; its centre is null if it is none. Of longer lines, outlines of areas, the
    tokens at the places of width and height are read as such.
    """
    tokens = F.split(F.regexp_replace(F.col(text), r"^\s+|\s+$", ""), r"\s+")

    def read(t: Column) -> Column:
        at = lambda i: F.get(t, F.lit(i))
        return F.struct(at(0).try_cast("int").alias("class_id"), *[at(i).try_cast("double").alias(c) for i, c in enumerate(("xc", "yc", "w", "h"), 1)])

    # A generator of one row: the line is cut once, and the filter does not read it again.
    rows = lines.select(*[c for c in lines.columns if c != text], F.inline(F.transform(F.array(tokens), read)))
    return rows.where("class_id IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL")


def labels(spark: SparkSession, root: str) -> DataFrame:
    """(split, stem, class_id, xc, yc, w, h) of all label files of a dataset."""
    files = dataset_files(spark, root).where("kind = 'labels' AND suffix = 'txt'").select("split", "stem", "path")
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(root).select(logs.plain_path(F.input_file_name()).alias("path"), "value")
    return label_rows(text.join(files, "path").select("split", "stem", "value"))


def results_table(spark: SparkSession, path: str, schema: str = "MODEL string, precision double, recall double, map50 double, map double, f1 double, fitness double") -> DataFrame:
    """A results table with a header line."""
    return spark.read.csv(path, header=True, schema=schema)


def marker(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document, on however many lines, as rows of a known schema."""
    return spark.read.schema(schema).json(path, multiLine=True)
