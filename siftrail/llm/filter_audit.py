"""How quality filters act on each other: every order of them replayed over every document.

Each document's failed filters are crossed with all orders of the filters (120 of five, broadcast), the
steps of an order are exploded, the first filter that fails takes the document, and what a step keeps and
removes is counted for each part of the corpus. Counts are combined before they are exchanged.

Edge cases: a null text is an empty one; a null part is the empty string, one part with those that are
empty. A document without a label, or with a null id, is lost without being counted as good or toxic; of
several labels of one id any 1 counts. Rows that repeat an id and a text are documents of their own, none of
which is a copy of the other; a row without an id is a copy if any row with an id has its text. Of no
documents there are no rows. Other columns are not looked at. Texts are read whole, however long.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftrail.llm.common import col, written

SPACE = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """The maximal runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, r"[ \t-\r]+"), "")


def text_failures(text: Column) -> dict[str, Column]:
    """Which of the filters that see one text alone it fails, by letter."""
    words = words_of(text)
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 100,
        "B": F.lit(100) * distinct < F.lit(80) * n,
        "C": F.lit(100) * capitals > F.lit(10) * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, good, toxic, A to E) of every document: its failed filters and what its labels say.

    Copies meet by the hash of their text. The smallest id of each hash of several documents is found with counts combined before
    the exchange and written; so a text that a third of all documents share is a skewed side of a join, which Spark splits.
    """
    whole = F.coalesce(col(text), F.lit(""))
    read = docs.select(col(doc_id).alias("i"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"), whole.alias("t"))
    # one row of an array, so that words are cut once
    alone = F.transform(F.array(F.col("t")), lambda t: F.struct(*[c.alias(k) for k, c in text_failures(t).items()]))
    rows = read.select("i", "part", F.unhex(F.sha2("t", 256)).alias("h"), F.explode(alone).alias("f")).select("i", "part", "h", "f.*")
    firsts = read.groupBy(F.unhex(F.sha2("t", 256)).alias("h")).agg(F.min("i").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    copied = rows.join(written(firsts, "firsts"), "h", "left").withColumn("E", F.expr("first IS NOT NULL AND (i IS NULL OR i > first)")).drop("h", "first")
    marks = labels.groupBy(col("doc_id").alias("i")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return copied.join(marks, "i", "left").select("part", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic", *"ABCDE")])


def orders(spark: SparkSession, letters: str) -> DataFrame:
    """(filter_order, packed) of every order of the filters; ``packed`` has the place in ``letters`` of each step, three bits a step."""
    found = [("".join(letters[k] for k in p), sum(k << (3 * s) for s, k in enumerate(p))) for p in permutations(range(len(letters)))]
    return spark.createDataFrame(found, "filter_order string, packed int")


def replay(failed: DataFrame, letters: str = "ABCDE", part: str = "part", losses: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """A row for each part, order and step: kept, removed, redundant, unique_fails, ``<loss>_lost`` and shapley.

    ``failed`` has a boolean column for each filter, named by its letter (at most eight), and one for each
    loss. Every row is crossed with every order: rows grow by a bounded factor only, the number of orders
    times their length, and are counted where they arise.
    """
    mask = sum((F.col(k).cast("int") * (1 << i) for i, k in enumerate(letters)), F.lit(0))
    masked = failed.select(F.col(part).alias("part"), mask.alias("mask"), *losses)
    crossed = masked.crossJoin(F.broadcast(orders(failed.sparkSession, letters)))
    n = len(letters)
    bit = lambda step: F.expr(f"shiftleft(1, shiftright(packed, 3 * ({step} - 1)) & 7)")
    first = F.coalesce(*[F.when(F.col("mask").bitwiseAND(bit(k)) != 0, F.lit(k)) for k in range(1, n + 1)], F.lit(n + 1))
    replayed = crossed.withColumn("first", first).withColumn("step", F.explode(F.array(*map(F.lit, range(1, n + 1))))).withColumn("bit", bit("step"))
    here = F.col("first") == F.col("step")
    counted = replayed.groupBy("part", "filter_order", "step").agg(
        F.count_if(F.col("first") > F.col("step")).alias("kept"),
        F.count_if(here).alias("removed"),
        F.count_if((F.col("mask").bitwiseAND(F.col("bit")) != 0) & (F.col("first") < F.col("step"))).alias("redundant"),
        F.count_if(F.col("mask") == F.col("bit")).alias("unique_fails"),
        *[F.count_if(here & F.col(c)).alias(f"{c}_lost") for c in losses],
    )
    # 600 rows a part from here on
    of_filter = Window.partitionBy("part", F.expr("substr(filter_order, step, 1)"))
    return counted.withColumn("shapley", F.sum("removed").over(of_filter))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The five filters replayed over ``docs`` in all 120 orders."""
    return replay(failures(docs, labels, doc_id, text, part))
