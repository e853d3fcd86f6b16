"""Boilerplate lines by how often they stand on the pages of one site; DataFrame functions only.

A line is what stands between line feeds, compared without the spaces around it. The share of a
site's pages that contain a line is the number of those pages over all of the site's pages. A line is
dropped wherever the site shows it if it stands on two pages or more and on more of them
than a line that has the share ``ratio`` would by chance: than n ratio + 3 sqrt(n ratio (1 - ratio)) of
n pages. That goes for sites of every size.

Edge cases: a null text stays null and counts as a page; an empty text stays empty. Rows without a
site are kept as they are, for they have no site to be compared with. Blank lines are never
dropped. A line that a page repeats counts once for it; repeated rows count as pages each. A text
may lose all of its lines and is then empty. Very long texts are read whole. An empty table stays
empty. Other columns pass through, whatever their names; ``n_lines`` and ``n_dropped`` are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import col, free_name, written


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _mark(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def bound(total: Column, ratio: float, sigmas: float = 3.0) -> Column:
    """The number of pages that a line must exceed on a site of ``total`` pages."""
    return F.greatest(F.lit(1.0), total * F.lit(ratio) + F.lit(sigmas) * F.sqrt(total * F.lit(ratio) * F.lit(1 - ratio)))


def boilerplate(docs: DataFrame, host: str, text: str, ratio: float) -> DataFrame:
    """(host, lines): the hashes of the lines to drop from each site that has any.

    A site has at most its mean number of distinct lines on a page, divided by ``ratio``, of them,
    however many pages it has; counts are added up before and after the one exchange by line.
    """
    rows = docs.select(col(host).alias("host"), col(text).alias("text")).where("host IS NOT NULL")
    marks = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), _mark), lambda m: m != F.xxhash64(F.lit(""))))
    lines = rows.where("text IS NOT NULL").select("host", F.explode(marks).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1")
    totals = rows.groupBy("host").agg(F.count("*").alias("total"))
    common = counts.join(totals, "host").where(F.col("n") > bound(F.col("total"), ratio))
    return common.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, salts: int = 64, n_lines: str | None = None, n_dropped: str | None = None) -> DataFrame:
    """``docs`` without the boilerplate lines of its sites; optionally with the lines counted.

    The list of lines is written first. If it is small, Spark sends it to every executor, for it
    knows the size of what is written; if not, both sides are dealt out by site and by a salt that
    follows from the row, so that a site with a third of all rows is spread over ``salts`` keys.
    """
    common = written(boilerplate(docs, host, text, ratio), "lines")
    names = {n: free_name(docs, f"__{n}") for n in ("host", "salt", "lines", "parts", "kept")}
    plain = [col(c) for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    side = common.select(F.col("host").alias(names["host"]), F.col("lines").alias(names["lines"]), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(names["salt"]))
    salted = docs.withColumn(names["salt"], F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))
    joined = salted.join(side, (salted[host] == side[names["host"]]) & (salted[names["salt"]] == side[names["salt"]]), "left")
    drop = F.coalesce(side[names["lines"]], F.array().cast("array<bigint>"))
    # The few lines of a page that are to go are found in time linear in its lines and the site's.
    own = F.when(F.size(drop) == 0, drop).otherwise(F.array_intersect(F.transform(_lines(salted[text]), _mark), drop))
    parts = joined.select(*[salted[c] for c in docs.columns], _lines(salted[text]).alias(names["parts"]), own.alias(names["lines"]))
    kept = F.when(F.size(names["lines"]) == 0, F.col(names["parts"])).otherwise(F.filter(names["parts"], lambda x: ~F.array_contains(F.col(names["lines"]), _mark(x))))
    found = parts.withColumn(names["kept"], kept)
    out = [F.array_join(names["kept"], "\n").alias(c) if c == text else col(c) for c in docs.columns]
    if n_lines:
        out.append(F.coalesce(F.when(col(text).isNotNull(), F.size(names["parts"])), F.lit(0)).cast("bigint").alias(n_lines))
    if n_dropped:
        out.append(F.coalesce(F.when(col(text).isNotNull(), F.size(names["parts"]) - F.size(names["kept"])), F.lit(0)).cast("bigint").alias(n_dropped))
    return found.select(*out)
