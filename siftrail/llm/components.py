"""Connected components of a large graph, by alternating stars; nothing is gathered in one place."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import col, drop_path, free_name, map_batches, new_path, written


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task's own edges connect, as an edge from each node to the smallest it reaches."""
    parent: dict[int, int] = {}

    def flush() -> pa.RecordBatch:
        pairs = [(x, find(x)) for x in parent]
        pairs = [(x, r) for x, r in pairs if x != r]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:  # bounded memory: what was connected goes out, the rest starts anew
            yield flush()
    if parent:
        yield flush()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an edge list of two bigint columns; root is the smallest node.

    Edges with a null end, loops and repeats are passed over. Each task first shrinks its own edges
    to a forest. Then large and small stars alternate until only stars are left; every one is written
    to the shared folder, so a lost executor costs one step at most.
    """
    spark = edges.sparkSession
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now, path = written(map_batches(now, _forest, "u bigint, v bigint", 10_000), "forest"), None
    while True:
        for star in (_large, _small):
            new, least = new_path(spark, "stars"), new_path(spark, "least")
            star(now, least).write.parquet(new)
            now = spark.read.schema("u bigint, v bigint").parquet(new)
            for old in filter(None, (path, least)):
                drop_path(spark, old)
            path = new
        # Done once every node has one edge, to a node that has none: edges lead to smaller nodes.
        several = now.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        chained = now.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if several.isEmpty() and chained.isEmpty():
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _least(edges: DataFrame, value: Column, path: str) -> DataFrame:
    """(u, m): the least value of each node, written, so that Spark knows its size.

    It is sent to all tasks if it is small; if not, both sides of the join with it are exchanged for
    the join alone, and Spark splits the rows of a node that has very many.
    """
    edges.groupBy("u").agg(value.alias("m")).write.parquet(path)
    return edges.sparkSession.read.schema("u bigint, m bigint").parquet(path)


def _large(edges: DataFrame, path: str) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, F.least(F.min("v"), F.first("u")), path)
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame, path: str) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, F.min("v"), path)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def first_of_each(rows: DataFrame, roots: DataFrame, mark: str, doc_id: str) -> DataFrame:
    """One of the written ``rows`` for each root of (mark, root): the one with the smallest id.

    Ids that are null come last; among rows of one id the smallest hash of the row decides. A row is
    known by its file and its place there, so the choice is made without the rows themselves.
    """
    file, at = free_name(rows, "row_file"), free_name(rows, "row_at")
    spot = rows.metadataColumn("_metadata")
    rows = rows.withColumns({file: spot["file_name"], at: spot["row_index"]})
    plain = [col(c) for c, kind in rows.dtypes if not kind.startswith(("map", "variant")) and c not in (file, at)]
    place = F.struct(col(doc_id).isNull().alias("none"), col(doc_id).alias("id"), F.xxhash64(*plain).alias("hash"), col(file).alias("file"), col(at).alias("at"))
    firsts = rows.select(col(mark).alias("mark"), place.alias("place")).groupBy("mark").agg(F.min("place").alias("place"))
    best = firsts.join(roots, "mark").groupBy("root").agg(F.min("place").alias("place"))
    best = written(best.select(F.col("place.file").alias("best_file"), F.col("place.at").alias("best_at")), "firsts").hint("merge")
    kept = rows.join(best, (rows[file] == best["best_file"]) & (rows[at] == best["best_at"]), "left_semi")
    return kept.drop(file, at)
