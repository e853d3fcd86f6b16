"""Ranked lexical search over an inverted index that is a table.

The index is a table of postings (bucket, term, doc, row, tf, n). Every task writes the postings of its own
documents in order of term bucket and term, so a file is a segment: a reader of few terms skips most of it by its
statistics, and all postings of a document are in one file. A search joins the items' terms, scores each
match in whole numbers, sums by item and document - mostly within a task, as a document's matches meet
there - and ranks by ``row_number``.

Edge cases: a null text has no terms and is no document of the index. Every row is a document of its own, also
one that repeats an id, and every item's row is an item of its own; null ids rank behind others of their
score, equal ids in order of their rows. An item without terms, or whose terms no document has, has no rows; so has an
empty table. A repeated term of an item counts once. Texts are read whole, however long. Columns beyond
those named are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftrail.llm.common import col, map_batches, pa_type, written

#: Of UTF-8 bytes: letters to lower case, digits and bytes of other characters as they are, all else a blank.
_TERM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())
BUCKETS = 256
_STATISTICS = -1  # the bucket of a task's own sums: documents as tf, terms as n


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters; only A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


@dataclass
class Index:
    """A written table of postings, its documents and all their terms with repeats.

    ``vocabulary`` says whether the table has only terms that were asked for.
    """

    postings: DataFrame
    n_docs: int
    n_terms: int
    vocabulary: bool


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(q, item_id, term): the distinct terms of each item; ``q`` tells items apart."""
    numbered = items.select(F.monotonically_increasing_id().alias("q"), col(item_id).alias("item_id"), col(text).alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(t.decode("utf-8", "surrogatepass") for t in set(terms_of(x.as_py() or ""))) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], names=["q", "item_id", "terms"])

    schema = numbered.select("q", "item_id", F.array(F.lit("")).alias("terms")).schema
    return map_batches(numbered, run, schema).select("q", "item_id", F.explode("terms").alias("term"))


def index(docs: DataFrame, terms: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", most_terms: int = 1_000_000) -> Index:
    """The postings of ``docs``, written in order of term bucket within each task.

    With ``terms`` (a column ``term``) of at most ``most_terms`` different terms, which then go to every
    task, only postings of these are kept; with more of them all postings are, for the same results.
    """
    asked = None
    if terms is not None:
        head = [r["term"] for r in terms.select("term").distinct().limit(most_terms + 1).collect()]
        if len(head) <= most_terms:
            asked = docs.sparkSession.sparkContext.broadcast(frozenset(t.encode("utf-8", "surrogatepass") for t in head))
    frame = docs.select(col(doc_id).alias("doc"), col(text).alias("t"))
    doc_type = pa_type(frame.schema["doc"].dataType)
    schema = frame.select(F.lit("").alias("term"), "doc", *[F.lit(0).cast("bigint").alias(c) for c in ("row", "tf", "n")]).schema
    for field in schema:
        field.nullable = True

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if asked is None else asked.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            term, doc, rows, tf, n = [], [], [], [], []
            n_docs = n_terms = 0
            ids = batch.column(0).to_pylist()
            for at, t in enumerate(batch.column(1)):
                found = terms_of(t.as_py() or "")
                if not found:
                    continue
                size = len(found)
                counts = Counter(found if wanted is None else filter(wanted.__contains__, found))
                n_docs, n_terms = n_docs + 1, n_terms + size
                term += counts.keys()
                tf += counts.values()
                doc += [ids[at]] * len(counts)
                rows += [row + at] * len(counts)
                n += [size] * len(counts)
            row += batch.num_rows
            columns = [pa.array([*term, None], pa.binary()).cast(pa.string()), pa.array([*doc, None], doc_type), *[pa.array(x, pa.int64()) for x in ([*rows, None], [*tf, n_docs], [*n, n_terms])]]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "doc", "row", "tf", "n"])

    bucket = F.when(F.col("term").isNull(), _STATISTICS).otherwise(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int"))
    found = map_batches(frame, run, schema).select(bucket.alias("bucket"), "*").sortWithinPartitions("bucket", "term")
    table = written(found, "postings")
    totals = table.where(F.col("bucket") == _STATISTICS).agg(F.sum("tf").alias("d"), F.sum("n").alias("l")).first()
    return Index(table.where(F.col("bucket") >= 0), totals["d"] or 0, totals["l"] or 0, asked is not None)


def _length_part(size: str, n_docs: int, n_terms: int):  # noqa: ANN202
    """100 - 90 + (90 * n * N) div L in 64 bits, and in decimals where the product has more."""
    safe = (2**63 - 1) // max(90 * n_docs, 1)
    return F.expr(f"10 + CASE WHEN {size} <= {safe}L THEN ({90 * n_docs}L * {size}) div {n_terms}L ELSE CAST(CAST({size} AS DECIMAL(20, 0)) * {90 * n_docs}BD div {n_terms}BD AS BIGINT) END")


def search(found: Index, terms: DataFrame, top: int = 10, most_rows: int = 2_000_000) -> DataFrame:
    """(q, item_id, rank, doc_id, score): the ``top`` best documents of each item.

    ``terms`` are rows of ``item_terms``. Up to ``most_rows`` of them go to every task; beyond that both sides are
    dealt by term, which Spark splits where a term is common, as no operator needs a term's rows together.
    """
    if not found.n_docs:
        return terms.selectExpr("q", "item_id", "0 AS rank", "CAST(NULL AS BIGINT) AS doc_id", "0L AS score").limit(0)
    weight = F.expr(f"CAST(floor(1000 * ln({2 * found.n_docs + 2}D / (2 * df + 1))) AS BIGINT)")
    asked = terms.select("q", "term").distinct()
    df = found.postings.join(asked.select("term").distinct(), "term", "left_semi") if not found.vocabulary else found.postings
    weights = written(df.groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("w")), "weights")
    weighted = written(asked.join(weights, "term"), "item-terms")
    side = weighted.groupBy("term", "w").agg(F.collect_list("q").alias("qs")) if weighted.limit(most_rows + 1).count() <= most_rows else None
    part = F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")
    posted = found.postings.withColumn("m", _length_part("n", found.n_docs, found.n_terms)).select("term", "doc", "row", part.alias("part"))
    if side is not None:
        matched = posted.join(F.broadcast(side), "term").select(F.explode("qs").alias("q"), "doc", "row", (F.col("w") * F.col("part")).alias("s"))
    else:
        matched = posted.join(weighted.hint("merge"), "term").select("q", "doc", "row", (F.col("w") * F.col("part")).alias("s"))
    scored = matched.groupBy("q", "doc", "row").agg(F.sum("s").alias("score")).where("score > 0")
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "row")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(terms.select("q", "item_id").distinct(), "q").select("q", "item_id", "rank", F.col("doc").alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best of all ``docs``."""
    terms = written(item_terms(items, item_id, item_text), "terms")
    return search(index(docs, terms, doc_id, text), terms, top).drop("q")
