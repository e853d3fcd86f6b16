"""Every query and stage over empty tables and over tables full of nulls, ties and odd columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siftrail.llm import queries

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}
TEXT = "One line here, shared by all of them.\nThe quick brown fox jumps over the lazy dog and then some more words follow it. " * 3
ROWS = {
    "documents": [(None, None, None, None, None), (None, TEXT, "en", "a", 1), (1, TEXT, "en", "a", 1), (1, TEXT, "en", "a", 1), (1, "other text", None, None, 2), (2, "", "fr", "a", 0), (3, None, "en", "b", None), (4, "été " * 50_000, "fr", "b", 1), (5, "\n\n \t", "en", "", 4), (6, "a", "en", "a", 1), (7, "🙂\u0000é", "en", "a", 1)],
    "pages": [(None, None, None), (1, "http://a.example.com/en/x", "<article><p>Hi</article>"), (1, "http://a.example.com/en/x", "<article><p>Hi</article>"), (2, "", ""), (3, "nonsense", "<" * 300), (None, "https://b.org", "<p>" + "w " * 100_000)],
    "benchmark": [(None, None), (None, "the quick brown fox jumps over the lazy dog"), (1, ""), (2, "too short"), (2, "too short"), (3, "été été été été été été")],
    "labels": [(None, None, None), (1, 1, 0), (1, 0, 1), (4, None, 1)],
}
EXTRA = {"key": 1, "doc": 2, "u": 3, "fp": "x", "matches": "y", "lines": 4, "blocked": True, "digest": "d", "__salt": 5, "mark": 6}


def tables(spark, path, rows):
    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame(rows[name], schema)
        for c, v in EXTRA.items():
            df = df.withColumn(c, F.lit(v))
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("odd"), ROWS)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("empty"), {k: [] for k in ROWS})


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_odd_tables(spark, odd, empty, name):
    table = "pages" if name.split("_")[0] in ("op5", "op8", "op9") else "documents"
    got = queries.QUERIES[name](spark, odd).collect()
    if name == "op2_decontamination":
        assert sorted((repr(r["doc_id"]), repr(r["item_id"])) for r in got) == sorted([("None", "None"), ("1", "None"), ("1", "None"), ("4", "3")])
    elif name == "op11_filter_audit":
        assert len(got) == 600 * 3 and sum(r["kept"] + r["removed"] for r in got if r["step"] == 1) == 120 * len(ROWS[table])
    elif name == "op13_lexical_search":
        assert [(r["rank"], r["doc_id"]) for r in got if r["item_id"] == 3] == [(1, 4)] and {r["doc_id"] for r in got if r["item_id"] is None} >= {1, None}
    else:
        assert len(got) == len(ROWS[table])
    assert queries.QUERIES[name](spark, empty).collect() == []


def test_stages_on_odd_tables(spark, odd, empty):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, odd)
        assert docs_after.columns == docs.columns, name
        assert docs_after.count() <= docs.count()
        docs_after.write.parquet(f"{odd}/after_{name}")
        docs = spark.read.parquet(f"{odd}/after_{name}")
    out = corpus_pipeline.run(spark, odd)
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_facts_about_odd_rows(spark, odd):
    simhash = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in queries.op3_simhash(spark, odd).collect()}
    assert simhash[3, "0" * 16] == simhash[2, "0" * 16] == simhash[None, "0" * 16] == 2
    languages = queries.op10_language_id(spark, odd).collect()
    assert {r["lang_pred"] for r in languages if r["doc_id"] in (2, 3, 5)} == {"und"}
    passages = {(r["doc_id"], r["n_bytes"]): r for r in queries.op4_repeated_passages(spark, odd).collect()}
    assert passages[1, len(TEXT)]["n_removed"] < len(TEXT)
    assert passages[None, len(TEXT)]["n_removed"] == len(TEXT)  # null ids come last, and repeat the others
