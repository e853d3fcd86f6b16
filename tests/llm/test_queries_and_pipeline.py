"""The registered queries against SQL, and the pipeline against its stages done slowly."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
import regex

import __spark_entry__
import corpus_pipeline
from siftrail.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    listed = ", ".join(f'"{c}"' for c in columns)
    assert got == sorted(repr(r) for r in con.execute(f"SELECT {listed} FROM ({queries.ORACLE_SQL[name]})").fetchall())


def test_everything_is_registered():
    found = __spark_entry__.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert found["pipeline"] is corpus_pipeline.run and set(queries.QUERIES) <= set(found)


class SlowLanguages:
    """Words first, then ever shorter n-grams, letter by letter; shares no code with the operator."""

    def __init__(self, rows):
        self.words, self.grams = {}, {}
        for r in rows:
            if r["text"] is None or r["lang"] is None or r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2:
                continue
            for w in self.split(r["text"]):
                self.words.setdefault(r["lang"], Counter())[w] += 1
        self.langs = sorted(self.words)
        for lang, found in self.words.items():
            for w, n in found.items():
                marked = f"^{w}$"
                for size in range(1, 5):
                    for at in range(len(marked) - size + 1):
                        self.grams.setdefault((lang, size), Counter())[marked[at : at + size]] += n

    def split(self, text):
        return regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())

    def logs(self, tables, key):
        if not any(key in t for t in tables):
            return None
        found = [math.log((t[key] or 0.5) / t.total()) for t in tables]
        return [x - max(found) for x in found]

    def word(self, w):
        if sum(self.words[k][w] for k in self.langs) > 1:  # a word seen once is read by its n-grams
            return self.logs([self.words[k] for k in self.langs], w)
        marked, hits = f"^{w}$", []
        for at in range(len(marked)):
            for size in range(min(4, len(marked) - at), 0, -1):
                hit = self.logs([self.grams[k, size] for k in self.langs], marked[at : at + size])
                if hit:
                    hits.append(hit)
                    break
        return [sum(x) / len(hits) for x in zip(*hits, strict=True)] if hits else [0.0] * len(self.langs)

    def predict(self, text):
        words = self.split(text or "")
        if not words or not self.langs:
            return "und", 0.0
        odds = [0.0] * len(self.langs)
        for w, n in Counter(words).items():
            odds = [o + n * x for o, x in zip(odds, self.word(w), strict=True)]
        odds = [math.exp((o - max(odds)) / math.sqrt(len(words))) for o in odds]
        return self.langs[odds.index(max(odds))], max(odds) / sum(odds)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()


def test_language_query_equals_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    slow = SlowLanguages(rows)
    got = {r["doc_id"]: r for r in queries.op10_language_id(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        lang, score = slow.predict(r["text"])
        assert (got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["held_out"]) == (lang, zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert got[r["doc_id"]]["score"] == pytest.approx(score, rel=1e-9)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_pipeline(spark, sf_dir):
    """Every row of the pipeline against its stages done slowly, without the library's code."""
    rows = {r["doc_id"]: r for r in table(spark, sf_dir, "documents")}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    slow = SlowLanguages(rows.values())
    langs = {k: slow.predict(r["text"]) for k, r in rows.items()}
    texts = {k: r["text"] for k, r in rows.items() if langs[k][0] != "und" and langs[k][1] >= 0.34}
    by_source: dict[str, list[int]] = {}
    for k in texts:
        by_source.setdefault(rows[k]["source"], []).append(k)
    for ids in by_source.values():
        counts = Counter(line for k in ids for line in {x.strip(" ") for x in texts[k].split("\n")})
        n = len(ids)
        bad = {x for x, c in counts.items() if x and c > 1 and c > n * 0.05 + 3 * math.sqrt(n * 0.05 * 0.95)}
        for k in ids:
            texts[k] = "\n".join(x for x in texts[k].split("\n") if x.strip(" ") not in bad)
    shingles = {}
    for k, t in texts.items():
        words = re.sub("[A-Z]", lambda m: m[0].lower(), t).encode().split()
        shingles[k] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    first = {k: k for k in texts}

    def find(k):
        while first[k] != k:
            k = first[k]
        return k

    for a, b in itertools.combinations(sorted(texts), 2):
        if jaccard(shingles[a], shingles[b]) >= 0.8 - 1e-9:
            first[max(find(a), find(b))] = min(find(a), find(b))
    items = [regex.findall(r"[\p{L}\p{N}]+", r["text"].lower()) for r in table(spark, sf_dir, "benchmark") if r["text"]]
    items = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items if len(w) >= 5]

    def contains_item(text):
        w = regex.findall(r"[\p{L}\p{N}]+", text.lower())
        own = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        return any(len(s & own) >= 0.8 * len(s) - 1e-9 for s in items)

    kept = {k for k in texts if find(k) == k and not contains_item(texts[k])}
    assert set(got) == kept and 0 < len(kept) < len(rows)
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.word_vocabulary())
    for k in kept:
        r, ids = got[k], library.encode(texts[k], add_special_tokens=False).ids
        assert (r["text"], r["lang"], r["source"], r["n_chars"], r["n_tokens"], r["ids"]) == (texts[k], langs[k][0], rows[k]["source"], len(texts[k]), len(ids), ids)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
