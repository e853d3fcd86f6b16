"""Filter audit, language-model scores and ranked search against slow versions of their own."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftrail.llm import filter_audit, lexical, lm_score, queries

WORDS = ["the", "The", "of", "été", "naïve", "中文", "x1", "A", "#tag", "BIG", "\x1c\x1d", "a b", "🙂"]


def documents(seed, n=80):
    rng = random.Random(seed)
    texts = [rng.choice([" ", "\n", "\t\x0b", "  "]).join(rng.choices(WORDS + [f"w{k}" for k in range(rng.choice([3, 200]))], k=rng.choice([0, 1, 5, 99, 100, 150]))) for _ in range(n)]
    texts += [texts[0], texts[1], texts[1], "", None, None, " ", "\n"]
    rows = [(i, t, rng.choice(["en", "fr", "", None])) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (None, texts[0], "en"), (None, "alone", "en"), rows[3], rows[3]]


SCHEMA = "doc_id long, text string, lang string"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_audit(rows, labels):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    counts, taken = {}, Counter()
    for i, t, lang in rows:
        t, part, words = t or "", lang or "", split(t)
        first = smallest.get(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": first is not None and (i is None or i > first)}
        good = any(q == 1 for d, q, _ in labels if d == i and i is not None)
        toxic = any(x == 1 for d, _, x in labels if d == i and i is not None)
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, x in enumerate(order, 1):
                c = counts.setdefault((part, order, step), Counter())
                here = fails[x] and not gone
                c.update({"kept": not gone and not fails[x], "removed": here, "redundant": fails[x] and gone, "unique_fails": fails[x] and sum(fails.values()) == 1, "good_lost": here and good, "toxic_lost": here and toxic})
                taken[part, x] += here
                gone |= fails[x]
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return {(*k, *[c[n] for n in names], taken[k[0], k[1][k[2] - 1]]) for k, c in counts.items()}


@pytest.mark.parametrize("seed", [0, 1])
def test_audit(spark, seed):
    rows = documents(seed)
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 60)] + [(0, 1, 0), (0, 0, 0), (None, 1, 1), (5, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("first", F.lit(3)).withColumn("A", F.lit("x")).withColumn("mask", F.lit(1))
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in got.select(*names).collect()} == slow_audit(rows, labels)


def test_audit_of_three_filters_and_of_nothing(spark):
    failed = spark.createDataFrame([("p", True, False, True, True), ("p", False, False, False, False)], "part string, X boolean, Y boolean, Z boolean, bad boolean")
    got = filter_audit.replay(failed, "XYZ", losses=("bad",)).where("filter_order = 'ZYX'").orderBy("step").select("step", "kept", "removed", "redundant", "unique_fails", "bad_lost", "shapley").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, 0, 0, 1, 3), (2, 1, 0, 0, 0, 0, 0), (3, 1, 0, 1, 0, 0, 3)]
    assert filter_audit.replay(failed.limit(0), "XYZ", losses=("bad",)).count() == 0


def test_audit_combines_counts_before_the_exchange(spark, sf_dir):
    plan = queries.op11_filter_audit(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "partial_count" in plan and "Python" not in plan


def slow_base(rows):
    tok = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in split(t)] + [None]
    counts = Counter()
    for i, t, _ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update(tok(t))
    n, v = sum(counts.values()), len(counts)
    return [(i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(tok(t)), sum(counts[w] > 0 for w in tok(t)), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tok(t))) for i, t, _ in rows]


def test_shards_answer_all_chunks_at_once(spark, monkeypatch):
    """A shard's bits are not joined to what each chunk asks; parts of a shard's answers give equal scores."""
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 700)
    docs = spark.createDataFrame(documents(3), SCHEMA).select("doc_id", "text").repartition(3)
    model = lm_score.fit(docs)
    one = sorted((repr(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm_score.score(docs, model).collect())
    sums = spark.sparkContext.broadcast(lm_score._Sums(model.n_tokens, model.n_words, model.n_texts, model.prior, model.scale, lm_score._common(model)))
    for asked in (1 << 25, 1000):
        monkeypatch.setattr(lm_score, "ASKED", asked)
        found = lm_score._by_shards(docs.withColumnRenamed("text", "t"), model, sums, chunk_bytes=500)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and plan.count("CoGroup") == 2
        assert one == sorted((repr(r["doc_id"]), r["n_tokens"], r["score"]) for r in found.collect())
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()  # texts are exchanged once


@pytest.mark.parametrize(("seed", "common"), [(0, 1 << 22), (1, 40), (2, 1)])
def test_scores_in_one_scan_and_by_shards(spark, monkeypatch, seed, common):
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 700)
    rows = documents(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("row", F.lit(1)).withColumn("score", F.lit("old")).withColumn("c0", F.lit(2))
    model = lm_score.fit(docs, common=common)
    assert model.n_shards > 1 and model.shards.count() == model.n_shards
    key = lambda r: (repr(r["doc_id"]), r["n_tokens"], round(r["score"], 9))
    one = sorted(lm_score.score(docs, model).collect(), key=key)
    many = sorted(lm_score.score(docs, model, broadcast_bytes=0).collect(), key=key)
    assert one[0].asDict().keys() == {"doc_id", "lang", "row", "c0", "n_tokens", "n_known", "train_tokens", "base_score", "score"}
    assert [(r["doc_id"], r["score"], round(r["base_score"], 9), r["n_known"]) for r in one] == [(r["doc_id"], r["score"], round(r["base_score"], 9), r["n_known"]) for r in many]
    got = sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 8)) for r in one)
    assert got == sorted((repr(i), n, known, total, round(base, 8)) for i, _, n, known, total, base in slow_base(rows))


def test_score_is_the_smoothed_probability_of_quantised_counts(spark):
    rows = documents(7)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = lm_score.fit(docs, bits_per_event=200.0, probes=12, prior=3.0)  # so large that nothing is read too high
    single, pair, texts = Counter(), Counter(), 0
    tok = lambda t: [*map(bytes.lower, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())), b""]
    for i, t, _ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            single.update(tok(t))
            pair.update(zip([None, *tok(t)], tok(t)))
            texts += 1

    def level(c):
        """The middle of the whole numbers from one power of 1.5 to the next."""
        q = 0
        while math.ceil(1.5**q) <= c:
            q += 1
        return (math.ceil(1.5 ** (q - 1)) + math.ceil(1.5**q) - 1) / 2 if c else 0.0

    size = sum(single.values()) + 0.1 * (len(single) + 1)
    want = []
    for i, t, _ in rows:
        total = 0.0
        for h, w in zip([None, *tok(t)], tok(t)):
            context = texts if h is None else level(single[h])
            total += math.log10((min(level(pair[h, w]), context) + 3.0 * min((level(single[w]) + 0.1) / size, 1.0)) / (context + 3.0))
        want.append((repr(i), round(total, 7)))
    got = lm_score.score(docs, model)
    assert sorted((repr(r["doc_id"]), round(r["score"], 7)) for r in got.collect()) == sorted(want)


def test_counts_are_read_too_high_rarely_and_never_too_low():
    rng = np.random.default_rng(0)
    grams, counts = lm_score.mixed(np.arange(200_000, dtype=np.uint64)), rng.geometric(0.4, 200_000)
    scale = lm_score.Scale()
    bits = lm_score._filled(grams, counts, scale, 10.0, 5)
    bloom = lm_score.Bloom(np.zeros(1, np.int64), np.array([8 * len(bits)], np.uint64), bits, 5)
    read = bloom.levels(grams)
    assert (read >= scale.level(counts)).all() and (read > scale.level(counts)).mean() < 0.015
    assert (bloom.levels(lm_score.mixed(np.arange(300_000, 400_000, dtype=np.uint64))) > 0).mean() < 0.015


def test_held_out_documents_are_scored_better_than_by_words_alone(spark, sf_dir):
    got = queries.op12_lm_score(spark, sf_dir).groupBy("held_out").agg((F.sum("score") / F.sum("n_tokens")).alias("s"), (F.sum("base_score") / F.sum("n_tokens")).alias("b")).collect()
    assert len(got) == 2 and all(r["s"] > r["b"] for r in got)


def test_reader_hashes_words_of_any_length():
    import pyarrow as pa

    texts = ["a" * 300 + " B c", None, "x" * (lm_score.PIECE + 5) + " y " + "z" * 7, "", "é c b " * 200_000]
    got = lm_score.Reader().read(pa.array(["skip", *texts], pa.string()).slice(1))
    flat = [w for t in texts for w in lm_score.tokens_of(t)]
    assert got.words(np.arange(len(got.own))) == flat and len(got.first) == len(texts)
    seen = {}
    assert all(seen.setdefault(w, h) == h for w, h in zip(flat, got.own.tolist())) and len(set(seen.values())) == len(seen)


def slow_search(rows, items):
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    find = lambda t: re.findall(term, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(i, Counter(find(t))) for i, t, _ in rows if find(t)]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            total = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(find(text)) if w in c)
            if total > 0:
                scored.append((-total, i is None, i))
        out += [(repr(item), r, repr(i), -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("most", [0, 1000])
def test_search(spark, most):
    rows = documents(5, 120)
    items = [(1, "the THE w1 w2 w3-w4"), (2, ""), (3, None), (None, "中文 naïve"), (4, "nowhere"), (5, "été x1 w7 w7"), (5, "of tag")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("term", F.lit("the")).withColumn("tf", F.lit(9))
    terms = lexical.written(lexical.item_terms(spark.createDataFrame(items, "item_id long, text string").repartition(2)), "terms")
    found = lexical.index(docs, terms, most_terms=most)
    assert found.vocabulary is (most > 0)
    got = lexical.search(found, terms, most_rows=most).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted((repr(r[0]), r[1], repr(r[2]), r[3]) for r in got) == slow_search(rows, items)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.rank_documents(none, items).count() == lexical.rank_documents(some, items.limit(0)).count() == 0


def test_long_documents_have_lengths_beyond_64_bits(spark):
    n = spark.createDataFrame([(5,), (10**11,)], "n long")
    got = [r[0] for r in n.select(lexical._length_part("n", 10**10, 10**13)).collect()]
    assert got == [10 + 90 * k * 10**10 // 10**13 for k in (5, 10**11)]


def test_texts_are_read_in_slices_of_bounded_bytes(monkeypatch):
    import pyarrow as pa

    from siftrail.llm import lm_score

    monkeypatch.setattr(lm_score, "READ", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["abcd", None, "efgh", "ij", "k" * 30, "", "l"])], names=["i", "t"])
    assert [b.column(0).to_pylist() for b in lm_score.bounded([batch, batch.slice(0, 0)], 1)] == [[0, 1, 2, 3], [4], [5, 6]]
