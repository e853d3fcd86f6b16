"""Near-duplicates and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from siftrail.llm import components, near_copies, repeats, simhash

DOC = "doc_id long, text string, source string"


def slow_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(parent, 2):
        if (a ^ b).bit_count() <= 4:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("text", ["", None, "one", "One two THREE", "a b c d", "A\tb\x0bc\x0cd\re", "Ä ä É x y z", "x " * 3000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


def test_two_errors_share_a_key():
    _, errors = simhash.error_tables()
    words = errors[:, 0]
    keys = simhash.word_keys(words)
    flips = [1 << i for i in range(23)] + [1 << i | 1 << j for i, j in itertools.combinations(range(23), 2)]
    for flip in flips:
        assert (keys[:, :, None] == simhash.word_keys(words ^ flip)[:, None, :]).any((1, 2)).all()


def test_four_errors_share_a_pair_of_keys():
    rng = random.Random(0)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        both = np.array([a, b], np.uint64).view(np.int64)
        keys, owners = simhash.fingerprint_keys(both)
        assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())


def near_prints(rng, n):
    out = []
    for _ in range(n):
        p = rng.choice(out) if out and rng.random() < 0.7 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.choice([0, 1, 3, 4, 5, 7])):
            p ^= 1 << bit
        out.append(p)
    return out


@pytest.mark.parametrize("sizes", [{}, {"run_rows": 5, "block_rows": 3}])
def test_classes_equal_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    dense = rng.getrandbits(64)
    prints = near_prints(rng, 400) + [dense ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(1, 64, 5)] + [0, 0]
    rows = [(i, int(np.array([p], np.uint64).view(np.int64)[0])) for i, p in enumerate(prints)]
    table = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r["fp"] % (1 << 64): r["component_id"] for r in simhash.classes(table, "doc_id", "fp", **sizes).collect()}
    roots = slow_components(set(prints))
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(roots[p], i)
    assert got == {p: first[roots[p]] for p in prints}


def test_near_duplicates_of_edge_rows(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(5, text, "a"), (3, text.upper(), None), (9, text, "a"), (9, text, "a"), (None, text, "a"), (7, None, "a"), (8, "", "b"), (6, " \t", "b"), (1, "something else entirely", "b"), (None, "only this one here now", "b")]
    df = spark.createDataFrame(rows, DOC).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(0))
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    got = sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (9, 3), (None, 3), (7, 6), (8, 6), (6, 6), (1, 1), (None, None)], key=repr)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([3, 6, 1, None], key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_one_of_repeated_firsts_stays(spark):
    df = spark.createDataFrame([(1, "same text here for all", "a")] * 4, DOC)
    assert simhash.keep_first(df).count() == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 120), (300, 120)] + [(500, 500 + i) for i in range(1, 40)]
    df = spark.createDataFrame([*edges, (None, 4)], "u long, v long").repartition(7)
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 120: 120, 150: 120, 200: 120, 300: 120} | {500 + i: 500 for i in range(40)}
    assert components.components(df.limit(0)).count() == 0


# Repeated passages.


def slow_repeats(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            piece = data[at : at + length]
            if piece in seen:
                gone[at : at + length] = True
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc] = (len(data), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest())
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([99, 100, 101, 150, 400]))) for _ in range(10)]
    rows = []
    for i in range(90):
        parts = [rng.choice(shared)[rng.choice([0, 0, 3, 50]) :] if rng.random() < 0.5 else "".join(rng.choice("xyzü ") for _ in range(rng.randrange(300))) for _ in range(rng.randrange(6))]
        rows.append((i, "".join(parts)))
    rows += [(1000, "a" * 500), (1001, "a" * 350), (1002, None), (1003, ""), (None, shared[0] + "q"), (1004, "ab" * 200), (1005, "x" * 99), (1006, "hhhi" * 100), (1007, "x" * 100), (1008, "x" * 100)]
    return rows


@pytest.mark.parametrize("options", [{}, {"group_rows": 3}, {"length": 60}, {"length": 200}])
def test_repeats_equal_brute_force(spark, options):
    rows = passages(len(options))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit("old")).repartition(5)
    found = repeats.remove_repeats(df, **options)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.digest(found).collect()}
    assert got == slow_repeats(rows, options.get("length", 100))
    for r in found.collect():
        assert r["n_bytes"] == len(r["kept"]) + sum(s["end"] - s["start"] for s in r["removed"])


def test_rows_that_repeat_an_id(spark):
    rng = random.Random(1)
    one, other = ("".join(rng.choice("abcd") for _ in range(150)) for _ in range(2))
    rows = [(1, one), (1, one), (2, one + other), (2, other)]
    got = sorted(map(tuple, repeats.digest(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).select("doc_id", "n_bytes", "n_removed").collect()))
    assert got[:2] == [(1, 150, 0), (1, 150, 0)]  # one document twice
    removed = {n: r for _, n, r in got[2:]}
    assert removed in ({150: 0, 300: 300}, {150: 150, 300: 150})  # the hash of their texts says which comes first
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_rows_without_an_id(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    others = [(None, "".join(rng.choice("abcdefgh ") for _ in range(150))) for _ in range(300)]
    df = spark.createDataFrame([(None, text)] * 5000 + others, "doc_id long, text string")
    got = repeats.digest(repeats.remove_repeats(df)).groupBy("n_bytes", "n_removed").count().collect()
    assert {tuple(r) for r in got} == {(2000, 0, 5000), (150, 0, 300)}


def test_long_text_over_blocks(monkeypatch):
    rng = random.Random(3)
    data = bytes(rng.choice(b"abc ") for _ in range(5000))
    whole = [(t, s, n) for ts, ss, ns in repeats.cut_phrases(data) for t, s, n in zip(ts.tolist(), ss.tolist(), ns.tolist(), strict=True)]
    monkeypatch.setattr(repeats, "BLOCK", 700)
    parts = [(t, s, n) for ts, ss, ns in repeats.cut_phrases(data) for t, s, n in zip(ts.tolist(), ss.tolist(), ns.tolist(), strict=True)]
    spread = lambda rows: {s + k: t for t, s, n in rows for k in range(n)}
    assert spread(whole) == spread(parts) and len(spread(whole)) == len(data) - 99


# Near copies of the pipeline's stage.


def edited(rng, words, share):
    """A copy with ``share`` of its words replaced at one place."""
    n = max(1, int(len(words) * share))
    at = rng.randrange(len(words) - n)
    return [*words[:at], *(f"new{rng.random()}" for _ in range(n)), *words[at + n :]]


@pytest.mark.parametrize("sizes", [{}, {"run_rows": 8, "block_rows": 5, "block_shingles": 900}])
def test_stage_takes_copies_of_similarity_080(spark, sizes):
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 150, 400]))]
        texts += [" ".join(words), *(" ".join(edited(rng, words, share)) for share in (0.02, 0.05, 0.08, 0.3))]
    texts += [" ".join(edited(rng, texts[0].split(), 0.03)) for _ in range(20)]
    texts += ["", None, " \t", "one two", "ONE  two", "one two three", "x " * 9, "x " * 50, texts[3], texts[3].upper()]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [near_copies.shingles(t) for t in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        if near_copies.similarity(sets[i], sets[j]) >= 0.8:
            root[max(find(i), find(j))] = min(find(i), find(j))
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], DOC).withColumn("mark", F.lit(1)).withColumn("root", F.lit(1)).repartition(5)
    out = near_copies.keep_first(df, **sizes)
    got, want = {r["doc_id"] for r in out.collect()}, {find(i) for i in range(len(texts))}
    assert out.columns == df.columns and want <= got  # what is no near copy stays
    assert len(got - want) <= 0.04 * (len(texts) - len(want))  # and nearly all that is goes
    assert got == {r["doc_id"] for r in corpus_pipeline.near_copies(spark, df, "").collect()}


def test_stage_on_ties_and_nulls(spark):
    text = "some words that are the same in all of these rows here"
    df = spark.createDataFrame([(None, text, "a"), (2, text, "b"), (2, text, "c"), (2, text, "c"), (None, "alone with other words in it", "a"), (3, None, None), (4, "", None)], DOC)
    kept = near_copies.keep_first(df).collect()
    assert sorted((repr(r["doc_id"]) for r in kept)) == ["2", "3", "None"]
    assert near_copies.keep_first(df.limit(0)).count() == 0


def test_recall_of_candidates(spark, sf_dir):
    """Of the near copies among the sample documents, those that share a bucket, by brute force over all pairs."""
    rows = spark.read.parquet(f"{Path(sf_dir).parent}/sf0.01/documents.parquet").collect()
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["source"]) for r in rows], DOC)
    kept = {r["doc_id"] for r in near_copies.keep_first(df).collect()}
    sets = {r["doc_id"]: near_copies.shingles(r["text"]) for r in rows}
    owners: dict[bytes, list[int]] = {}
    for k, s in sets.items():
        for x in s:
            owners.setdefault(x, []).append(k)
    pairs = {p for o in owners.values() for p in itertools.combinations(sorted(o), 2)}
    near = [(a, b) for a, b in pairs if near_copies.similarity(sets[a], sets[b]) >= 0.8]
    assert len(near) > 20
    assert sum(b not in kept for _, b in near) >= 0.95 * len(near)
    alike = {x for p in near for x in p}
    empty = sorted(k for k, s in sets.items() if not s)
    assert all(k in kept for k in sets if k not in alike and k not in empty[1:])
