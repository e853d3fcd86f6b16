"""Language, lines, benchmark items and encoding: edge cases and brute force."""

from __future__ import annotations

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftrail.llm import bpe, decontaminate, language_id, line_dedup, queries

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


# Language.


def test_language_of_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en", "s", 1) for i in range(40)] + [(100 + i, "le chat et le chien", "fr", "s", 1) for i in range(40)]
    rows += [(200, None, "en", None, None), (201, "", None, "s", 0), (202, "12 %% --", "fr", "s", 1), (None, "the dog", "en", "s", 1), (203, "chien " * 200_000, None, "s", 1), (203, "chien", None, "s", 1), (204, "chatte", None, "s", 1)]
    df = docs(spark, rows).withColumn("score", F.lit("old")).withColumn("a.b", F.lit(1))
    model = language_id.fit(df)
    out = language_id.identify(df, model)
    assert out.columns.count("score") == 1 and "a.b" in out.columns
    got = {(r["doc_id"], len(r["text"] or "")): (r["lang_pred"], r["score"]) for r in out.collect()}
    assert got[200, 0] == got[201, 0] == got[202, 8] == ("und", 0.0)
    assert got[None, 7][0] == "en" and got[203, 1_200_000][0] == got[203, 5][0] == "fr"
    assert got[204, 6][0] == "fr"  # unseen: known by its n-grams
    assert all(0 <= s <= 1 for _, s in got.values()) and out.count() == len(rows)


def test_nothing_learned(spark):
    empty = docs(spark, [])
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    assert language_id.keep_identified(docs(spark, [(1, "words", None, "s", 1)])).count() == 0


def test_learning_leaves_the_held_out_fold_alone(spark):
    rows = [(i, "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "seen", "en", "s", 1) for i in range(200)]
    model = language_id.fit(docs(spark, rows))
    assert set(model.words) == {"seen"} and all(g in "^seen$" for g in model.grams)
    marks = docs(spark, rows).select("text", language_id.held_out(F.col("doc_id")).alias("h")).distinct().collect()
    assert {(r["text"], r["h"]) for r in marks} == {("held", True), ("seen", False)}


def test_equal_scores_go_to_the_first_language():
    model = language_id.build({"b": {"x": 1}, "a": {"x": 1}})
    assert model.predict("x") == ("a", 0.5)


def test_words_without_end_are_read_whole(monkeypatch):
    a, b = "abcabbac", "xyzxyyzx"
    model = language_id.build({"a": {a: 5, a[::-1]: 5}, "b": {b: 5, b[::-1]: 5}})
    assert model.predict(a * 25 + b * 5000)[0] == "b" and model.predict(b * 25 + a * 5000)[0] == "a"
    model = language_id.build({"a": {"q" * 200 + a * 20: 1}, "b": {"q" * 200 + b * 20: 1}})
    assert model.predict(b)[0] == "b" and model.predict(a)[0] == "a"
    words = {"a": {a * 40: 2, "ab": 1}, "b": {b * 40: 3}}
    whole = language_id.build(words)
    score = whole._long_score(a * 90 + b * 41)
    monkeypatch.setattr(language_id, "BLOCK", 7)
    parts = language_id.build(words)
    assert parts.grams.keys() == whole.grams.keys()
    assert {g: tuple(parts.gram_scores[i]) for g, i in parts.grams.items()} == {g: tuple(whole.gram_scores[i]) for g, i in whole.grams.items()}
    assert parts._long_score(a * 90 + b * 41) == pytest.approx(score)
    assert parts.predict("abab") == whole.predict("abab")


def test_held_out_accuracy(spark, sf_dir):
    docs_ = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = queries.op10_language_id(spark, sf_dir).where("held_out").join(docs_.select("doc_id", "lang"), "doc_id")
    right, n = scored.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 20 and right >= 0.95


def test_clean_documents_are_kept(spark, sf_dir):
    kept = language_id.keep_identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert kept.count() >= 0.98 * spark.read.parquet(f"{sf_dir}/documents.parquet").count()


# Lines.


def test_lines(spark):
    rows = [(i, f"menu\nown {i}\n  menu \n\n", "en", "a", 1) for i in range(12)]
    rows += [(20, None, "en", "a", 1), (21, "", "en", "a", 1), (22, "menu\nmenu", "en", None, 1), (23, "menu", "en", "b", 1), (None, "menu\nlast", "en", "a", 1), (24, "menu", "en", "a", 1), (24, "menu", "en", "a", 1)]
    df = docs(spark, rows).withColumn("lines", F.lit("kept")).withColumn("HOST", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    out = line_dedup.drop_boilerplate(df, n_lines="n", n_dropped="d")
    got = {}
    for r in out.collect():
        got.setdefault((r["doc_id"], r["source"]), []).append((r["text"], r["n"], r["d"]))
    assert got[0, "a"] == [("own 0\n\n", 5, 2)]
    assert got[20, "a"] == [(None, 0, 0)] and got[21, "a"] == [("", 1, 0)]
    assert got[22, None] == [("menu\nmenu", 2, 0)] and got[23, "b"] == [("menu", 1, 0)]
    assert got[None, "a"] == [("last", 2, 1)] and got[24, "a"] == [("", 1, 1), ("", 1, 1)]
    assert out.columns == [*df.columns, "n", "d"]


@pytest.mark.parametrize(("pages", "least"), [(2, 2), (3, 2), (6, 2), (7, 3), (20, 4), (100, 12), (400, 34)])
def test_lines_at_the_bounds(spark, pages, least):
    """``least`` is the first number of pages above pages / 20 and three deviations of a line with that share."""
    for n, stays in ((least - 1, least - 1), (least, 0)):
        rows = [(i, "often" if i < n else f"x{i}", "en", "a", 1) for i in range(pages)]
        assert line_dedup.drop_boilerplate(docs(spark, rows)).where("text = 'often'").count() == stays


def test_single_pages_keep_their_lines(spark):
    df = docs(spark, [(i, f"line of {i}\nshared by all", "en", f"site{i}", 1) for i in range(30)])
    assert {r["text"] for r in line_dedup.drop_boilerplate(df).collect()} == {f"line of {i}\nshared by all" for i in range(30)}
    assert line_dedup.drop_boilerplate(docs(spark, [])).count() == 0


# Benchmark items.


def contained(text, item, threshold):
    def shingles(t):
        w = decontaminate.words(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    a, b = shingles(item), shingles(text)
    return bool(a) and len(a & b) >= threshold * len(a) - 1e-9


@pytest.mark.parametrize("most_words", [10_000_000, 50])
def test_every_contained_item_is_found(spark, most_words):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 6, 12, 40, 90])))) for i in range(25)]
    items += [(100, None), (101, ""), (None, "a b c d e f g"), (0, items[0][1]), (102, "Ä Ö ü ß é")]
    rows = []
    for d in range(120):
        words = rng.choices(vocabulary, k=rng.choice([0, 4, 30, 400]))
        for _ in range(rng.choice([0, 1, 2])):
            item = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 3, 9])):
                if item:
                    item[rng.randrange(len(item))] = rng.choice(vocabulary)
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
        rows.append((d, "  ".join(words).upper(), "en", "s", 1))
    rows += [(500, None, "en", "s", 1), (501, "x " * 50_000 + "a b c d e f g", "en", "s", 1), (None, "ä, ö! Ü (ß) É", "en", "s", 1), (0, rows[0][1], "en", "s", 1)]
    df = docs(spark, rows).withColumn("Matches", F.lit("old"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.find_items(df, bench, most_words=most_words)
    got = sorted((repr(r["doc_id"]), r["text"] or "", repr(sorted({m["item_id"] for m in r["matches"]}, key=repr))) for r in found.collect())
    want = sorted((repr(d), t or "", repr(sorted({i for i, x in items if contained(t, x, 0.8)}, key=repr))) for d, t, *_ in rows)
    assert got == want
    kept = decontaminate.drop_contaminated(df, bench, most_words=most_words)
    assert kept.count() == sum(1 for w in want if w[2] == "[]") and kept.columns == df.columns


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_items(docs(spark, [(1, "a b c d e f", "en", "s", 1)]), none).first()["matches"] == []
    assert decontaminate.find_items(docs(spark, []), none).count() == 0


@pytest.mark.parametrize("n", range(1, 200))
def test_a_sketch_has_one_hash_that_cannot_be_missing(n):
    assert n - decontaminate.needed(n, 0.8) < decontaminate.sketch_size(n, 0.8)


# Encoding.


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.word_vocabulary())


def test_encoding_equals_the_library(library, spark, sf_dir):
    own = bpe.WordBpe(queries.word_vocabulary(), cached_words=500)
    rng = random.Random(2)
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect()]
    texts += ["", "  \t\n", "<|endoftext|>a <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "ΑΣ ΣΑΣ", "İstanbul", "it's WE'RE 'S 'Ll 'd", "a" * 500, "aab" * 90, "éé", "日本語テスト😀👍🏽", "naïve—“quotes”… 1234 ½", " x y\x85z\x1fq"]
    texts += ["".join(rng.choice("abetnionre '<|>é😀") for _ in range(120)) for _ in range(150)]
    for text, words in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False)
        ids = [int(t) for w in words for t in w[1].split()]
        assert ids == want.ids, text
        assert " ".join(w[2] for w in words) == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_every_code_point(library):
    own = bpe.WordBpe(queries.word_vocabulary())
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(codes), 50_000):
        texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in codes[at : at + 50_000]]
        for text, words, want in zip(texts, own.encode(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert [int(t) for w in words for t in w[1].split()] == want.ids, hex(ord(text[1]))


def test_two_vocabularies_in_one_process(tmp_path):
    letters = list(bpe.byte_letters().values())
    vocab = {t: i for i, t in enumerate([*letters, *[x + "</w>" for x in letters], "ab", "cd</w>", "bc", "bcd</w>"])}
    for name, merges in (("one", ["a b", "c d</w>"]), ("two", ["b c", "bc d</w>"])):
        spec = {"model": {"end_of_word_suffix": "</w>", "vocab": vocab, "merges": merges}, "added_tokens": [], "pre_tokenizer": {"pretokenizers": [{"type": "Split", "pattern": {"Regex": r"[\p{L}]+"}}]}}
        (tmp_path / name).write_text(json.dumps(spec))
    one, two = (bpe.WordBpe(str(tmp_path / name)) for name in ("one", "two"))
    for coder, want in ((one, ["ab", "cd</w>"]), (two, ["a", "bcd</w>"]), (one, ["ab", "cd</w>"])):
        assert [coder.names[t] for t in coder.token_ids("abcd")] == want
        assert coder.token_ids("abcd") == coder.merged(coder.symbols(b"abcd"))


def test_query_equals_the_library(library, spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for k, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[k] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op7_bpe_round_trip(spark, sf_dir).collect()} == want


def test_pair_checks_decide(library):
    own = bpe.WordBpe(queries.word_vocabulary())
    words = [r for r in own.pieces("unbelievable incomprehensibilities thhaerble strengths aaaaaaaaaaa qzxv")]
    own.learn(words)
    for w in words:
        assert own.cache[w][1] == " ".join(map(str, own.merged(own.symbols(w.encode()))))
    assert own.bad.size  # some guesses were wrong and had to be merged exactly


def test_long_words_merge_alike(library):
    own = bpe.WordBpe(queries.word_vocabulary())
    rng = random.Random(7)
    for n in (39, 40, 41, 300):
        word = "".join(rng.choice("antheiol") for _ in range(n))
        assert own.token_ids(word) == library.encode(word, add_special_tokens=False).ids


def test_new_words_are_merged_together_and_seen_ones_not_again(library, monkeypatch):
    own, rng = bpe.WordBpe(queries.word_vocabulary()), random.Random(5)
    words = ["".join(rng.choice("antheiolsré") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    text = " ".join(words + [w.title() + rng.choice([",", ".", "!?", "'s", "1"]) for w in words])
    want = library.encode(text, add_special_tokens=False).ids
    for name in ("merged", "pieces"):  # the ways word by word and text by text
        monkeypatch.setattr(own, name, lambda *_: pytest.fail("one by one"))
    assert own.token_ids(text) == want
    monkeypatch.setattr(own, "learn", lambda *_: pytest.fail("again"))
    assert own.token_ids(text.replace(" ", "\n")) == want


def test_merging_in_arrays_equals_one_by_one(library):
    own, rng = bpe.WordBpe(queries.word_vocabulary()), random.Random(9)
    lengths = [1, 2, 3, 40, 41, bpe.ARRAYS_TO - 1, bpe.ARRAYS_TO, bpe.ARRAYS_TO + 1, *[rng.randint(1, 30) for _ in range(3000)], 700]
    raws = ["".join(rng.choice("aaantheiolsré") for _ in range(n)).encode()[:n] for n in lengths]
    symbols = [own.symbols(r) for r in raws]
    tokens, counts = own.merged_all(np.array([x for s in symbols for x in s]), np.array(lengths))
    at = 0
    for s, n in zip(symbols, counts.tolist(), strict=True):
        assert tokens[at : at + n].tolist() == own.merged(s)
        at += n
    assert at == len(tokens)


def test_stretches_give_the_words_of_the_whole_text(library):
    own, rng = bpe.WordBpe(queries.word_vocabulary(), cached_words=50), random.Random(11)
    odd = ["\x1c", "\x1f", "\u2000", "\u3000", "\x85", "\u0301", "J\u030c", "ΑΣ", "Σ", "<|endoftext|>", "<|", "\U0001f600", "\u1c89", "\ufacf", "İ", "ﬁ", "a" * 90, "it's", "x,", "y.", "!", "\0", "_" * 70]
    texts = ["".join(rng.choice([*odd, " ", " ", "\n", "the", "Word"]) for _ in range(60)) for _ in range(400)]
    for text, ids in zip(texts, own.tokens(texts), strict=True):
        want = library.encode(text, add_special_tokens=False)
        assert ids.tolist() == want.ids, text
        assert b"".join(own.id_pieces(ids)).decode() == " ".join(map(str, want.ids))
        assert b"".join(own.name_pieces(ids)).decode() == library.decode(want.ids, skip_special_tokens=False)
    assert max(map(len, own.stretches)) <= 64


def test_words_that_reach_over_white_space(tmp_path):
    letters = list(bpe.byte_letters().values())
    vocab = {t: i for i, t in enumerate([*letters, *[x + "</w>" for x in letters]])}
    for pattern, apart in ((r" ?[\p{L}]+", False), (r"[\p{L}]+(?=\s)|.", False), (r"[\p{L}]+", True)):
        spec = {"model": {"end_of_word_suffix": "</w>", "vocab": vocab, "merges": []}, "added_tokens": [], "pre_tokenizer": {"pretokenizers": [{"type": "Split", "pattern": {"Regex": pattern}}]}}
        (tmp_path / "v").write_text(json.dumps(spec))
        own = bpe.WordBpe(str(tmp_path / "v"))
        assert own.apart is apart
        for text in ("ab cd 12, ef", "12", " "):
            assert own.token_ids(text) == [t for w in own.pieces(text) for t in own.symbols(w.encode())]


def test_long_token_ids_and_names(library):
    own = bpe.WordBpe(queries.word_vocabulary())
    ids = np.array(sorted(own.names) * 2, np.int32)  # more than one piece, long names among them
    assert b"".join(own.id_pieces(ids)).decode() == " ".join(map(str, ids))
    assert b"".join(own.name_pieces(ids)).decode() == own.decode(ids.tolist())
    assert len(list(own.id_pieces(ids))) > 1


def test_encoding_of_edge_rows(spark):
    df = docs(spark, [(1, None, "en", "s", 1), (1, None, "en", "s", 1), (2, "", "en", None, None), (None, "The cat", "en", "s", 1)]).withColumn("ids", F.lit("old"))
    out = bpe.encode_decode(df, queries.word_vocabulary)
    got = [(r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in out.collect()]
    assert got[:3] == [(1, 0, [], ""), (1, 0, [], ""), (2, 0, [], "")]
    assert got[3] == (None, 2, [518, 2368], "the</w> cat</w>")
    digest = bpe.encode_decode(df, queries.word_vocabulary, ids="i", decoded="d", digests=True).collect()[3]
    assert digest["i"] == hashlib.sha256(b"518 2368").hexdigest() and digest["d"] == hashlib.sha256(b"the</w> cat</w>").hexdigest()
    assert bpe.encode_decode(docs(spark, []), queries.word_vocabulary).count() == 0
