"""Near copies by SimHash, verified by the share of five-word shingles they have in common.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is 0.8 or
more; near copies of near copies are one group. Candidates come from ``simhash``: every distinct text
has two 64-bit fingerprints, one of its distinct words and one of its distinct five-word shingles, and
texts may be near copies if they differ in at most 14 and 18 bits of them. Both fingerprints are cut
into segments of 23, 23 and 18 bits and decoded to Golay codeword indices; pairs of segments are the
keys. Candidates are linked along trees, so a large group costs no more than its members.

What the trees connect is a bucket. The texts of a bucket are brought together and compared by their
sets of shingles, in blocks of bounded size, two blocks at a time; texts that are connected already are
not compared again. So what is linked is verified, and what candidates do not connect is not found:
the README gives the measured recall.

Edge cases: words lie between ASCII white space, and A-Z count as a-z. Texts with fewer than five
words have their whole sequence as one shingle. Null texts and those without words are one group.
Texts of the same words are one, so exact copies cost nothing. Rows without an id stay only if no row of
their group has one; of rows with the smallest id the one whose row hash is least stays. Very long texts
are read whole. Other columns pass through, whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import add_columns, col, free_name, map_batches, written
from siftrail.llm.components import components, first_of_each
from siftrail.llm.simhash import SEGMENTS, Rule, links, majority, word_keys

SIZE = 5
MOST_WORDS, MOST_SHINGLES = 14, 18
ODD = np.int64(0x5851F42D4C957F2D)
PAIR = "u bigint, v bigint"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and white space only


def shingles(text: str | None) -> set[bytes]:
    found = words(text)
    if len(found) <= SIZE:
        return {b" ".join(found)} if found else set()
    return set(map(b" ".join, zip(*[found[i:] for i in range(SIZE)], strict=False)))


def similarity(a: set[bytes], b: set[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def pair_keys(fps: np.ndarray, first_kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of two segments' codeword indices each, and the places of the fingerprints they belong to."""
    bits = np.ascontiguousarray(fps).view(np.uint64)
    keys = [word_keys((((bits >> np.uint64(a)) & np.uint64((1 << n) - 1)) << np.uint64(up)).astype(np.int64)) for a, n, up in SEGMENTS]
    many = [k[:, 1] != k[:, 0] for k in keys]
    all_keys, owners = [], []
    for kind, (a, b) in enumerate(((0, 1), (0, 2), (1, 2)), first_kind):
        for i in range(6):
            for j in range(6):
                has = np.flatnonzero((many[a] | (i == 0)) & (many[b] | (j == 0)))
                all_keys.append(kind << 24 | keys[a][has, i] << 12 | keys[b][has, j])
                owners.append(has)
    return np.concatenate(all_keys), np.concatenate(owners)


def two_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = [pair_keys(fps[:, i], 3 * i) for i in (0, 1)]
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def two_ids(fps: np.ndarray) -> np.ndarray:
    """One number for two fingerprints; texts that share it share a bucket and are told apart there."""
    mixed = (fps[:, 0] ^ (fps[:, 0].view(np.uint64) >> np.uint64(29)).view(np.int64)) * ODD + fps[:, 1]
    return mixed ^ (mixed.view(np.uint64) >> np.uint64(32)).view(np.int64)


TWO_PRINTS = Rule((MOST_WORDS, MOST_SHINGLES), two_keys, lambda fps: two_ids(np.ascontiguousarray(fps)))


def sketch(text: str | None) -> tuple[int, int, int, int, int]:
    """The mark of a text's words, its two fingerprints, their id, and its number of distinct shingles."""
    found = words(text)
    hashed = xxhash.xxh64_intdigest
    parts = shingles(text)
    fps = np.array([[majority([hashed(w) for w in set(found)]), majority([hashed(s) for s in parts])]], np.int64)
    mark = int(np.uint64(hashed(b" ".join(found))).astype(np.int64))
    return mark, int(fps[0, 0]), int(fps[0, 1]), int(two_ids(fps)[0]), len(parts)


def _verify(threshold: float):  # noqa: ANN202
    """Over (pair, mark, side, text) sorted by pair: links that connect the near copies of each pair of blocks."""

    def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    def near(marks: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        order = sorted(range(len(marks)), key=lambda i: (len(sets[i]), marks[i]))
        root = list(range(len(marks)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        found = []
        for at, i in enumerate(order):
            top = len(sets[i]) / threshold + 1e-9
            for j in order[at + 1 :]:
                if len(sets[j]) > top:
                    break
                if find(i) == find(j):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    root[find(i)] = find(j)
                    found.append((marks[i], marks[j]))
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, marks, sets, found = None, [], [], []
        for batch in batches:
            for key, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != pair:
                    found += near(marks, sets)
                    pair, marks, sets = key, [], []
                    if len(found) > 10_000:
                        yield out(found)
                        found = []
                marks.append(mark)
                sets.append(np.unique(np.array([xxhash.xxh64_intdigest(s) for s in shingles(text)], np.uint64)))
        found += near(marks, sets)
        if found:
            yield out(found)

    return run


def near_links(marked: DataFrame, threshold: float = 0.8, block_shingles: int = 200_000, **sizes: int) -> DataFrame:
    """Links (u, v) between marks that connect near copies among written (mark, f0, f1, id, n, text) rows."""
    prints = marked.select("f0", "f1").distinct()
    buckets = components(links(prints, TWO_PRINTS, **sizes)).select(F.col("node").alias("id"), "root")
    texts = marked.groupBy("id", "mark").agg(F.min("n").cast("bigint").alias("n"))
    members = written(texts.join(buckets, "id", "left").select("mark", "n", F.coalesce("root", "id").alias("root")), "members")
    several = members.groupBy("root").agg(F.count("*").alias("rows"), F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks")).where("rows > 1")
    dealt = members.join(written(several, "buckets"), "root").withColumn("own", F.pmod(F.xxhash64("mark"), F.greatest("blocks", F.lit(1))).cast("int"))
    pairs = F.expr("transform(sequence(0, greatest(blocks, 1) - 1), i -> struct(root, least(i, own) AS lo, greatest(i, own) AS hi))")
    dealt = written(dealt.select("mark", F.explode(pairs).alias("pair")).select("mark", F.xxhash64("pair").alias("pair")), "pairs")
    wanted = dealt.select("mark").distinct()
    one = marked.select("mark", "text").join(wanted.hint("merge"), "mark", "left_semi").groupBy("mark").agg(F.first("text").alias("text"))
    both = dealt.join(written(one, "texts"), "mark").select("pair", "mark", "text")
    # Written, as two Python functions in one task would keep twice as many workers alive.
    return written(map_batches(both.repartition("pair").sortWithinPartitions("pair"), _verify(threshold), PAIR), "near")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, **sizes: int) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest id."""
    added = {n: free_name(docs, n) for n in ("mark", "f0", "f1", "id", "n")}
    marked = written(add_columns(docs, text, lambda: sketch, [(name, "bigint") for name in added.values()]), "marks")
    plain = marked.select(*[col(name).alias(n) for n, name in added.items()], col(text).alias("text"))
    found = components(near_links(plain, threshold, **sizes)).select(F.col("node").alias("mark"), "root")
    roots = plain.select("mark").distinct().join(found, "mark", "left").select("mark", F.coalesce("root", "mark").alias("root"))
    return first_of_each(marked, roots, added["mark"], doc_id).select(*[col(c) for c in docs.columns])
