"""Near-duplicates by SimHash: Golay codewords near the segments of a fingerprint are its keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The perfect Golay code has one
codeword within three bits of any 23-bit word; a word three bits off also takes the five codewords
that are four bits off. So a word has one key or six, and two words that differ in at most two bits
have a key in common. Of four differing bits, either no segment has three or more: then a key of all
three segments is common. Or one has: then the others differ in one bit at most, and one of them as it
stands, with a key of the other, is common. So fingerprints that may link meet under a key of 35 or 36
bits, 180 for each fingerprint on average, and are verified there, bit by bit. Among n random
fingerprints a key has some 2e-9 n of them.

Distinct fingerprints are keyed, so exact copies cost nothing. Under one pair of keys, fingerprints
are linked along a tree and not pair by pair: that leaves the components as they are. Keys with
more than ``run_rows`` fingerprints are set aside and compared in blocks, two blocks at a time, which
gives the same components.

Edge cases: a null text, or one without words, has fingerprint zero and links like any other.
Documents with fewer than four words have their whole sequence as one shingle. Rows without an id
get the component of their fingerprint; a component without any id has a null one. Repeated rows
share a component; of rows with the smallest id ``keep_first`` keeps the one whose row hash is least.
Very long texts are hashed whole, in parts. Other columns are ignored, or kept by ``keep_first``, whatever
their names. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate, combinations, permutations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import add_columns, col, free_name, map_batches, written
from siftrail.llm.components import components, first_of_each

SHINGLE, SEED, MOST_BITS = 4, 42, 4
GOLAY = 0xC75  # the code's generator polynomial, a fixed value
SEGMENTS = ((0, 23, 0), (23, 23, 0), (46, 18, 5))  # first bit, bits, and how far up they stand in the word
SHORT_RUN = 32


def shingle_hashes(text: str | None, size: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of the shingles of a text, repeats included; A-Z count as a-z."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return []
    hashed = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= size:
        return [hashed(joined, seed)]
    ends = list(accumulate([len(w) + 1 for w in words]))
    return [hashed(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)]


def fingerprint(text: str | None) -> int:
    return majority(shingle_hashes(text))


def majority(hashes: list[int]) -> int:
    """64 bits as a signed number; a bit is set if it is in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    return add_columns(docs, text, lambda: lambda t: (fingerprint(t),), [(name, "bigint")])


# The code.


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - 11)
    return word


@cache
def error_tables() -> tuple[np.ndarray, np.ndarray]:
    """For the 12 upper bits their share of the syndrome; for each syndrome the errors to undo.

    A row has the one error of up to three bits and, if it has three, the five of four bits.
    """
    upper = np.array([_syndrome(i << 11) for i in range(1 << 12)], np.int64)
    single = [_syndrome(1 << i) for i in range(23)]
    errors: list[list[int]] = [[] for _ in range(1 << 11)]
    for n in range(5):
        for places in combinations(range(23), n):
            s = 0
            for p in places:
                s ^= single[p]
            if not errors[s] or n == 4 and errors[s][0].bit_count() == 3:
                errors[s].append(sum(1 << p for p in places))
    return upper, np.array([e + [e[0]] * (6 - len(e)) for e in errors], np.int64)


def word_keys(words: np.ndarray) -> np.ndarray:
    """The six codeword indices of each 23-bit word, the first one again if there is no other."""
    upper, errors = error_tables()
    syndromes = upper[words >> 11] ^ (words & 0x7FF)
    return (words[:, None] ^ errors[syndromes]) >> 11


def fingerprint_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of fingerprints, and the places of the fingerprints they belong to.

    Kind 0 has a codeword index of each segment. Kinds 1 to 6 have one segment as it stands and a
    codeword index of another.
    """
    bits = fps.view(np.uint64)
    words = [(((bits >> np.uint64(a)) & np.uint64((1 << n) - 1)) << np.uint64(up)).astype(np.int64) for a, n, up in SEGMENTS]
    keys = [word_keys(w) for w in words]
    many = [k[:, 1] != k[:, 0] for k in keys]
    all_keys, owners = [], []
    for i, j, k in product(range(6), repeat=3):
        has = np.flatnonzero((many[0] | (i == 0)) & (many[1] | (j == 0)) & (many[2] | (k == 0)))
        all_keys.append(keys[0][has, i] << 24 | keys[1][has, j] << 12 | keys[2][has, k])
        owners.append(has)
    for kind, (a, b) in enumerate(permutations(range(3), 2), 1):
        for i in range(6):
            has = np.flatnonzero(many[b] | (i == 0))
            all_keys.append(kind << 36 | words[a][has] << 12 | keys[b][has, i])
            owners.append(has)
    return np.concatenate(all_keys), np.concatenate(owners)


# Links under one key.


@dataclass(frozen=True)
class Rule:
    """What links two rows of fingerprints: at most ``most`` differing bits in each of them.

    ``keys`` gives keys that linked rows have in common, with the rows they belong to; ``ids`` names rows.
    """

    most: tuple[int, ...]
    keys: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    ids: Callable[[np.ndarray], np.ndarray]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (np.bitwise_count((a ^ b).view(np.uint64)) <= np.array(self.most)).all(axis=-1)

    def columns(self) -> list[str]:
        return [f"f{i}" for i in range(len(self.most))]

    def schema(self, *before: str) -> str:
        return ", ".join(f"{name} bigint" for name in [*before, *self.columns()])


ONE_PRINT = Rule((MOST_BITS,), lambda fps: fingerprint_keys(np.ascontiguousarray(fps[:, 0])), lambda fps: fps[:, 0])


def _table(batch: pa.RecordBatch, first: int = 0) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[first:]], axis=1)


def _emit_keys(rule: Rule) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _table(batch)
            keys, owners = rule.keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(c) for c in fps[owners].T]], names=["key", *rule.columns()])

    return run


def _ones(fps: np.ndarray) -> np.ndarray:
    """The number of set bits of each row's first fingerprint."""
    return np.bitwise_count(np.ascontiguousarray(fps[:, 0]).view(np.uint64)).astype(np.int64)


def tree_links(fps: np.ndarray, rule: Rule = ONE_PRINT) -> tuple[list[int], list[int]]:
    """Links that connect what is connected among rows of fingerprints, one for each new row reached.

    Rows stand in order of the number of set bits, which differs by no more than the bits that differ:
    only those near in that order are compared.
    """
    left, right, rest = [], [], np.unique(fps, axis=0)
    rest = rest[np.argsort(_ones(rest), kind="stable")]
    ones = _ones(rest)
    while len(rest) > 1:
        wave, rest, ones = [rest[:1]], rest[1:], ones[1:]
        while wave and len(rest):
            pivot = wave.pop()
            n = _ones(pivot)[0]
            a, b = np.searchsorted(ones, [n - rule.most[0], n + rule.most[0] + 1])
            near = np.flatnonzero(rule.near(rest[a:b], pivot)) + a
            if len(near):
                found = rest[near]
                rest, ones = np.delete(rest, near, axis=0), np.delete(ones, near)
                left += rule.ids(pivot).tolist() * len(found)
                right += rule.ids(found).tolist()
                wave += [found[i : i + 1] for i in range(len(found))]
    return left, right


def _link_runs(run_rows: int, rule: Rule):  # noqa: ANN202
    """Over rows sorted by key: links of each run (a null key), or the rows of a run that is too long."""
    names = ["key", "u", "v", *rule.columns()]

    def links_out(u: np.ndarray | list, v: np.ndarray | list) -> pa.RecordBatch:
        none = pa.nulls(len(u), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(u, pa.int64()), pa.array(v, pa.int64()), *[none] * len(rule.most)], names=names)

    def rows_out(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(keys), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(keys), none, none, *[pa.array(c) for c in fps.T]], names=names)

    def finished(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        for k in np.flatnonzero(sizes > SHORT_RUN).tolist():
            a, b = tree_links(fps[starts[k] : starts[k] + sizes[k]], rule)
            if a:
                yield links_out(a, b)
        short = np.repeat(sizes <= SHORT_RUN, sizes)
        at = np.flatnonzero(short[:-1] & (keys[1:] == keys[:-1]))
        pairs = []
        for step in range(1, SHORT_RUN):
            at = at[at + step < len(keys)]
            at = at[keys[at] == keys[at + step]]
            if not len(at):
                break
            near = at[rule.near(fps[at], fps[at + step])]
            if len(near):
                pairs.append(np.stack([rule.ids(fps[near]), rule.ids(fps[near + step])]))
        if pairs:
            both = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
            both = both[:, both[0] != both[1]]
            if both.shape[1]:
                yield links_out(both[0], both[1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, late = np.empty(0, np.int64), np.empty((0, len(rule.most)), np.int64), None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)])
            fps = np.concatenate([fps, _table(batch, 1)])
            if late is not None:  # the rest of a run that was set aside
                n = int(np.searchsorted(keys, late, "right"))
                if n:
                    yield rows_out(keys[:n], fps[:n])
                keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    continue
                late = None
            if len(keys) < 50_000:
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from finished(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
            if len(keys) > run_rows:
                late = keys[0]
                yield rows_out(keys, fps)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from finished(keys, fps)

    return run


def links(fps: DataFrame, rule: Rule = ONE_PRINT, run_rows: int = 100_000, block_rows: int = 20_000) -> DataFrame:
    """Links (u, v) between the ids of distinct rows of fingerprints that connect all that the rule links."""
    names, kind = rule.columns(), rule.schema("key", "u", "v")
    keyed = map_batches(fps, _emit_keys(rule), rule.schema("key"), 4096).repartition("key").sortWithinPartitions("key")
    found = written(map_batches(keyed, _link_runs(run_rows, rule), kind, 20_000), "links")
    aside = found.where("key IS NOT NULL").select("key", *names)
    sizes = aside.groupBy("key").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("n"))
    if sizes.isEmpty():
        return found.select("u", "v")
    own = aside.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64(*names), F.col("n")).cast("int"))
    dealt = own.select(*names, F.explode(F.expr("transform(sequence(0, n - 1), i -> struct(key, least(i, own) AS lo, greatest(i, own) AS hi))")).alias("pair"))
    both = dealt.select(F.xxhash64("pair").alias("key"), *names).repartition("key").sortWithinPartitions("key")
    more = written(map_batches(both, _link_runs(1 << 62, rule), kind, 20_000), "links")
    return found.where("key IS NULL").select("u", "v").unionByName(more.select("u", "v"))


def classes(docs: DataFrame, doc_id: str, fp: str, **sizes: int) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of a written (id, fingerprint) table.

    The smallest id of each root is written: it is sent out if it is small, and if not, Spark splits
    a root that very many fingerprints have.
    """
    firsts = docs.select(col(fp).alias("fp"), col(doc_id).alias("id")).groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(docs.select(col(fp).alias("f0")).distinct(), **sizes))
    named = written(firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    least = written(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return named.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    marked = written(fingerprints(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))).select("doc_id", "fp"), "fingerprints")
    return marked.join(classes(marked, "doc_id", "fp", **sizes), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id."""
    fp = free_name(docs, "fp")
    marked = written(fingerprints(docs, text, fp), "fingerprints")
    return first_of_each(marked, classes(marked, doc_id, fp, **sizes).select(F.col("fp").alias("mark"), "root"), fp, doc_id).select(*[col(c) for c in docs.columns])
