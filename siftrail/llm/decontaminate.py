"""Benchmark items inside documents: MinHash sketches partitioned by size, then exact containment.

An item is contained in a document if the document has at least ``threshold`` of the item's
distinct five-word shingles, wherever they stand. Items are partitioned by their number of shingles
into classes that double; an item is sketched by its smallest hashes, as many as the largest item
of its class needs to be certain: of n shingles at most (1 - threshold) n may be missing, so a
sketch of one more has a hash that every document containing the item has too. A document that has
a hash of a sketch is a candidate, and is verified by the shingles themselves.

A benchmark of bounded size is sent to every executor while the documents are read once; they are not
exchanged. A larger one is never gathered: sketches and documents meet by hash, and candidates by text.

Edge cases: words are runs of letters and digits in lower case. Items and documents that are null
or have fewer than five words match nothing. Repeated items count once, repeated documents each.
With an empty benchmark nothing matches. Very long texts are read whole. Other columns pass through;
one that is named as the output, in whatever letter case, is replaced.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import add_columns, col, free_name, map_batches, written

WORD = regex.compile(r"[\p{L}\p{N}]+")
WORDS = 5
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
BITS = 22


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class _Hashes:
    """Word hashes, remembered, and shingle hashes made of them."""

    def __init__(self, room: int = 300_000) -> None:
        self.known: dict[str, int] = {}
        self.room = room

    def shingles(self, found: list[str]) -> np.ndarray:
        if len(found) < WORDS:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.room:
            known.clear()
        for w in {w for w in found if w not in known}:
            known[w] = xxhash.xxh64_intdigest(w.encode())
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        n = len(h) - WORDS + 1
        out = np.zeros(n, np.uint64)
        for i in range(WORDS):
            out += h[i : i + n] * ODD[i]
        out ^= out >> np.uint64(29)
        out *= ODD[0]
        return out ^ (out >> np.uint64(32))


@dataclass(frozen=True)
class Sketches:
    """The items: their shingles, and a sorted table from sketch hashes to items."""

    ids: list[int | None]
    shingles: list[frozenset[str]]
    keys: np.ndarray
    owners: np.ndarray
    bitmap: np.ndarray
    threshold: float

    def needed(self, item: int) -> int:
        return needed(len(self.shingles[item]), self.threshold)


def needed(n: int, threshold: float) -> int:
    return math.ceil(n * threshold - 1e-9)


def sketch_size(n: int, threshold: float) -> int:
    """Enough hashes for every item of the size class of ``n``: 2^k to 2^(k+1) - 1 shingles."""
    top = (1 << n.bit_length()) - 1
    return max(m - needed(m, threshold) for m in (top, top - 1, n) if m > 0) + 1


def sketches(items: list[tuple[int | None, str | None]], threshold: float) -> Sketches:
    ids, all_shingles, keys, owners, hashes = [], [], [], [], _Hashes()
    classes = defaultdict(list)
    for item, text in items:
        found = words(text)
        if len(found) >= WORDS:
            classes[len(set(zip(*[found[i:] for i in range(WORDS)], strict=False))).bit_length()].append((item, found))
    for size in sorted(classes):
        for item, found in classes[size]:
            unique = frozenset(" ".join(found[i : i + WORDS]) for i in range(len(found) - WORDS + 1))
            low = np.unique(hashes.shingles(found))[: sketch_size(len(unique), threshold)]
            keys.append(low)
            owners.append(np.full(len(low), len(ids)))
            ids.append(item)
            all_shingles.append(unique)
    flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    whose = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.argsort(flat, kind="stable")
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[(flat >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return Sketches(ids, all_shingles, flat[order], whose[order], bitmap, threshold)


class Matcher:
    def __init__(self, block: Sketches) -> None:
        self.block, self.hashes = block, _Hashes()

    def __call__(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item, its shingles, those the text has) for each item the text contains."""
        block, found = self.block, words(text)
        if not len(block.keys) or len(found) < WORDS:
            return []
        h = self.hashes.shingles(found)
        h = np.unique(h[block.bitmap[(h >> np.uint64(64 - BITS)).astype(np.int64)]])
        left, right = np.searchsorted(block.keys, h), np.searchsorted(block.keys, h, "right")
        some = np.flatnonzero(right > left)
        if not len(some):
            return []
        candidates = {int(o) for k in some.tolist() for o in block.owners[left[k] : right[k]]}
        own = {" ".join(found[i : i + WORDS]) for i in range(len(found) - WORDS + 1)}
        out = [(block.ids[c], len(block.shingles[c]), len(block.shingles[c] & own)) for c in sorted(candidates)]
        return [m for m, c in zip(out, sorted(candidates), strict=True) if m[2] >= block.needed(c)]


def _one(known: Broadcast) -> Callable[[str | None], tuple]:
    match = Matcher(known.value)
    return lambda text: ([dict(zip(("item_id", "n_shingles", "n_shared"), m, strict=True)) for m in match(text)],)


MATCHES = "array<struct<item_id:bigint,n_shingles:bigint,n_shared:bigint>>"


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", matches: str = "matches", threshold: float = 0.8, most_words: int = 2_000_000) -> DataFrame:
    """``docs`` with an array of (item_id, n_shingles, n_shared) for the items each row contains.

    A benchmark of at most ``most_words`` words is gathered and sent to every executor, and the documents
    are read once. A larger one is joined by the hashes of its sketches.
    """
    rows = items.select(col(item_id).cast("bigint").alias("id"), col(item_text).alias("t")).where("t IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.size(F.split("t", r"\s+")))).first()[0] or 0
    kept = [c for c in docs.columns if c.lower() != matches.lower()]
    found = free_name(docs, "__found")
    if total > most_words:
        out = _joined(docs, written(rows, "items"), text, found, threshold)
    else:
        known = docs.sparkSession.sparkContext.broadcast(sketches([(r["id"], r["t"]) for r in rows.collect()], threshold))
        out = add_columns(docs, text, lambda: _one(known), [(found, MATCHES)])
    return out.select(*[col(c) for c in kept], F.array_sort(col(found)).alias(matches))


def _joined(docs: DataFrame, items: DataFrame, text: str, found: str, threshold: float) -> DataFrame:
    """``docs`` with the matches of a benchmark of any size, in the column ``found``.

    Hashes of documents meet those of sketches, and only candidates meet the texts, which verify them.
    """
    file, at = free_name(docs, "row_file"), free_name(docs, "row_at")
    held = written(docs, "documents")
    spot = held.metadataColumn("_metadata")
    held = held.withColumns({file: spot["file_name"], at: spot["row_index"]})
    own = map_batches(held.select(col(file), col(at), col(text)), _document_hashes, "file string, at bigint, hash bigint")
    asked = written(map_batches(items, _sketch_hashes(threshold), "id bigint, t string, hash bigint"), "sketches")
    pairs = written(own.join(asked, "hash").select("file", "at", "id", "t").distinct(), "candidates")
    texts = held.select(col(file).alias("file"), col(at).alias("at"), col(text).alias("text"))
    verified = map_batches(pairs.join(texts, ["file", "at"]).select("file", "at", "id", "t", "text"), _contained(threshold), "file string, at bigint, id bigint, n bigint, shared bigint", 64)
    match = F.struct(F.col("id").alias("item_id"), F.col("n").alias("n_shingles"), F.col("shared").alias("n_shared"))
    each = verified.groupBy("file", "at").agg(F.collect_list(match).alias("all"))
    out = held.join(each, (held[file] == each["file"]) & (held[at] == each["at"]), "left")
    return out.select(*[held[c] for c in docs.columns], F.coalesce(each["all"], F.array().cast(MATCHES)).alias(found))


def _document_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        for file, at, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            h = np.unique(hashes.shingles(words(text))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(h), pa.string()), pa.array(np.full(len(h), at)), pa.array(h)], names=["file", "at", "hash"])


def _sketch_hashes(threshold: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for item, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                h = np.unique(hashes.shingles(words(text)))
                low = h[: sketch_size(len(h), threshold)].view(np.int64) if len(h) else h.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(low), pa.int64()), pa.array([text] * len(low), pa.string()), pa.array(low)], names=["id", "t", "hash"])

    return run


def shingles(text: str | None) -> frozenset[str]:
    found = words(text)
    return frozenset(" ".join(found[i : i + WORDS]) for i in range(len(found) - WORDS + 1))


def _contained(threshold: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(16)(shingles)
        for batch in batches:
            out = []
            for file, at, item, asked, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n, shared = len(known(asked)), len(known(asked) & known(text))
                if shared >= needed(n, threshold):
                    out.append((file, at, item, n, shared))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["file", "at", "id", "n", "shared"])

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """``docs`` without the rows that contain an item of the benchmark."""
    matches = free_name(docs, "matches")
    return find_items(docs, items, matches=matches, **options).where(F.size(col(matches)) == 0).select(*[col(c) for c in docs.columns])
