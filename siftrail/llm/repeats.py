"""Repeated passages, found by prefix-free parsing over the whole corpus.

Rolling-hash triggers cut every text into phrases: of each run of ``length`` bytes the gram with the
smallest hash is the trigger, so equal runs have the same trigger at the same place, wherever they
stand. A phrase is the text of all runs that share one trigger; phrases overlap, and every run lies
in exactly one. The distinct phrases with their first place in corpus order are the dictionary, and
the sequence of phrases of a document is its parse.

What a suffix array of dictionary and parse would be asked here is only where a run of ``length``
bytes stands first. So suffixes are put in order no further than that: phrases are sorted by
trigger, content and corpus order in one streaming pass. A later occurrence of a phrase is repeated
whole. The phrases of a trigger that has several are compared run by run, their bytes fetched for
that alone; a trigger with more than ``group_rows`` of them has its runs dealt out by content.

Edge cases: a null text counts as empty. Texts shorter than ``length`` have no run. Null ids come
last, in order of a hash of 62 bits of their texts; documents that share an id are put in order by a
hash of their texts, and rows that repeat both id and text are one document however often: they get the
same result, do not repeat each other, and cost time linear in their number. Very long texts are read
whole, in blocks. Columns besides the id and the text are not kept. An empty table stays empty.
Matches never cross documents, and runs are judged on the input, not on what is left of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import col, map_batches, written

LENGTH, GRAM = 100, 16
LETTERS = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
PLACE_BITS, BLOCK = 21, 1 << 20
WIDTH_MASK = 0x7F  # the low bits of a phrase's hash hold its number of runs, less one


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A rolling hash of each ``size`` bytes, joined from hashes of shorter pieces."""
    known = {1: LETTERS[data]}

    def of(n: int) -> np.ndarray:
        if n not in known:
            a, b = of(n // 2 + n % 2), of(n // 2)
            left, count = n // 2 + n % 2, len(data) - n + 1
            known[n] = a[:count] * np.uint64(pow(BASE, n // 2, 1 << 64)) + b[left : left + count]
        return known[n]

    h = of(size).copy()
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def cut_phrases(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(triggers, first runs, numbers of runs) of the phrases of a text, a block at a time.

    Of equal hashes the leftmost counts, so a run's trigger depends on its own bytes alone. A
    phrase may be split between blocks or after 128 runs; its parts are phrases then.
    """
    window = length - gram + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    for start in range(0, len(data) - length + 1, BLOCK):
        part = np.frombuffer(data, np.uint8)[start : start + BLOCK + length - 1]
        g = gram_hashes(part, gram)
        least = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        step = 1
        while step * 2 <= window:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        rest = window - step
        least = np.minimum(least[: len(least) - rest], least[rest:])
        trigger = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        if window > WIDTH_MASK + 1:
            first = np.concatenate([np.arange(a, b, WIDTH_MASK + 1) for a, b in zip(first, np.append(first[1:], len(trigger)), strict=True)])
        yield g[trigger[first]].view(np.int64), first + start, np.diff(np.append(first, len(trigger)))


def _phrase_rows(length: int, gram: int) -> Callable:
    """(trigger, phrase, doc, place, later) of every phrase; place has the text's hash above the offset.

    Of the phrases of one batch that are equal, all but the first in corpus order are known to be
    later ones already. They are dealt out by their place, so a phrase that a third of all
    documents share comes together once for each batch and not once for each document.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_64_intdigest
        for batch in batches:
            held: list[list[np.ndarray]] = [[], [], [], []]
            for doc, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = text.encode("utf-8")
                for triggers, starts, sizes in cut_phrases(data, length, gram):
                    ends = (starts + sizes + length - 1).tolist()
                    codes = np.array([hashed(data[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)], np.uint64)
                    held[0].append(triggers)
                    held[1].append((codes & np.uint64(~WIDTH_MASK & (1 << 64) - 1) | (sizes - 1).astype(np.uint64)).view(np.int64))
                    held[2].append(np.full(len(starts), doc, np.int64))
                    held[3].append(starts | mark << 32)
            if held[0]:
                trigger, phrase, doc, place = (np.concatenate(h) for h in held)
                order = np.lexsort((place, doc, phrase, trigger))
                trigger, phrase, doc, place = (c[order] for c in (trigger, phrase, doc, place))
                new = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])])
                first = np.flatnonzero(new)[np.cumsum(new) - 1]
                later = (doc != doc[first]) | (place != place[first])
                yield _rows(["trigger", "phrase", "doc", "place", "later"], [trigger, phrase, doc, place, later])

    return run


def _rows(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over phrases in order: later occurrences (``open`` false), and firsts that are not alone.

    Rows that are known to be later ones go straight through. What is carried from batch to batch
    is one first occurrence.
    """
    carried: list[int] | None = None  # trigger, phrase, doc, place of the phrase at hand
    told = False  # whether it was given out as one of several
    for batch in batches:
        t, p, d, at = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:4])
        if batch.num_columns > 4:
            known = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
            if known.any():
                yield _rows(["trigger", "doc", "place", "runs", "open"], [t[known], d[known], at[known], ((p[known] & WIDTH_MASK) + 1).astype(np.int32), np.zeros(int(known.sum()), bool)])
                t, p, d, at = (c[~known] for c in (t, p, d, at))
        if not len(t):
            continue
        if carried is not None:
            t, p, d, at = (np.concatenate([[x], c]) for x, c in zip(carried, (t, p, d, at), strict=True))
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (p[1:] != p[:-1])])
        firsts = np.flatnonzero(new)
        own = firsts[np.cumsum(new) - 1]
        later = np.flatnonzero((d != d[own]) | (at != at[own]))
        same = t[firsts[1:]] == t[firsts[:-1]]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        if carried is not None and told:
            several[0] = False
        told = bool(same[-1]) if len(same) else told
        opened = firsts[several]
        carried = [int(x[firsts[-1]]) for x in (t, p, d, at)]
        rows = np.concatenate([later, opened])
        if len(rows):
            runs = (p[rows] & WIDTH_MASK) + 1
            yield _rows(["trigger", "doc", "place", "runs", "open"], [t[rows], d[rows], at[rows], runs.astype(np.int32), np.arange(len(rows)) >= len(later)])


def _fetch(length: int) -> Callable:
    """The bytes of the phrases that have to be compared."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, mark, text, wanted in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = text.encode("utf-8")
                for i in range(0, len(wanted), 4096):
                    part = wanted[i : i + 4096]
                    yield _rows(
                        ["trigger", "doc", "place", "bytes"],
                        [[w["trigger"] for w in part], [doc] * len(part), [w["lo"] | mark << 32 for w in part], [data[w["lo"] : w["lo"] + w["runs"] + length - 1] for w in part]],
                    )

    return run


def _compare(length: int, group_rows: int) -> Callable:
    """Over fetched phrases in order: runs that stand earlier in another phrase of the trigger.

    A trigger with too many phrases gives out the hashes of all its runs instead, as it goes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigger, seen, n, late = None, {}, 0, False
        for batch in batches:
            out: list[tuple] = []
            for t, doc, place, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if t != trigger:
                    trigger, seen, n, late = t, {}, 0, False
                n += 1
                if n > group_rows and not late:
                    late = True
                    out += [(t, _signed(run_bytes), d, p, False) for run_bytes, (d, p) in seen.items()]
                    seen = {}
                for i in range(len(data) - length + 1):
                    piece = data[i : i + length]
                    if late:
                        out.append((t, _signed(piece), doc, place + i, False))
                    elif seen.setdefault(piece, (doc, place + i)) != (doc, place + i):
                        out.append((t, 0, doc, place + i, True))
                if len(out) > 50_000:
                    yield _found(out)
                    out = []
            if out:
                yield _found(out)

    return run


def _signed(piece: bytes) -> int:
    return (xxhash.xxh3_64_intdigest(piece) & ~WIDTH_MASK) - (1 << 63)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["trigger", "phrase", "doc", "place", "repeated"])


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, doc, mark, text): ``doc`` is the id, or for a null one a number of 62 bits behind the ids, by its text."""
    data = F.coalesce(col(text), F.lit(""))
    own = col(doc_id).cast("bigint")
    behind = F.lit(1 << 62).bitwiseOR(F.xxhash64(data).bitwiseAND(F.lit((1 << 62) - 1)))
    return docs.select(own.alias("id"), F.coalesce(own, behind).alias("doc"), F.hash(data).cast("bigint").alias("mark"), data.alias("text"))


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, group_rows: int = 20_000) -> DataFrame:
    """(doc, mark, lo, runs): runs of ``length`` bytes that start at lo ... lo + runs - 1 and stand earlier too.

    ``doc`` and ``mark`` are the keys of ``_keyed``: the id and a hash of the text.
    """
    rows = _keyed(docs, doc_id, text).drop("id")
    long = rows.where(F.octet_length("text") >= length)
    parsed = map_batches(long, _phrase_rows(length, gram), "trigger bigint, phrase bigint, doc bigint, place bigint, later boolean")
    deal = F.when(F.col("later"), F.xxhash64("doc", "place")).otherwise(F.col("trigger"))
    order = ["trigger", "phrase", "doc", "place"]
    kind = "trigger bigint, doc bigint, place bigint, runs int, open boolean"
    first = written(map_batches(parsed.repartition(deal).sortWithinPartitions(*order), _repeated, kind, 4096), "phrases")
    place = [F.shiftright("place", 32).alias("mark"), F.expr("cast(place & 4294967295 AS int)").alias("lo")]
    wanted = first.where("open").select("doc", *place, "trigger", "runs")
    wanted = wanted.groupBy("doc", "mark").agg(F.collect_set(F.struct("trigger", "lo", "runs")).alias("wanted"))
    fetched = long.join(wanted.hint("shuffle_hash"), ["doc", "mark"]).select("doc", "mark", "text", "wanted")
    fetched = map_batches(fetched, _fetch(length), "trigger bigint, doc bigint, place bigint, bytes binary")
    compared = map_batches(fetched.repartition("trigger").sortWithinPartitions("trigger", "doc", "place"), _compare(length, group_rows), "trigger bigint, phrase bigint, doc bigint, place bigint, repeated boolean", 4096)
    second = written(compared, "runs")
    late = second.where("NOT repeated").select(*order)
    third = map_batches(late.repartition("trigger", "phrase").sortWithinPartitions(*order), _repeated, kind, 4096).where("NOT open")
    out = first.where("NOT open").select("doc", *place, "runs")
    out = out.unionByName(second.where("repeated").select("doc", *place, F.lit(1).alias("runs")))
    return out.unionByName(third.select("doc", *place, F.lit(1).alias("runs")))


def spans(found: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """The maximal byte ranges that repeated runs cover."""
    out: list[list[int]] = []
    for lo, runs in sorted(found):
        end = lo + runs + length - 1
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([lo, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, **options: int) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the byte ranges removed, and the bytes that are left.

    What is left may begin or end inside a character, so it is binary.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        for batch in batches:
            rows = []
            for doc, content, found in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = content.encode("utf-8")
                gone = spans([(f["lo"], f["runs"]) for f in found or ()], length)
                at, kept = 0, []
                for a, b in gone:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                rows.append((doc, len(data), [{"start": a, "end": b} for a, b in gone], b"".join(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "removed", "kept"])

    found = repeated_runs(docs, doc_id, text, length, **options)
    found = found.groupBy("doc", "mark").agg(F.collect_set(F.struct("lo", "runs")).alias("found"))
    rows = _keyed(docs, doc_id, text).join(found.hint("shuffle_hash"), ["doc", "mark"], "left")
    return map_batches(rows.select("id", "text", "found"), run, "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    """The rows of ``remove_repeats`` as numbers and a hash."""
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
