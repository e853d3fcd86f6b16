"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels of a logarithmic scale, and the filter holds a gram
once for each level up to its own. A count is read by asking for level after level until one is missing; a
count is never read too low, and too high by a level in about one of a hundred cases. The probability of a
word is its pair's count, smoothed by the word's own probability; every count in it comes from the filter.

The filter is built in shards of bounded size, whose number grows with the corpus: each task sends its
grams, counted, to the shard that their hash names. A filter of up to ``broadcast_bytes`` goes to every task, and texts are
scored in one scan; of a larger one, the shards stay where they are and chunks of documents ask them, with equal scores.

The base score is exact, but for words whose 64-bit hashes meet. Words that make up a share of at least 1/``common`` of the corpus, of which there are ``common`` at
most, go to every task; the others of each document meet their counts in a join, where none of them is frequent.

Edge cases: a null or blank text is the end token alone. Rows without an id are scored, count as not held
out and teach nothing. Repeated rows teach and are scored one by one. If nothing can be learned, base score and
score are 0 for every token, as all tokens there are, the end, are equally likely. Texts are read whole, however long; other columns of the
same names as the new ones are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftrail.functions.session import importable
from siftrail.llm.common import col, map_batches, written

END = b""  # no word is empty
CHUNK = 1 << 20  # tokens whose grams are counted together in a task
SHARD_TOKENS = 1 << 21
REMEMBERED = 400_000  # words a task counts before it gives them away
STOPS = np.uint64(0x9E3779B97F4A7C15)  # the constants of the splitmix64 finaliser are fixed values
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
START_HASH, END_HASH = np.uint64(0x5174A27), np.uint64(0xE4D)  # what stands before the first word, and the end


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, only A-Z lower-cased, and the end token."""
    found = (text or "").encode().lower().split()
    found.append(END)
    return found


def held_out(doc_id: Column, folds: int = 10) -> Column:
    """Whether a document belongs to the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all 64-bit numbers, one to one."""
    x = x + STOPS
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def word_grams(words: np.ndarray) -> np.ndarray:
    return mixed(words ^ np.uint64(0xA5A5))


def pair_grams(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) * np.uint64(3) + words)


@dataclass(frozen=True)
class Scale:
    """Levels of a logarithmic scale: level q begins at ``ceil(base ** (q - 1))``."""

    base: float = 1.5

    def starts(self) -> np.ndarray:
        """The least count of each level; with a base near one, levels that no whole number reaches are left out."""
        return np.unique(np.ceil(self.base ** np.arange(int(np.log(2.0**62) / np.log(self.base)))).astype(np.int64))

    def level(self, counts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts(), counts, "right")

    def counts(self) -> np.ndarray:
        """The count that a level stands for, the middle of what it holds; level 0 is a count of 0."""
        starts = self.starts().astype(float)
        return np.concatenate([[0.0], (starts + np.append(starts[1:] - 1, starts[-1])) / 2])


@dataclass
class Bloom:
    """Shards of a Bloom filter in one array: where each begins, and its size in bits."""

    starts: np.ndarray
    sizes: np.ndarray
    bits: np.ndarray | bytes
    probes: int

    def opened(self) -> Bloom:
        """With the bytes as an array, which is not copied."""
        return Bloom(self.starts, self.sizes, np.frombuffer(self.bits, np.uint8), self.probes)

    def has(self, grams: np.ndarray, level: int) -> np.ndarray:
        """Places of the grams that have a level; the others mostly go at the first or second probe."""
        alive = np.arange(len(grams))
        at, step = events(grams, level)
        one = len(self.sizes) == 1  # division by one number is much faster
        shard = 0 if one else shard_of(grams, len(self.sizes))
        start, size = self.starts[shard], self.sizes[shard]
        for _ in range(self.probes):
            bit = at - at // size * size if one else at % size
            byte = self.bits[start + (bit >> np.uint64(3)).astype(np.int64)]
            left = np.flatnonzero((byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
            alive = alive[left]
            start, size = (start, size) if one else (start[left], size[left])
            at, step = at[left], step[left]
            at = at + step
        return alive

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each gram: the last of those it has without a gap; 0 if it was never put in."""
        out, left, level = np.zeros(len(grams), np.int64), np.arange(len(grams)), 0
        while len(left):
            level += 1
            left = left[self.has(grams[left], level)]
            out[left] = level
        return out


def events(grams: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the event that a gram has a level: the first probe, and the step to each next one."""
    event = mixed(grams + np.array([level], np.uint64) * STOPS)
    return event & np.uint64(0xFFFFFFFF), (event >> np.uint64(32)) | np.uint64(1)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers in order; by sorting, which takes a tenth of the time of numpy's table."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shard_of(grams: np.ndarray, n: int) -> np.ndarray:
    return ((grams >> np.uint64(33)) % np.uint64(max(n, 1))).astype(np.int64)


def _filled(grams: np.ndarray, counts: np.ndarray, scale: Scale, bits_per_event: float, probes: int) -> np.ndarray:
    """The bits of one shard, its length a multiple of eight."""
    levels = scale.level(counts)
    size = max(64, -(-int(levels.sum() * bits_per_event) // 64) * 64)
    flags = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, step = events(grams[levels >= level], level)
        for _ in range(probes):
            flags[at % np.uint64(size)] = True
            at = at + step
    return np.packbits(flags, bitorder="little")


@dataclass
class LanguageModel:
    """What was learned: counts of all words as a table, the filter's shards as a table, and sums."""

    words: DataFrame  # word, c
    shards: DataFrame  # shard, bits
    n_shards: int
    n_bytes: int
    n_tokens: int
    n_words: int
    n_texts: int
    probes: int
    prior: float
    common: int
    scale: Scale = field(default_factory=Scale)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10, bits_per_event: float = 10.0, probes: int = 5, prior: float = 400.0, common: int = 1 << 22, scale: Scale = Scale()) -> LanguageModel:
    """Learn from all documents with an id that are not held out, whole: counts of all words and pairs."""
    frame = docs.where(col(doc_id).isNotNull() & ~held_out(col(doc_id), folds)).select(col(text).alias("t"))

    def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "c"])

        for batch in batches:
            for t in batch.column(0):
                counts.update(tokens_of(t.as_py()))
            if len(counts) > REMEMBERED:
                yield rows()
                counts.clear()
        yield rows()

    words = written(map_batches(frame, count_words, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    sums = words.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.max(F.when(F.col("word") == "", F.col("c"))).alias("texts")).first()
    n_tokens = sums["n"] or 0
    n_shards = -(-n_tokens // SHARD_TOKENS) or 1

    def count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = Reader(), [], 0

        def rows() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            shard = shard_of(grams, n_shards)
            by = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[by], np.arange(n_shards + 1))
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            grams, n = grams[by].astype("<u8"), n[by].astype("<u4")
            blobs = [[x[cuts[s] : cuts[s + 1]].tobytes() for s in some] for x in (grams, n)]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *[pa.array(b, pa.binary()) for b in blobs]], names=["shard", "grams", "n"])

        for batch in bounded(batches, 0):
            got = reader.read(batch.column(0))
            held += [word_grams(got.own), got.pairs()]
            size += len(got.own)
            if size >= CHUNK:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        grams, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("grams", "<u8"), ("n", "<u4")))
        grams, at = np.unique(grams, return_inverse=True)
        counts = np.bincount(at, n).astype(np.int64)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([_filled(grams, counts, scale, bits_per_event, probes).tobytes()], pa.binary())})

    importable(docs.sparkSession)
    sent = map_batches(frame, count_grams, "shard bigint, grams binary, n binary")
    shards = written(sent.groupBy("shard").applyInArrow(fill, "shard bigint, bits binary"), "lm-filter")
    n_bytes = shards.agg(F.sum(F.octet_length("bits")).cast("bigint").alias("b")).first()["b"] or 0
    return LanguageModel(words, shards, n_shards, n_bytes, n_tokens, sums["v"], sums["texts"] or 0, probes, prior, common, scale)


PIECE = 1 << 18  # bytes hashed at once
LONG = 256  # longer words are hashed one by one
SEGMENT = 1 << 16  # tokens scored at once
CHUNKS_IN_TASK = 4
ASKED = 1 << 25  # bytes of text whose grams a shard answers at once, on average
READ = 1 << 21  # bytes of text whose tokens are in memory at once, or one text
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_FACTOR = 0x5851F42D4C957F2D  # odd, so that it has an inverse


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    with np.errstate(over="ignore"):
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(factor, len(out), 1 << 64))])
    return out[:n]


def bounded(batches: Iterable[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices with ``READ`` bytes of text, in the column ``at``, or with one text: a token takes some hundred bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        total, a = np.cumsum(sizes, dtype=np.int64), 0
        while a < len(sizes):
            z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + READ, "right")))
            yield batch.slice(a, z - a)
            a = z


class Reader:
    """Hashes of the tokens of many texts at once.

    A word's hash is a sum of its bytes' numbers times powers of a factor, taken from one running sum over all
    bytes; so words cost no Python object each.
    """

    def __init__(self) -> None:
        numbers = mixed(np.arange(1, 257, dtype=np.uint64))
        self.numbers = numbers[np.frombuffer(bytes(range(256)).lower(), np.uint8)]
        self.up, self.down = _powers(_FACTOR, PIECE), _powers(pow(_FACTOR, -1, 1 << 64), PIECE)

    def _hash(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of words within one piece, their places given from its beginning."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def read(self, texts: pa.Array) -> Tokens:
        texts = pa.array(texts.fill_null(""), pa.large_string()) if texts.type != pa.large_string() else texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(texts) else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
        blank = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge[1:] |= blank
        starts = np.flatnonzero(~blank & edge[:-1])
        edge[:-1] |= blank
        edge[offsets] = True
        ends = np.flatnonzero(~blank & edge[1:]) + 1
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            begin = starts[at]
            to = max(int(np.searchsorted(ends, begin + PIECE, "right")), at + 1)
            if ends[at] - begin <= PIECE:
                part = slice(at, to)
                hashes[part] = self._hash(data[begin : ends[to - 1]], starts[part] - begin, ends[part] - begin)
            at = to
        for k in np.flatnonzero(ends - starts > LONG):
            hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes().lower())
        words = np.searchsorted(starts, offsets)
        first = words[:-1] + np.arange(len(texts))
        at = np.arange(len(starts)) + np.repeat(np.arange(len(texts)), np.diff(words))
        own = np.full(len(starts) + len(texts), END_HASH, np.uint64)
        own[at] = hashes
        from_, to_ = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        from_[at], to_[at] = starts, ends
        return Tokens(own, first, from_, to_, data)


@dataclass
class Tokens:
    """Hashes of all tokens of some texts, where each text begins, and each word's bytes."""

    own: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def words(self, at: np.ndarray) -> list[bytes]:
        """The words of some tokens; the end token is the empty word."""
        lowered = self.data.tobytes().lower() if len(at) else b""
        return [lowered[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]

    def pairs(self) -> np.ndarray:
        """The pair that each token ends."""
        before = np.concatenate([[START_HASH], self.own[:-1]])
        before[self.first] = START_HASH
        return pair_grams(before, self.own)


@dataclass(frozen=True)
class _Sums:
    """What a task needs to know besides the filter: the model's sums, and the counts of common words by hash, in order."""

    tokens: int
    words: int
    texts: int
    prior: float
    scale: Scale
    common: tuple[np.ndarray, np.ndarray]


class _Scorer:
    """Scores texts with levels of grams that ``levels`` reads."""

    def __init__(self, sums: _Sums, levels: Callable[[np.ndarray], np.ndarray]) -> None:
        self.sums, self.levels, self.counts, self.reader = sums, levels, sums.scale.counts(), Reader()

    def score(self, texts: pa.Array) -> list[pa.Array]:
        """n_tokens, n_known and base_score of common words, score; the other words of each text and how often it has them."""
        return self.score_tokens(self.reader.read(texts))

    def score_tokens(self, got: Tokens) -> list[pa.Array]:
        sums, n, total = self.sums, len(got.first), len(got.own)
        lengths = np.diff(np.append(got.first, total))
        text_of = np.repeat(np.arange(n), lengths)
        size = sums.tokens + 0.1 * (sums.words + 1)
        known, base, score = np.zeros(n), np.zeros(n), np.zeros(n)
        places, times, owners = [], [], []
        pairs, carried = got.pairs(), 0.0
        begins = np.zeros(total, bool)
        begins[got.first] = True
        for a in range(0, total, SEGMENT):
            part = slice(a, a + SEGMENT)
            texts_of = text_of[part]
            words, at = np.unique(got.own[part], return_inverse=True)
            all_pairs, pair_at = np.unique(pairs[part], return_inverse=True)
            read = self.counts[self.levels(np.concatenate([word_grams(words), all_pairs]))]
            single, pair = read[: len(words)][at], read[len(words) :][pair_at]
            context = np.concatenate([[carried], single[:-1]])
            context[begins[part]] = sums.texts
            carried = single[-1]
            alone = np.minimum((single + 0.1) / size, 1.0)
            score += np.bincount(texts_of, np.log10((np.minimum(pair, context) + sums.prior * alone) / (context + sums.prior)), n)
            exact = self._common(words)
            base += np.bincount(texts_of, np.where(exact > 0, np.log10((exact + 0.1) / size), 0.0)[at], n)
            known += np.bincount(texts_of, (exact > 0)[at], n)
            rare = np.flatnonzero(exact[at] == 0)
            _, where, often = np.unique(texts_of[rare] * np.int64(len(words)) + at[rare], return_index=True, return_counts=True)
            places.append(rare[where] + a)
            times.append(often)
            owners.append(texts_of[rare[where]])
        where, often, owner = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (places, times, owners))
        offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
        rest = pa.array(got.words(where), pa.binary()).cast(pa.string())
        return [pa.array(lengths, pa.int64()), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score), pa.ListArray.from_arrays(offsets, rest), pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64()))]

    def _common(self, words: np.ndarray) -> np.ndarray:
        """Counts of the common words among them, 0 for the others."""
        hashes, counts = self.sums.common
        if not len(hashes):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
        return np.where(hashes[at] == words, counts[at], 0)


_ADDED = "n_tokens bigint, n_known bigint, base_score double, score double"
_REST = "rest array<string>, times array<bigint>"


def score(docs: DataFrame, model: LanguageModel, text: str = "text", broadcast_bytes: int = 1 << 28) -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score and score."""
    added = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    kept = [c for c in docs.columns if c != text and c.lower() not in added]
    frame = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)], col(text).alias("t"))
    spark = docs.sparkSession
    sums = spark.sparkContext.broadcast(_Sums(model.n_tokens, model.n_words, model.n_texts, model.prior, model.scale, _common(model)))
    found = _in_one_scan(frame, model, sums) if model.n_bytes <= broadcast_bytes else _by_shards(frame, model, sums)
    scored = written(found, "lm-scores")
    size = F.lit(model.n_tokens + 0.1 * (model.n_words + 1))
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", "x.rest", "x.times")
    rare = model.words.where(F.col("c") * F.lit(model.common) < F.lit(model.n_tokens)).select(F.col("word").alias("rest"), "c")
    each = rest.join(rare.hint("merge"), "rest", "left")
    more = each.groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known"), F.sum(F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / size)).alias("base"))
    whole = scored.drop("rest", "times").join(more, "row", "left")
    return whole.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"), "score")


def _common(model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and counts of the words that make up 1/``common`` of all tokens or more: ``common`` words at most."""
    rows = model.words.where(F.col("c") * F.lit(model.common) >= F.lit(model.n_tokens)).toArrow()
    got = Reader().read(rows.column("word").combine_chunks() if rows.num_rows else pa.array([], pa.string()))
    hashes = got.own[got.first]  # of the empty word, the end token's
    by = np.argsort(hashes)
    return hashes[by], rows.column("c").to_numpy()[by]


def _bloom(model: LanguageModel, rows: Iterable) -> Bloom:
    """The filter, or those of its shards that are in ``rows``."""
    parts = sorted((r["shard"], bytes(r["bits"])) for r in rows)
    sizes, starts = np.full(model.n_shards, 64, np.uint64), np.zeros(model.n_shards, np.int64)
    at = 8
    for shard, bits in parts:
        sizes[shard], starts[shard] = 8 * len(bits), at
        at += len(bits)
    # a shard without grams has eight bytes of zeros
    return Bloom(starts, sizes, b"".join([bytes(8), *[bits for _, bits in parts]]), model.probes)


def _in_one_scan(frame: DataFrame, model: LanguageModel, sums) -> DataFrame:  # noqa: ANN001
    """Scores of all texts, the filter sent to every task."""
    spark, at = frame.sparkSession, frame.columns.index("t")
    bloom = spark.sparkContext.broadcast(_bloom(model, model.shards.toLocalIterator()))
    kept = [f for f in frame.schema if f.name != "t"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(sums.value, bloom.value.opened().levels)
        row = TaskContext.get().partitionId() << 33
        for batch in bounded(batches, at):
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            rows = pa.array(np.arange(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([*columns, rows, *scorer.score(batch.column(at))], names=names)

    schema = _schema(frame, kept)
    names = schema.names
    return map_batches(frame, run, schema)


def _schema(frame: DataFrame, kept: list) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in kept] + T._parse_datatype_string(f"row bigint, {_ADDED}, {_REST}").fields)


def _by_shards(frame: DataFrame, model: LanguageModel, sums, chunk_bytes: int = 1 << 22) -> DataFrame:  # noqa: ANN001
    """Scores of all texts, a chunk of them at a time; each chunk's grams are looked up where their shard is.

    A chunk is some megabytes of texts, or one text; rows are dealt to chunks by their place, copies too. A shard's bits
    are read once for all chunks that ask it, not once for each.
    """
    kept = [f for f in frame.schema if f.name != "t"]
    placed = frame.withColumn("row", F.monotonically_increasing_id())
    n_bytes = placed.agg(F.sum(F.octet_length("t")).cast("bigint").alias("b")).first()["b"] or 0
    n_chunks = max(1, n_bytes // chunk_bytes)
    dealt = written(placed.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(n_chunks))), "lm-chunks")
    dealt = dealt.repartition(n_chunks // CHUNKS_IN_TASK + 1, "chunk")  # Spark exchanges texts once and uses that twice
    n_shards, probes = model.n_shards, model.probes
    # a shard answers all that is asked of it at once; where far more is scored than was learned, in parts
    n_parts = -(-n_bytes // (n_shards * ASKED)) or 1

    def grams_of(got: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The grams of a chunk, once each; their places in order of their shards; where each shard's begin."""
        grams = distinct(np.concatenate([word_grams(distinct(got.own)), got.pairs()]))
        shard = shard_of(grams, n_shards)
        by = np.argsort(shard.astype(np.uint16) if n_shards < 1 << 16 else shard, kind="stable")  # short numbers are sorted by their digits
        return grams, by, np.searchsorted(shard[by], np.arange(n_shards + 1))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams, by, cuts = grams_of(Reader().read(table.column("t").combine_chunks()))
        grams, some = grams[by].astype("<u8"), np.flatnonzero(cuts[1:] > cuts[:-1])
        blobs = [grams[cuts[s] : cuts[s + 1]].tobytes() for s in some]
        chunk = pa.array([key[0].as_py()] * len(some), pa.int64())
        return pa.table({"chunk": chunk, "shard": pa.array(some, pa.int64()), "part": pa.array([key[0].as_py() % n_parts] * len(some), pa.int64()), "grams": pa.array(blobs, pa.binary())})

    def answer(key: tuple, table: pa.Table, filters: pa.Table) -> pa.Table:
        blobs = table.column("grams").to_pylist()
        bits = b"".join(filters.column("bits").to_pylist()) or bytes(8)  # a shard without grams
        bloom = Bloom(np.zeros(1, np.int64), np.array([8 * len(bits)], np.uint64), bits, probes).opened()
        asked = np.frombuffer(b"".join(blobs), "<u8")
        levels = b"".join(bloom.levels(asked[a : a + SEGMENT]).astype(np.uint8).tobytes() for a in range(0, len(asked), SEGMENT))
        ends = np.cumsum([len(b) // 8 for b in blobs], dtype=np.int64).tolist()
        return pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "levels": pa.array([levels[a:z] for a, z in zip([0, *ends], ends, strict=False)], pa.binary())})

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        got = Reader().read(table.column("t").combine_chunks())
        grams, by, _ = grams_of(got)
        levels = np.empty(len(grams), np.uint8)
        levels[by] = np.frombuffer(b"".join(answers.sort_by("shard").column("levels").to_pylist()), np.uint8)
        scorer = _Scorer(sums.value, lambda asked: levels[np.searchsorted(grams, asked)].astype(np.int64))
        return pa.table([*[table.column(f.name) for f in kept], table.column("row"), *scorer.score_tokens(got)], names=schema.names)

    schema = _schema(frame, kept)
    importable(frame.sparkSession)
    asked = dealt.groupBy("chunk").applyInArrow(ask, "chunk bigint, shard bigint, part bigint, grams binary")
    filters = model.shards.withColumn("part", F.explode(F.expr(f"sequence(0L, {n_parts - 1}L)")))
    answers = asked.groupBy("shard", "part").cogroup(filters.groupBy("shard", "part")).applyInArrow(answer, "chunk bigint, shard bigint, levels binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)


def train_and_score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **fit_options: object) -> DataFrame:
    """Every document scored by what the others outside the held-out fold have taught; adds held_out too."""
    model = fit(docs, doc_id, text, **fit_options)
    return score(docs.withColumn("held_out", held_out(col(doc_id), fit_options.get("folds", 10))), model, text)
