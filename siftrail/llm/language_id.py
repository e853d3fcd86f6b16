"""Language identification by words first, then ever shorter character n-grams.

A known word scores its log frequency in each language. An unseen word is read through
its longest known character n-grams, position by position, from ``max_n`` down to one.

Edge cases: a null text, or one without a letter, gives ``und`` with score 0; so does every
text if nothing could be learned. Equal scores go to the language that sorts first. Rows
without a language or an id teach nothing; rows without an id count as not held out.
Repeated rows are scored one by one, and other columns pass through untouched; those named as an
output are replaced. A run of letters without spaces counts as one word however long it is, and all of
it is read, in blocks; very long texts are read whole, a slice at a time. An empty table stays empty.
The score is the share of belief in the language, the evidence of n words counted as the root of n.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.llm.common import add_columns, col, free_name, slices, written

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNKNOWN = "und"
LONG, BLOCK = 200, 1 << 14  # longer words are not remembered; n-grams that begin within a block are walked at once


@dataclass
class LanguageModel:
    """Per-language log frequencies of words and of character n-grams.

    ``word_scores`` and ``gram_scores`` have a row for each entry of ``words`` and ``grams``.
    """

    langs: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray
    max_n: int

    def __post_init__(self) -> None:
        known, width = len(self.words), max(1, len(self.langs))
        self._room = known + max(20_000, min(100_000, (64 << 20) // (8 * width)))
        self._rows = dict(self.words)
        self._table = np.zeros((known, width))
        if known:
            self._table[:known] = self.word_scores
        self._table = np.concatenate([self._table, np.zeros((min(self._room - known, 50_000), width))])

    def _known_grams(self, word: str) -> list[int]:
        """The longest known n-gram at each place of an unseen word."""
        return [g for block in blocks(word, self.max_n) for g in self._block_grams(*block)]

    def _block_grams(self, padded: str, places: int) -> list[int]:
        get, top = self.grams.get, self.max_n
        found = []
        for at in range(places):
            for n in range(top, 0, -1):
                hit = get(padded[at : at + n])
                if hit is not None:
                    found.append(hit)
                    break
        return found

    def _learn(self, words: list[str]) -> None:
        """Give unseen words rows of their own, scored by their n-grams."""
        found = [self._known_grams(w) or [-1] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((g for f in found for g in f), np.int64, int(sizes.sum()))
        scores = self.gram_scores[flat] if len(self.grams) else np.zeros((len(flat), self._table.shape[1]))
        scores[flat < 0] = 0
        start = len(self._rows)
        while start + len(words) > len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
        self._table[start : start + len(words)] = np.add.reduceat(scores, np.concatenate([[0], sizes.cumsum()[:-1]])) / sizes[:, None]
        self._rows.update(zip(words, range(start, start + len(words)), strict=True))

    def _long_score(self, word: str) -> np.ndarray:
        """What ``_learn`` would give a long unseen word, block by block and without keeping it."""
        total, n = np.zeros(self._table.shape[1]), 0
        for block in blocks(word, self.max_n):
            if found := self._block_grams(*block):
                total += self.gram_scores[found].sum(axis=0)
                n += len(found)
        return total / max(n, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UNKNOWN, 0.0
        counts: Counter[str] = Counter()
        for piece in slices(text):
            counts.update(WORD.findall(piece.lower()))
        n = counts.total()
        if not n:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        for w in [w for w in counts if len(w) > LONG and w not in self.words]:
            total += counts.pop(w) * self._long_score(w)
        words = list(counts)
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            if len(self._rows) + len(part) > self._room:
                self._rows = dict(self.words)
            if unseen := [w for w in part if w not in self._rows]:
                self._learn(unseen)
            times = np.fromiter((counts[w] for w in part), np.float64, len(part))
            total += times @ self._table[[self._rows[w] for w in part]]
        odds = total / np.sqrt(n)
        odds = np.exp(odds - odds.max())
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum())


def blocks(word: str, max_n: int) -> Iterator[tuple[str, int]]:
    """A word between its marks in blocks that overlap by ``max_n`` - 1, and the places that are each block's own."""
    padded = f"^{word}$"
    for at in range(0, len(padded), BLOCK):
        yield padded[at : at + BLOCK + max_n - 1], min(BLOCK, len(padded) - at)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_lang: int = 2000, max_n: int = 4) -> LanguageModel:
    """Learn from about ``docs_per_lang`` documents of each language, chosen by a hash of the id.

    All words of these documents reach the driver as counts, so the model is bounded by that sample
    and by the number of languages, whatever the size of the table.
    """
    rows = labelled.select(col(doc_id).alias("i"), col(text).alias("t"), col(lang).alias("l")).where("i IS NOT NULL AND t IS NOT NULL AND l IS NOT NULL").where(~held_out(F.col("i")))
    sizes = written(rows.groupBy("l").agg(F.count("*").alias("n")), "languages")
    draw = F.pmod(F.xxhash64(F.col("i"), F.lit("language sample")), F.lit(1_000_003))
    sample = rows.join(sizes, "l").where(draw < F.lit(docs_per_lang) / F.col("n") * 1_000_003)
    words = sample.select("l", F.explode(F.expr(r"regexp_extract_all(lower(t), '\\p{L}[\\p{L}\\p{M}]*', 0)")).alias("w"))
    by_lang: dict[str, dict[str, int]] = {r["l"]: {} for r in sizes.collect()}
    counts = words.groupBy("l", "w").agg(F.count("*").alias("n")).toArrow()
    for part in counts.to_batches(10_000):
        for lang_, word, n in zip(*[c.to_pylist() for c in part.columns], strict=True):
            by_lang[lang_][word] = n
    return build({k: dict(sorted(found.items())) for k, found in by_lang.items()}, max_n)


def build(by_lang: dict[str, dict[str, int]], max_n: int = 4, least: int = 2) -> LanguageModel:
    """A model from word counts of each language.

    A word is known if it was seen ``least`` times in all; one that was seen once says no more than its
    n-grams do, which are learned from every word.
    """
    langs = sorted(by_lang)
    totals = Counter()
    grams: list[dict[str, list[int]]] = [{} for _ in range(max_n + 1)]
    for k, lang in enumerate(langs):
        for word, n in by_lang[lang].items():
            totals[word] += n
            for padded, places in blocks(word, max_n):
                for size in range(1, max_n + 1):
                    of_size = grams[size]
                    for at in range(min(places, len(padded) - size + 1)):
                        gram = padded[at : at + size]
                        seen = of_size.get(gram)
                        if seen is None:
                            seen = of_size[gram] = [0] * len(langs)
                        seen[k] += n
    words = [w for w, n in totals.items() if n >= least]
    sums = np.array([sum(by_lang[lang].values()) for lang in langs], float)

    def logs(seen: np.ndarray, sums: np.ndarray) -> np.ndarray:
        scores = np.log(np.where(seen > 0, seen, 0.5) / np.maximum(sums, 1.0))
        return scores - scores.max(axis=1, keepdims=True) if len(scores) else scores

    known = np.array([[by_lang[lang].get(w, 0) for lang in langs] for w in words], float).reshape(len(words), len(langs))
    tables = [np.array(list(g.values()), float).reshape(len(g), len(langs)) for g in grams]
    rows = [g for of_size in grams for g in of_size]
    scores = np.concatenate([logs(t, t.sum(axis=0)) for t in tables])
    return LanguageModel(langs, {w: i for i, w in enumerate(words)}, logs(known, sums), {g: i for i, g in enumerate(rows)}, scores, max_n)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Every row of ``docs`` with the predicted language and its score added."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.words, model.word_scores, model.grams, model.gram_scores, model.max_n))
    return add_columns(docs, text, lambda: LanguageModel(*shared.value).predict, [(pred, "string"), (score, "double")])


def keep_identified(docs: DataFrame, least: float = 0.34, lang: str = "lang", **fit_options: int) -> DataFrame:
    """``docs`` without the rows that are in no language that can be told; ``lang`` is the language told.

    A row goes if its text is null or has no letter, or if no language has more than about
    a third of the belief. The columns stay as they were but for ``lang``, which takes the prediction.
    """
    model = fit(docs, lang=lang, **fit_options)
    pred = free_name(docs, "lang_pred")
    score = free_name(docs, "score")
    scored = identify(docs, model, pred=pred, score=score)
    return scored.where((col(pred) != UNKNOWN) & (col(score) >= least)).select(*[col(pred).alias(c) if c == lang else col(c) for c in docs.columns])
