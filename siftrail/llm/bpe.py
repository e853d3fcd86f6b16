"""Byte-pair encoding by guessing first: longest matches, pair checks, exact merges for the rest.

A sequence of tokens is what exact merging makes of a word if and only if each token alone and
each adjacent pair, merged exactly, comes out as it stands. So the longest tokens that match,
from left to right, are proposed for every new word; all adjacent pairs of a batch are tested at
once against the pairs known to hold; and only words with a failing pair are merged exactly. Each
of the three steps takes all new words of a batch together, in arrays. Words of late are remembered,
and so are the stretches between white space that hold them, as no word goes beyond its stretch.

Edge cases: a null or empty text has no tokens and decodes to the empty string. Special tokens in
a text become their own ids, as the vocabulary file says. Repeated rows are encoded one by one,
very long texts whole; the other columns pass through, and those named as an output are replaced. Equal
texts have equal ids. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siftrail.llm.common import col, map_batches, pa_type

Word = tuple[int, str, str]

ARRAYS_TO = 256  # bytes of a word; longer ones are merged one by one
NEVER = np.iinfo(np.int32).max
NAME = 24  # bytes of most tokens' names
SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to Python alone
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


# Letters and numbers that Unicode 16 added, which the library's patterns know, and the lower
# case forms of letters that Unicode 16 and 17 added, which it applies, as first and last and the way down.
ADDED_LETTERS = "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0"
ADDED_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
ADDED_LOWER = "1C89-1C89+1 A7CB-A7CB-A567 A7CC-A7CC+1 A7CE-A7CE+1 A7D2-A7D2+1 A7D4-A7D4+1 A7DA-A7DA+1 A7DC-A7DC-A641 10D50-10D65+20 16EA0-16EB8+1B"


@cache
def newer_characters() -> tuple[re.Pattern, str, dict[int, int]]:
    """What Unicode added after 15.1, Python's own version: a quick pattern for texts that may have it, the ranges that are letters
    or numbers to the pattern module but not yet to the library, and the lower case forms to apply."""
    spans = [[int(x, 16) for x in r.split("-")] for r in f"{ADDED_LETTERS} {ADDED_NUMBERS}".split()]
    added = {c for a, b in spans for c in range(a, b + 1)}
    found = regex.compile(r"(\w+)-(\w+)([+-]\w+)").findall(ADDED_LOWER)
    lower = {c: c + int(by, 16) for a, b, by in found for c in range(int(a, 16), int(b, 16) + 1)}
    known = regex.compile(r"[\p{L}\p{N}]+").findall("".join(map(chr, range(0x80, 0x110000))))
    codes = [ord(x) for run in known for x in run if unicodedata.category(x) == "Cn"]
    rare = re.compile(f"[{_within([c for c in [*codes, *lower] if c < 0x10000])}\\U00010000-\\U0010FFFF]")
    return rare, _within([c for c in codes if c not in added]), lower


def _within(codes: list[int]) -> str:
    """The inside of a character class that holds ``codes``."""
    codes = sorted(set(codes)) or [0x10FFFF]
    first = [c for c, before in zip(codes, [-2, *codes], strict=False) if c != before + 1]
    last = [c for c, after in zip(codes, [*codes[1:], -2], strict=True) if c != after - 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(first, last, strict=True))


class Recent(dict):
    """Encodings of late, as bytes of int32 ids, and in ``older`` those before them; together some two times ``most``."""

    def __init__(self, most: int, always: dict[str | int, bytes]) -> None:
        super().__init__(always)
        self.most, self.always, self.older = most, always, {}

    def __missing__(self, key: str) -> bytes:
        self[key] = ids = self.older[key]
        return ids

    def unknown(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` that must be learned, after room was made for all of them."""
        new, older = keys.difference(self.older), self.older
        again = keys.difference(new)
        if len(self) + len(keys) > self.most:
            self.older = dict(self)
            self.clear()
            self.update(self.always)
        self.update(zip(again, map(older.__getitem__, again), strict=True))
        return list(new)

    def drop_long(self, keys: Iterable[str], most: int = 64) -> None:
        """Forget what is too long to come again."""
        for k in [k for k in keys if len(k) > most]:
            self.pop(k, None)


class Words:
    """The words that are remembered, each with its number of tokens, their ids and names."""

    def __init__(self, bpe: WordBpe) -> None:
        self.bpe = bpe

    def __getitem__(self, word: str | int) -> Word:
        ids = np.frombuffer(self.bpe.known[word], np.int32).tolist()
        return len(ids), " ".join(map(str, ids)), self.bpe.decode(ids)


class WordBpe:
    """A byte-level BPE vocabulary with word ends, read from its JSON file."""

    def __init__(self, path: str, cached_words: int = 150_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.names = {i: t for t, i in self.ids.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.specials.items()}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.newer, within, self.newer_lower = newer_characters()
        self.words_of_newer = regex.compile(pattern.replace(r"\p{L}", rf"[\p{{L}}--[{within}]]").replace(r"\p{N}", rf"[\p{{N}}--[{within}]]"), regex.V1)
        letters = byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.inner_ids = [self.ids[x] for x in self.letters]
        self.last_ids = [self.ids[x + self.end] for x in self.letters]
        self.inner = {t: i for t, i in self.ids.items() if not t.endswith(self.end)}
        self.final = {t[: -len(self.end)]: i for t, i in self.ids.items() if t.endswith(self.end)}
        self.plain = pattern == LETTERS_APART
        self._lay_out()
        self.good = np.empty(0, np.int64)
        self.bad = np.empty(0, np.int64)
        self.known = Recent(cached_words, {t: np.int32(t).tobytes() for t in self.specials.values()})
        self.stretches = Recent(cached_words, {})
        self.cache = Words(self)
        self.apart = self._words_stand_apart()

    def _lay_out(self) -> None:
        """Names, merges, spellings and the tree of the tokens' letters as arrays."""
        n = max(self.names) + 1
        names = [(self.names.get(i, "") + " ").encode("utf-8") for i in range(n)]
        self.name_n = np.fromiter(map(len, names), np.int64, n)
        self.name_at, self.name_bytes = self.name_n.cumsum() - self.name_n, np.frombuffer(b"".join(names), np.uint8)
        self.long_name = np.array([len(x) > NAME or b"\0" in x for x in names])
        self.short_names, self.id_texts = np.array(names, f"S{NAME}"), np.array([b"%d " % i for i in range(n)])
        keys = np.fromiter((a << 32 | b for a, b in self.ranks), np.int64, len(self.ranks))
        to = np.array(list(self.ranks.values()), np.int64).reshape(-1, 2)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], to[order, 0].astype(np.int32)
        self.made = np.zeros(to[:, 0].max(initial=0) + 1, np.int32)
        self.made[to[:, 0]] = to[:, 1]
        self.inner_of, self.last_of = np.array(self.inner_ids, np.int32), np.array(self.last_ids, np.int32)
        byte_of = {x: b for b, x in enumerate(self.letters)}
        tree, ends = {}, ([], [])
        spelled, self.spelled_n = [b""] * n, np.zeros(n, np.int64)
        closed = np.zeros(n, bool)
        for k, names in enumerate((self.inner, self.final)):
            for name, token in names.items():
                try:
                    raw = bytes([byte_of[x] for x in name])
                except KeyError:
                    continue  # no bytes spell it
                if not raw:
                    continue
                node = 0
                for byte in raw:
                    node = tree.setdefault(node << 8 | byte, len(tree) + 1)
                ends[k].append((node, token))
                spelled[token], self.spelled_n[token], closed[token] = raw, len(raw), k
        self.spelled_at = self.spelled_n.cumsum() - self.spelled_n
        raw = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled = self.inner_of[raw]
        last = (self.spelled_at + self.spelled_n - 1)[closed]
        self.spelled[last] = self.last_of[raw[last]]
        keys = np.fromiter(tree, np.int64, len(tree))
        order = np.argsort(keys)
        self.tree_keys, self.tree_nodes = keys[order], (order + 1).astype(np.int64)
        self.inner_at, self.final_at = np.full((2, len(tree) + 1), -1, np.int32)
        for at, pairs in zip((self.inner_at, self.final_at), ends, strict=True):
            for node, token in pairs:
                at[node] = token
        self.whole = np.full(n, -1, np.int8)  # whether a token, spelled and merged, is itself again; -1: not asked yet

    def _words_stand_apart(self) -> bool:
        """Whether words and special tokens keep within white space, as far as trying tells."""
        find, ends = self.words.findall, ("", "a", "1", "!", "'", "'s")
        spaces = [x for x in map(chr, range(0x3001)) if x.isspace() and x not in SEPARATORS]
        return not any(x.isspace() for name in self.specials for x in name) and all(find(a + x + b) == find(a) + find(b) for x in spaces for a in ends for b in ends)

    # Exact merging, for pairs seen for the first time and for words whose guess failed.

    def merged(self, symbols: list[int]) -> list[int]:
        """What merging the lowest rank first, leftmost first, makes of ``symbols``."""
        if len(symbols) > 40:
            return self._merged_long(symbols)
        get, out = self.ranks.get, list(symbols)
        found = [get(p) for p in zip(out, out[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, f in enumerate(found):
                if f is not None and (best is None or f[0] < best[0]):
                    best, at = f, i
            if best is None:
                return out
            out[at : at + 2] = [best[1]]
            del found[at]
            if at > 0:
                found[at - 1] = get((out[at - 1], out[at]))
            if at < len(found):
                found[at] = get((out[at], out[at + 1]))

    def _merged_long(self, symbols: list[int]) -> list[int]:
        get, out, n = self.ranks.get, list(symbols), len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(f[0], i, out[i], out[i + 1], f[1]) for i in range(n - 1) if (f := get((out[i], out[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i]
            if out[i] != a or j < 0 or out[j] != b:
                continue
            out[i], out[j], right[i] = new, -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (f := get((out[x], out[y]))):
                    heapq.heappush(heap, (f[0], x, out[x], out[y], f[1]))
        return [t for t in out if t >= 0]

    def symbols(self, raw: bytes) -> list[int]:
        return [self.inner_ids[b] for b in raw[:-1]] + [self.last_ids[raw[-1]]]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NEVER where none merges it; -1 stands for no symbol."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER) if len(self.pair_keys) else np.full(keys.shape, NEVER, np.int32)

    def merged_all(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``merged`` makes of each sequence: the sequences stand one after another, and so do the results."""
        starts, counts = lengths.cumsum() - lengths, np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        rows, parts, at = [], [], 0
        while at < len(order):
            width = int(lengths[order[min(at + 2000, len(order) - 1)]])
            some = order[at : at + min(2000, max(20, 40_000 // (width + 1)))]
            at += len(some)
            width = int(lengths[some[-1]])
            if width > ARRAYS_TO:
                each = [self.merged(symbols[starts[k] : starts[k] + lengths[k]].tolist()) for k in some.tolist()]
                counts[some] = [len(x) for x in each]
                parts.append(np.array([t for x in each for t in x], np.int32))
            else:
                places = np.arange(width + 1)
                inside = places < lengths[some, None]
                grid = np.where(inside, symbols[np.where(inside, starts[some, None] + places, 0)], -1).astype(np.int32)
                self._merge_rows(grid)
                counts[some] = (grid >= 0).sum(1)
                parts.append(grid[grid >= 0])
            rows.append(some)
        if not rows:
            return np.empty(0, np.int32), counts
        out = np.empty(int(counts.sum()), np.int32)
        some = np.concatenate(rows)
        out[_ranges((counts.cumsum() - counts)[some], counts[some])] = np.concatenate(parts)
        return out, counts

    def _merge_rows(self, grid: np.ndarray) -> None:
        """Merge in each row, step by step, the pair of lowest rank, leftmost first. Free places, one at the end of each row at least, hold -1."""
        n, width = grid.shape
        ranks = np.full((n, width), NEVER, np.int32)
        ranks[:, :-1] = self._rank(grid[:, :-1], grid[:, 1:])
        places = np.arange(n * width).reshape(n, width)
        right, left = places + 1, places - 1
        right[:, -1], left[:, 0] = places[:, -1], places[:, -1]
        symbols, rank, right, left = grid.ravel(), ranks.ravel(), right.ravel(), left.ravel()
        row = np.arange(n)
        while True:
            at = row * width + ranks[row].argmin(1)
            best = rank[at]
            on = best < NEVER
            row, at, best = row[on], at[on], best[on]
            if not len(row):
                return
            gone, before, new = right[at], left[at], self.made[best]
            after = right[gone]
            symbols[at], symbols[gone], rank[gone] = new, -1, NEVER
            right[at], left[after] = after, at
            found = self._rank(np.concatenate([new, symbols[before]]), np.concatenate([symbols[after], new]))
            rank[at], rank[before] = found[: len(row)], found[len(row) :]

    # The guess.

    def guessed(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The longest token from each place of a word on; the last one must carry the word's end. All tokens, and how many each word has."""
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        flat, ends = np.frombuffer(b"".join(raws), np.uint8), lengths.cumsum()
        words, owners, tokens = np.flatnonzero(lengths), [], []
        at, end = (ends - lengths)[words], ends[words]
        while len(words):
            token, reached = np.full(len(words), -1, np.int32), at.copy()
            going, node, place = np.arange(len(words)), np.zeros(len(words), np.int64), at
            while len(going):
                keys = node << 8 | flat[place]
                found = np.searchsorted(self.tree_keys, keys)
                found[found == len(self.tree_keys)] = 0
                on = self.tree_keys[found] == keys
                going, node, place = going[on], self.tree_nodes[found[on]], place[on] + 1
                last = place == end[going]
                got = np.where(last, self.final_at[node], self.inner_at[node])
                hit = got >= 0
                token[going[hit]], reached[going[hit]] = got[hit], place[hit]
                going, node, place = going[~last], node[~last], place[~last]
            owners.append(words)
            tokens.append(token)
            on = reached < end
            words, at, end = words[on], reached[on], end[on]
        owner = np.concatenate([np.empty(0, np.int64), *owners])
        return np.concatenate([np.empty(0, np.int32), *tokens])[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(raws))

    def _spelled(self, tokens: np.ndarray) -> np.ndarray:
        return self.spelled[_ranges(self.spelled_at[tokens], self.spelled_n[tokens])]

    def tokens_hold(self, tokens: np.ndarray) -> np.ndarray:
        """For each token, whether exact merging of its letters gives it."""
        new = tokens[self.whole[tokens] < 0]
        if len(new):
            new = np.unique(new)
            merged, n = self.merged_all(self._spelled(new), self.spelled_n[new])
            self.whole[new] = (n == 1) & (merged[n.cumsum() - n] == new)
        return self.whole[tokens] == 1

    def pairs_hold(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of tokens side by side, whether exact merging keeps it so."""
        keys = left.astype(np.int64) << 32 | right
        good = _in_sorted(keys, self.good)
        new = keys[~good]
        new = np.unique(new[~_in_sorted(new, self.bad)])
        if len(new):
            pairs = np.stack([new >> 32, new & 0xFFFFFFFF], 1)
            merged, n = self.merged_all(self._spelled(pairs.ravel()), self.spelled_n[pairs].sum(1))
            first = n.cumsum() - n
            holds = self.tokens_hold(pairs.ravel()).reshape(-1, 2).all(1) & (n == 2)
            holds[holds] = (merged[first[holds]] == pairs[holds, 0]) & (merged[first[holds] + 1] == pairs[holds, 1])
            self.good, self.bad = (np.sort(np.concatenate(x), kind="stable") for x in ((self.good, new[holds]), (self.bad, new[~holds])))
            good[~good] = _in_sorted(keys[~good], self.good)
        return good

    def learn(self, words: list[str]) -> None:
        """Remember the encodings of new words."""
        raws = [w.encode("utf-8") for w in words]
        fails = np.fromiter((len(r) > ARRAYS_TO for r in raws), bool, len(raws))
        tokens, counts = self.guessed([b"" if f else r for r, f in zip(raws, fails.tolist(), strict=True)])
        owner = np.repeat(np.arange(len(raws)), counts)
        inside = owner[:-1] == owner[1:]
        fails[owner[:-1][inside][~self.pairs_hold(tokens[:-1][inside], tokens[1:][inside])]] = True
        alone = np.flatnonzero(counts == 1)
        fails[alone] = ~self.tokens_hold(tokens[(counts.cumsum() - counts)[alone]])
        again = np.flatnonzero(fails)
        if len(again):
            lengths = np.array([len(raws[k]) for k in again.tolist()], np.int64)
            flat = np.frombuffer(b"".join([raws[k] for k in again.tolist()]), np.uint8)
            symbols, last = self.inner_of[flat], lengths.cumsum() - 1
            symbols[last] = self.last_of[flat[last]]
            merged, counts[again] = self.merged_all(symbols, lengths)
            kept = ~fails[owner]
            owner = np.concatenate([owner[kept], np.repeat(again, counts[again])])
            tokens = np.concatenate([tokens[kept], merged])[np.argsort(owner, kind="stable")]
        ends, ids = counts.cumsum() * 4, tokens.astype(np.int32).tobytes()
        self.known.update(zip(words, map(ids.__getitem__, map(slice, (ends - counts * 4).tolist(), ends.tolist())), strict=True))

    # Texts.

    def pieces(self, text: str) -> Iterator[str | int]:
        """The words of a text in order, and the ids of special tokens among them."""
        for part in self.special_split.split(text) if self.special_split else [text]:
            if part in self.specials:
                yield self.specials[part]
            elif part:
                plain = unicodedata.normalize("NFC", part)
                plain = plain.replace("Σ", "σ").lower() if "Σ" in plain else plain.lower()
                if not plain.isascii() and self.newer.search(plain):
                    yield from self.words_of_newer.findall(plain.translate(self.newer_lower))
                else:
                    yield from self.words.findall(plain)

    def _words_of(self, text: str) -> list[str]:
        if self.plain:
            if text.isalpha():
                return [text]
            if text[-1] in ".,:;!?" and text[:-1].isalpha():
                return [text[:-1], text[-1]]
        return self.words.findall(text)

    def _pieces_of_all(self, stretches: list[str]) -> list[list[str | int]]:
        """``pieces`` of each stretch; those without special tokens and newer letters are taken together."""
        whole = " ".join(stretches)
        odd = [s.search for s, here in ((self.special_split, True), (self.newer, not whole.isascii())) if s and here and s.search(whole)]
        plain = [s for s in stretches if not any(search(s) for search in odd)] if odd else stretches
        whole = unicodedata.normalize("NFC", " ".join(plain) if odd else whole).replace("Σ", "σ").lower()
        find, split = self._words_of, iter(whole.split(" "))
        if odd:
            return [list(self.pieces(s)) if any(search(s) for search in odd) else find(next(split)) for s in stretches]
        return [find(s) for s in split]

    def learn_stretches(self, stretches: list[str]) -> None:
        """Remember the encodings of new stretches."""
        if not stretches:
            return
        split, known = self._pieces_of_all(stretches), self.known
        new = {w for words in split for w in words}.difference(known)
        self._learn_all(known.unknown(new))
        self.stretches.update((s, known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])) for s, words in zip(stretches, split, strict=True))
        known.drop_long(new)

    def _learn_all(self, words: list[str]) -> None:
        for at in range(0, len(words), 100_000):
            self.learn(words[at : at + 100_000])

    def tokens(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The token ids of each text."""
        if self.apart:
            known, learn, cut = self.stretches, self.learn_stretches, _between_spaces
        else:
            known, learn, cut = self.known, self._learn_all, lambda text: list(self.pieces(text))
        split = [cut(t) if t else [] for t in texts]
        coded = [list(map(known.get, keys)) for keys in split]
        gaps = [[i for i, ids in enumerate(found) if ids is None] for found in coded]
        new = {keys[i] for keys, places in zip(split, gaps, strict=True) for i in places}
        learn(known.unknown(new))
        for keys, found, places in zip(split, coded, gaps, strict=True):
            for i in places:
                found[i] = known[keys[i]]
        known.drop_long(new)
        for found in coded:
            yield np.frombuffer(b"".join(found), np.int32)

    def encode(self, texts: Iterable[str | None]) -> Iterator[list[Word]]:
        """For each text, its tokens one by one: a count of one, the id and the name."""
        for ids in self.tokens(texts):
            yield [(1, str(t), self.names[t]) for t in ids.tolist()]

    def id_pieces(self, ids: np.ndarray) -> Iterator[bytes]:
        """The decimal ids, one space between them, in pieces."""
        for at in range(0, len(ids), 1 << 16):
            piece = self.id_texts[ids[at : at + (1 << 16)]].tobytes().translate(None, b"\0")
            yield piece if at + (1 << 16) < len(ids) else piece[:-1]

    def name_pieces(self, ids: np.ndarray) -> Iterator[bytes]:
        """The tokens' names in UTF-8, one space between them, in pieces."""
        for at in range(0, len(ids), 1 << 16):
            some = ids[at : at + (1 << 16)]
            if self.long_name[some].any():
                piece = self.name_bytes[_ranges(self.name_at[some], self.name_n[some])].tobytes()
            else:
                piece = self.short_names[some].tobytes().translate(None, b"\0")
            yield piece if at + (1 << 16) < len(ids) else piece[:-1]

    def token_ids(self, text: str | None) -> list[int]:
        return next(self.tokens([text])).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' own names, one space between them: the file has no decoder."""
        return " ".join([self.names[t] for t in ids])


def _between_spaces(text: str) -> list[str]:
    """The stretches between white space; some separators, which only Python calls white space, stay within."""
    return [x for x in text.split(" ") if x] if any(x in text for x in SEPARATORS) else text.split()


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all ranges, one range after another."""
    return np.repeat(starts - (lengths.cumsum() - lengths), lengths) + np.arange(int(lengths.sum()))


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def encode_decode(docs: DataFrame, vocabulary: Callable[[], str], text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens", decoded: str = "decoded", digests: bool = False) -> DataFrame:
    """Every row with its token ids, their number and the decoded text added.

    ``vocabulary()`` gives the path of the vocabulary file on the machine that runs the task.
    With ``digests``, the ids and the decoded text are given as SHA-256 in hex: of the decimal
    ids joined by one space, and of the text in UTF-8.
    """
    added = [(n_tokens, "bigint"), (ids, "string" if digests else "array<int>"), (decoded, "string")]
    new = {name.lower() for name, _ in added}
    kept = [c for c in docs.columns if c.lower() not in new or c == text]
    frame = docs.select(*[col(c) for c in kept]).toDF(*[f"c{i}" for i in range(len(kept))])
    at = kept.index(text)
    kinds = [T._parse_datatype_string(kind) for _, kind in added]
    schema = T.StructType([*frame.schema.fields, *[T.StructField(f"n{i}", k) for i, k in enumerate(kinds)]])
    arrow = [pa_type(k) for k in kinds]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary())
        for batch in batches:
            coded = list(bpe.tokens(batch.column(at).to_pylist()))
            counts = [len(ids) for ids in coded]
            if digests:
                columns = [counts, [_sha(bpe.id_pieces(ids)) for ids in coded], [_sha(bpe.name_pieces(ids)) for ids in coded]]
            else:
                ends = pa.array(np.cumsum([0, *counts]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(coded)), type=arrow[1])
                columns = [counts, lists, [b"".join(bpe.name_pieces(ids)).decode("utf-8") for ids in coded]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, arrow, strict=True)]], names=schema.names)

    return map_batches(frame, run, schema).toDF(*kept, *[name for name, _ in added])


def _sha(pieces: Iterable[bytes]) -> str:
    found = hashlib.sha256()
    for piece in pieces:
        found.update(piece)
    return found.hexdigest()


_LOADED: dict[str, WordBpe] = {}


def _loaded(path: str) -> WordBpe:
    """The vocabulary of a path, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
