"""The main text of a page as the best-scoring run of its words and tags.

Words score positive where they stand like words of a main text, tags negative. The weights are
fitted on labelled pages (``labelled``): logistic regression over the tags and the class, id and role
words around a text, its share of links, its length and its place on the page, and for each tag how
much more often it stood outside the main text. One linear scan then finds the contiguous run with
the highest sum. Adverts and the like may stand in the middle of an article, so the same scan may leave
stretches out of the run, at a cost for each.

Edge cases: null, empty or tag-only pages give an empty text, and so do pages of which every word
scores negative. Of equal runs the first, longest one is taken. Unclosed and stray tags, quotes and
comments are read the way browsers read them, near enough; hidden elements are not read. Nothing is
capped: very long pages are read whole. Repeated rows and rows without an id or a URL are read like
any other. Other columns pass through; those named as an output are replaced.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from siftrail.llm.common import add_columns
from siftrail.llm.labelled import LONG, PAGES, PARAGRAPHS, SHORT

# Fixed values of the format: which elements break a block, hold no text of the page, or have no end.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OWN_END = frozenset("p li dt dd option tr td th".split())
TAG = re.compile(r"<!--(?P<comment>.*?)(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
ATTR_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
NOT_OWN = frozenset(("has", "with", "no", "without"))  # "has-sidebar" is said of what surrounds a sidebar
HOMES = {"article": 0.25, "main": 0.05}  # and their share of the words like main text that makes them home of it
PRIOR = 0.7  # the share of what a feature says alone that its weight is drawn towards


def attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}


def is_hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").lower().replace(" ", "")


def features(tag: str, attrs: dict[str, str]) -> list[str]:
    found = [f"tag {tag}"]
    for name in ("class", "id", "role"):
        before = ""
        for w in ATTR_WORD.findall(attrs.get(name, "")):
            w = w.lower()
            if w not in NOT_OWN and before not in NOT_OWN:
                found.append(f"word {w}")
            before = w
    return found


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("open", tag, attributes), ("close", tag, ""), ("text", decoded text, "") and ("comment", text, "") in order."""
    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            yield "text", html_lib.unescape(page[at:]), ""
            return
        if m.start() > at:
            yield "text", html_lib.unescape(page[at : m.start()]), ""
        at = m.end()
        if m["comment"]:
            yield "comment", m["comment"], ""
        if m["cdata"]:
            yield "text", m["cdata"], ""
        name = m["name"] or m["name2"]
        if not name:
            continue
        tag = name.lower()
        if m["end"] or m["end2"]:
            yield "close", tag, ""
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = stop.start() if stop else n
            if stop:
                at = page.find(">", at) + 1 or n
            continue
        yield "open", tag, attrs


@dataclass
class Text:
    """A piece of text between two tags: its block, its words, what surrounds it."""

    block: int
    words: int
    around: frozenset[str]
    home: str
    gold: bool


@dataclass
class Page:
    """A page as a sequence of tags (by name) and texts, and the parts that make up its blocks."""

    tokens: list[str | Text] = field(default_factory=list)
    parts: list[list[str]] = field(default_factory=lambda: [[]])

    def texts(self) -> list[Text]:
        return [t for t in self.tokens if isinstance(t, Text)]


def read_page(page: str) -> Page:
    out = Page()
    parts, tokens = out.parts, out.tokens
    stack: list[tuple[str, frozenset[str], str, bool]] = []  # tag, features so far, in article or main, hidden
    nothing: frozenset[str] = frozenset()
    marks = {"main": False, "other": False}
    for kind, what, attrs in events(page):
        if kind == "comment":
            if what.lstrip("/") in marks:
                marks[what.lstrip("/")] = what[0] != "/"
            continue
        around, home, hidden = stack[-1][1:] if stack else (nothing, "", False)
        if kind == "text":
            if not hidden and what:
                parts[-1].append(what)
                if n := len(what.split()):
                    tokens.append(Text(len(parts) - 1, n, around, home, marks["main"] and not marks["other"]))
            continue
        if kind == "open":
            if what in VOID:
                if what == "br":
                    parts[-1].append(" ")
                if what == "hr" and parts[-1]:
                    parts.append([])
                tokens.append(what)
                continue
            if what in OWN_END and stack and stack[-1][0] == what:
                stack.pop()
                around, home, hidden = stack[-1][1:] if stack else (nothing, "", False)
            if what in BLOCKS and parts[-1]:
                parts.append([])
            named = attributes(attrs) if attrs else {}
            if what not in ("html", "body"):
                around = around.union(features(what, named))
            stack.append((what, around, what if what in HOMES and home != "main" else home, hidden or bool(named) and is_hidden(named)))
        else:
            if what in BLOCKS and parts[-1]:
                parts.append([])
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == what:
                    del stack[depth:]
                    break
                if stack[depth][0] in ("article", "body") and what not in ("html", "body"):
                    break
        tokens.append(what)
    return out


def shape(page: Page) -> list[list[str]]:
    """For each text of a page what its block is like: links, length, last mark, place."""
    texts = page.texts()
    words, links = Counter(), Counter()
    for t in texts:
        words[t.block] += t.words
        links[t.block] += t.words if "tag a" in t.around else 0
    all_words, seen, out = words.total(), 0, []
    known: dict[int, list[str]] = {}
    for t in texts:
        if t.block not in known:
            n, found = words[t.block], []
            if links[t.block] * 2 > n:
                found.append("shape links")
            found.append("shape short" if n <= 3 else "shape medium" if n <= 12 else "shape long")
            if "".join(page.parts[t.block]).rstrip()[-1:] not in '.!?:"”»…。':
                found.append("shape open end")
            if seen * 20 < all_words:
                found.append("place top")
            elif (seen + n) * 20 > all_words * 19:
                found.append("place end")
            known[t.block] = found
            seen += n
        out.append(known[t.block])
    return out


@dataclass(frozen=True)
class Weights:
    """What surrounds a text, as log odds of main text; the cost of each tag.

    ``gap`` is the cost of leaving a stretch out of the run, ``least`` and ``most`` bound a word's score.
    """

    words: dict[str, float]
    tags: dict[str, float]
    base: float
    gap: float = 0.5
    least: float = -4.0
    most: float = 2.0
    least_cost: float = 0.02
    most_cost: float = 0.5

    def cost(self, tag: str) -> float:
        return min(self.most_cost, max(self.least_cost, self.tags.get(tag, self.least_cost)))

    def logits(self, page: Page) -> list[float]:
        get, sums = self.words.get, {}
        out = []
        for t, shaped in zip(page.texts(), shape(page), strict=True):
            if t.around not in sums:
                sums[t.around] = self.base + sum(get(f, 0.0) for f in t.around)
            out.append(sums[t.around] + sum(get(f, 0.0) for f in shaped))
        away = get("away from home", 0.0)
        if away:
            out = [x + away * a for x, a in zip(out, away_from_home(page, out), strict=True)]
        return out


def away_from_home(page: Page, logits: list[float]) -> list[bool]:
    """Whether a text is outside of article and main, on a page whose main text is within them."""
    texts = page.texts()
    good = [(t.words, t.home) for t, x in zip(texts, logits, strict=True) if x > 0]
    held = Counter()
    for n, home in good:
        held[home] += n
    has_home = any(held[tag] > 0 and held[tag] >= share * held.total() for tag, share in HOMES.items())
    return [has_home and not t.home for t in texts]


def best_run(scores: list[float], gap: float = math.inf) -> list[tuple[int, int]]:
    """The contiguous run with the highest positive sum, as the bounds of its parts.

    One scan from left to right. Stretches may be left out of the run at a cost of ``gap`` each; with
    an infinite cost the run has one part. There is no part if no sum is positive.
    """
    inside, outside = -math.inf, -math.inf  # the best run that ends here, and one whose gap is open here
    came, best, end = bytearray(len(scores)), 0.0, -1  # how a run got here: 0 began, 1 went on, 2 after a gap; 4: this gap went on
    for i, s in enumerate(scores):
        opened = inside - gap
        after = max(0.0, inside, outside)
        came[i] = 0 if after == 0.0 else 1 if after == inside else 2
        if outside >= opened:
            came[i] |= 4
        outside = max(outside, opened)
        inside = after + s
        if inside > best:
            best, end = inside, i
    parts = []
    while end >= 0:
        last = end
        while came[end] & 3 == 1:
            end -= 1
        parts.append((end, last + 1))
        if came[end] & 3 == 0:
            break
        end -= 1  # within the gap that ends here
        while came[end] & 4:
            end -= 1
        end -= 1
    return parts[::-1]


def scored(page: Page, weights: Weights) -> list[float]:
    """The score of every token; the texts of one block share the mean of their log odds."""
    odds, sums, words = weights.logits(page), {}, Counter()
    for t, x in zip(page.texts(), odds, strict=True):
        words[t.block] += t.words
        sums[t.block] = sums.get(t.block, 0.0) + t.words * x
    of = {b: min(weights.most, max(weights.least, x / words[b])) for b, x in sums.items()}
    return [-weights.cost(t) if isinstance(t, str) else t.words * of[t.block] for t in page.tokens]


def chosen(page: Page, weights: Weights) -> list[int]:
    """The blocks of the best run."""
    parts = best_run(scored(page, weights), weights.gap)
    return sorted({t.block for first, last in parts for t in page.tokens[first:last] if isinstance(t, Text)})


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    known = read_page(page)
    # A text that began before the run or goes on after it belongs to the run's block all the same.
    texts = (" ".join("".join(known.parts[b]).split()) for b in chosen(known, weights))
    return "\n\n".join(t for t in texts if t)


# Fitting.


def fit(pages: list[str], ridge: float = 0.3, rounds: int = 25) -> Weights:
    """Weights from pages in which ``<!--main-->`` and ``<!--other-->`` mark the main text and what is not of it.

    Each page is also read with its long paragraphs moved from the main text into the rest, so
    that length alone does not settle what is what.
    """
    known = [read_page(p) for p in [*pages, *map(swapped, pages)]]
    gold = np.array([t.gold for p in known for t in p.texts()], float)
    size = np.array([min(t.words, 30) / max(1, len(p.texts())) for p in known for t in p.texts()])
    size *= len(size) / size.sum()
    rows = [[*t.around, *shaped] for p in known for t, shaped in zip(p.texts(), shape(p), strict=True)]
    tags = _tag_costs(known)
    first = _weights(_regress(rows, gold, size, ridge, rounds), tags)
    away = [a for p in known for a in away_from_home(p, first.logits(p))]
    words = _regress([r + ["away from home"] * a for r, a in zip(rows, away, strict=True)], gold, size, ridge, rounds)
    return _weights(words, tags)


def _weights(words: dict[str, float], tags: dict[str, float]) -> Weights:
    return Weights({f: w for f, w in words.items() if f}, tags, words[""])


def swapped(page: str, long: str = LONG, short: str = SHORT) -> str:
    """A labelled page with short sentences for long paragraphs, and long ones in what is not its main text."""
    out, inside = [], False
    for piece in re.split(r"(<!--/?(?:main|other)-->)", page):
        if piece.startswith("<!--"):
            inside = piece in ("<!--main-->", "<!--/other-->")
        for p in PARAGRAPHS if inside else ():
            piece = piece.replace(p, short)
        out.append(piece if inside else re.sub(r"</p>", f" {long}</p>", piece))
    return "".join(out)


def _regress(rows: list[list[str]], gold: np.ndarray, size: np.ndarray, ridge: float, rounds: int) -> dict[str, float]:
    """Logistic regression by Newton's method.

    Each weight is drawn towards a share of what the feature says taken alone, so that a word seen on few
    pages counts even if others explain them; the constant, named "", is drawn towards one.
    """
    names = sorted({f for r in rows for f in r})
    at = {f: i + 1 for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, 0] = 1
    for k, r in enumerate(rows):
        x[k, [at[f] for f in r]] = 1
    main, other = (np.minimum(1, size[gold == k]) @ x[gold == k] for k in (1, 0))
    goal = PRIOR * np.log((main + 0.5) / (other + 0.5) * other[0] / main[0])
    goal[0] = 1
    goal[[at[f] for f in names if f.startswith(("shape", "place"))]] = 0
    scale = np.array([1.0, *(3.0 if f.startswith(("shape", "place")) else 1.0 for f in names)]) * ridge * len(rows) / 100
    w = goal.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (size * (p - gold)) + scale * (w - goal)
        bend = (x * (size * p * (1 - p))[:, None]).T @ x + np.diag(scale)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 3 / max(1e-9, np.abs(step).max()))
    return dict(zip(["", *names], w.tolist(), strict=True))


def _tag_costs(pages: list[Page]) -> dict[str, float]:
    """How much more often a tag stood outside a main text, as log odds shared out over its words."""
    seen: dict[str, Counter[bool]] = {}
    for page in pages:
        inside = False
        for t in page.tokens:
            if isinstance(t, Text):
                inside = t.gold
            else:
                seen.setdefault(t, Counter())[inside] += 1
    return {t: 0.2 * math.log((c[False] + 1) / (c[True] + 1)) for t, c in seen.items()}


@cache
def fitted() -> Weights:
    """The weights of the labelled pages, fitted once in a process that asks."""
    return fit(PAGES)


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars", weights: Weights | None = None) -> DataFrame:
    """Every row with the main text of its page and the text's number of code points."""
    known = weights or fitted()

    def one(page: str | None) -> tuple[str, int]:
        found = main_text(page, known)
        return found, len(found)

    return add_columns(pages, html, lambda: one, [(text, "string"), (n_chars, "bigint")])
