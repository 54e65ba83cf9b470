"""Personal data: candidate spans, gradient-boosted trees and calibrated thresholds.

Base kinds are found by their expressions and checks. Beside them, generators of
high recall propose spans that may overlap. Boosted trees score a proposal by its
shape and its surroundings; they never see the checks of the base kinds. The
trees learn, for each generator, to tell proposals that are validated base spans (or
account numbers whose check digits hold) from all others, on a bounded sample of
documents. A second part of the sample
calibrates the scores, and a generator's threshold is the lowest score from which
on the calibrated precision is high enough. Proposals above it that touch no base
span and no better proposal are added.

Cases: null and empty texts have no spans; repeated rows are scanned alike;
without examples of both kinds nothing is added; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import saved, text_of

#: The base kinds, in order, and their expressions.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Runs of digits match from their first digit or not at all, so the tests before them change nothing.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Generators: wide shapes of what may be personal data.
GENERATORS = (
    ("handle", re.compile(r"(?<![^\s<(\[])[\w.+%-]{2,64}\s?(?:@|\[at\]|\(at\))\s?[\w-]{1,63}(?:\s?(?:\.|\[dot\]|\(dot\))\s?[\w-]{2,63}){1,5}")),
    ("number", re.compile(r"(?<![\w.])\(?[0-9][0-9 ().-]{5,30}[0-9](?![\w])")),
    ("dotted", re.compile(r"(?<![\w.])[0-9]{1,4}(?:\.[0-9]{1,4}){3,7}(?![\w])")),
    ("account", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?:[A-Z0-9]{1,3})?(?!\w)")),
)
CUES = re.compile(r"(?i)\b(?:e-?mail|mail|contact|phone|tel|call|mobile|fax|card|visa|account|iban|ip|host|address|ssn)\b")
AROUND = 24
#: Documents that the trees are fitted on: about so many by hash, and of each rare shape so
#: many more; and the most proposals of one generator and label.
TRAIN_DOCUMENTS, SHAPE_DOCUMENTS, TRAIN_PROPOSALS = 4_000, 1_000, 5_000
#: What every text with a proposal of a rare generator holds: handle, dotted, account.
HINTS = (r"@|[\[(]at[\])]", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}")
PRECISION = 0.95

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    doubled = [int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From one @ to the next: the run of local characters before it, then a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
            at = text.find("@", done)
        else:
            # The next address can't reach over this @.
            done, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds by kind, then start."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".") if p.lstrip("0")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(generator, start, end) of every proposal."""
    return [(i, *m.span()) for i, (_, shape) in enumerate(GENERATORS) for m in shape.finditer(text)]


def features(text: str, generator: int, start: int, end: int) -> list[float]:
    """Shape and surroundings of a proposal."""
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    groups = re.findall(r"\d+", span)
    sizes = [len(g) for g in groups] or [0]
    beside = (before[-1:], after[:1])
    return [
        generator, len(span), sum(sizes), len(groups), max(sizes), min(sizes), sizes[-1],
        span.count("."), span.count("-"), span.count(" "), span.count("("),
        sum(c.isalpha() for c in span), sum(c.isupper() for c in span),
        before.endswith("+") or before.endswith("+1 "), beside[0].isspace() or not beside[0],
        beside[1].isspace() or not beside[1], sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        sum(c.isalpha() for c in before), len(CUES.findall(before)), int(groups[0][:2]) if groups else -1,
    ]


class Trees:
    """Boosted regression trees on the logistic loss, over features cut at quantiles."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 16):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[list[tuple[int, int]], np.ndarray]] = []
        self.start = 0.0

    def cut(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], share)) for j in range(x.shape[1])]
        binned = self.cut(x)
        self.start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        raw = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            gradient, weight = y - p, p * (1 - p)
            leaf, splits = np.zeros(len(y), np.int64), []
            # All nodes of a level share one split: the tree is a table of 2**depth leaves.
            for level in range(self.depth):
                best = (-1.0, 0, 0)
                for j in range(x.shape[1]):
                    size = len(self.edges[j]) + 1
                    cell = leaf * size + binned[:, j]
                    g = np.bincount(cell, gradient, (1 << level) * size).reshape(-1, size).cumsum(axis=1)
                    h = np.bincount(cell, weight, (1 << level) * size).reshape(-1, size).cumsum(axis=1)
                    gain = (g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1)).sum(axis=0)
                    at = int(gain[:-1].argmax()) if size > 1 else 0
                    if size > 1 and gain[at] > best[0]:
                        best = (float(gain[at]), j, at)
                splits.append(best[1:])
                leaf = leaf * 2 + (binned[:, best[1]] > best[2])
            size = 1 << self.depth
            value = self.rate * np.bincount(leaf, gradient, size) / (np.bincount(leaf, weight, size) + 1)
            self.trees.append((splits, value))
            raw += value[leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned, raw = self.cut(x), np.full(len(x), self.start)
        for splits, value in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for j, at in splits:
                leaf = leaf * 2 + (binned[:, j] > at)
            raw += value[leaf]
        return raw


class Selector:
    """Trees, their calibration, and a threshold for each generator."""

    def __init__(self, x: np.ndarray, y: np.ndarray, precision: float = PRECISION):
        self.trees: Trees | None = None
        part = np.arange(len(y)) % 3 != 0
        if not len(y) or len(set(y[part])) < 2 or len(set(y[~part])) < 2:
            return
        self.trees = Trees().fit(x[part], y[part])
        margin, held = self.trees.margin(x[~part]), y[~part]
        self.slope, self.shift = self.calibrate(margin, held)
        chance = self.chance(margin)
        self.thresholds = np.full(len(GENERATORS), np.inf)
        for number in range(len(GENERATORS)):
            own = x[~part][:, 0] == number
            for low in np.unique(np.floor(chance[own] * 1e6) / 1e6):
                above = own & (chance >= low)
                # One wrong one is added to what was seen, so that a few examples prove little.
                if held[above].sum() / (above.sum() + 1) >= precision and low >= 0.5:
                    self.thresholds[number] = low
                    break

    @staticmethod
    def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Slope and shift of a logistic curve, by Newton steps."""
        point, columns = np.array([1.0, 0.0]), np.stack([margin, np.ones(len(y))], axis=1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(columns @ point, -30, 30)))
            slope = columns.T @ (y - p) - 1e-3 * (point - [1.0, 0.0])
            bend = (columns * (p * (1 - p))[:, None]).T @ columns + 1e-3 * np.eye(2)
            point = point + np.linalg.solve(bend, slope)
        return float(point[0]), float(point[1])

    def chance(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))

    def chosen(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated chances, and which of them reach their generator's threshold."""
        chance = self.chance(self.trees.margin(x))
        return chance, chance >= self.thresholds[x[:, 0].astype(int)]


def account_checks(span: str) -> bool:
    """The check digits of an international account number: rearranged and read as a number, 1 modulo 97."""
    plain = span.replace(" ", "")
    return len(plain) >= 15 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def examples(text: str) -> tuple[list[list[float]], list[int]]:
    """Features of a text's proposals, and whether each is what it looks like: an account
    number by its check digits, any other by a base span at the same place."""
    base = {(a, b) for _, a, b in base_spans(text)}
    found = proposals(text)

    def holds(number: int, a: int, b: int) -> bool:
        if GENERATORS[number][0] == "account":
            return account_checks(text[a:b])
        # A base phone may start at a plus sign, just before the shape of a number.
        return any((a - d, b) in base for d in range(5))

    return [features(text, *p) for p in found], [int(holds(*p)) for p in found]


def training_documents(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, shape: int = SHAPE_DOCUMENTS) -> DataFrame:
    """Texts to learn from: about ``documents`` by the hash of their ids, and, so that rare
    shapes are seen at any size, the ``shape`` of least hash among all that hold a generator's hint."""
    texts = docs.select(text_of().alias("text"), F.xxhash64("doc_id").alias("_h"), F.xxhash64("doc_id", text_of()).alias("_order"))
    every = max(1, docs.count() // documents)
    part = texts.filter(F.pmod(F.col("_h"), F.lit(every)) == 0)
    for hint in HINTS:
        part = part.unionByName(texts.filter(F.col("text").rlike(hint)).orderBy("_order", "text").limit(shape))
    return part.dropDuplicates(["_order"]).select("text")


def fitted(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, most: int = TRAIN_PROPOSALS) -> Selector:
    """A selector learned from the proposals of a bounded sample, ``most`` of each generator and label."""

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in parts:
            for text in frame["text"]:
                x, y = examples(text)
                if x:
                    yield pd.DataFrame({"x": [list(map(float, r)) for r in x], "y": y})

    found = saved(training_documents(docs, documents).mapInPandas(of, "x array<double>, y int"), "pii-examples")
    rows = []
    for number in range(len(GENERATORS)):
        for label in (0, 1):
            own = found.filter((F.col("x")[0] == number) & (F.col("y") == label))
            rows += own.orderBy(F.xxhash64("x"), "x").limit(most).collect()
    rows.sort(key=lambda r: (zlib.crc32(repr(r["x"]).encode()), r["x"], r["y"]))
    x = np.array([r["x"] for r in rows], float) if rows else np.zeros((0, 1))
    return Selector(x, np.array([r["y"] for r in rows], float))


def added(text: str, base: list[Span], found: list[tuple[int, int, int]], chance: np.ndarray, above: np.ndarray) -> list[Span]:
    """Proposals above their threshold, likeliest first, that touch nothing taken before."""
    taken = bytearray(len(text))
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)
    spans: list[Span] = []
    for i in sorted(np.flatnonzero(above), key=lambda i: (-chance[i], found[i])):
        number, a, b = found[i]
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            spans.append((GENERATORS[number][0], a, b))
    return spans


def found_spans(docs: DataFrame, selector: Selector) -> DataFrame:
    """doc_id with ``base`` and ``added``, arrays of (kind, start, end) by kind, then start."""
    span = "array<struct<kind:string,start:int,end:int>>"

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = {k: i for i, k in enumerate([*KINDS, *[n for n, _ in GENERATORS]])}
        for part in parts:
            texts = list(part["text"])
            base = [base_spans(t) for t in texts]
            found = [proposals(t) for t in texts]
            x = [features(t, *p) for t, ps in zip(texts, found, strict=True) for p in ps]
            more: list[list[Span]] = [[] for _ in texts]
            if x and selector.trees is not None:
                chance, above = selector.chosen(np.array(x, float))
                ends = np.cumsum([len(ps) for ps in found])
                for i, t in enumerate(texts):
                    own = slice(ends[i] - len(found[i]), ends[i])
                    more[i] = added(t, base[i], found[i], chance[own], above[own])
            row = lambda spans: [
                {"kind": k, "start": a, "end": b} for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1]))
            ]
            yield pd.DataFrame({"doc_id": part["doc_id"], "base": [row(s) for s in base], "added": [row(s) for s in more]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInPandas(of, f"doc_id {kind}, base {span}, added {span}")
