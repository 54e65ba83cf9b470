"""Quality scores from a regularised quadratic discriminant.

Statistics of a document are brought to a common scale, each class of labelled
documents gets a mean and a covariance drawn towards the pooled one and towards
its diagonal, and a score is the logistic of the difference of the two classes'
Gaussian log-densities plus their log prior. The covariances enter through
Cholesky factors that are worked out once and sent with the tasks.

All labelled rows count: only their sums and products, a few hundred figures,
reach the driver.

Cases: null and empty texts have all statistics zero and a score like any other;
repeated rows are scored alike; without labels of both classes every score is the
prior (0.5 without any label); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.common import text_of

FEATURES = (
    "upper", "digits", "marks", "symbols", "bars", "exclaims", "distinct_words", "twins", "top_word",
    "distinct_lines", "word_length", "long_words", "blanks", "stops",
)
THRESHOLD = 0.3
FOLDS = 5
#: Weight of the pooled covariance, and of its diagonal.
TO_POOLED, TO_DIAGONAL = 0.3, 0.1
#: Statistics beyond so many pooled deviations count as that far.
REACH = 6.0
#: The characters counted together.
UPPER = np.array([65 <= c <= 90 for c in range(256)])
DIGITS = np.array([48 <= c <= 57 for c in range(256)])
LETTERS = np.array([65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])
BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
MARKS = np.array([c in b".,;:?'\"()-" for c in range(256)])
SYMBOLS = np.array([c in b"#$%&*+<=>@[]^_`{}~/\\" for c in range(256)])


def statistics(text: str) -> list[float]:
    """Shares and lengths of one whole text, in the order of FEATURES."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = int(counts.sum())
    letters = max(1, int(counts[LETTERS].sum()))
    words = text.split()
    count = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    times = Counter(words)
    twins = sum(map(eq, words, words[1:]))
    rooted = lambda share: float(np.sqrt(share))
    return [
        rooted(counts[UPPER].sum() / letters),
        rooted(counts[DIGITS].sum() / size),
        rooted(counts[MARKS].sum() / count),
        rooted(counts[SYMBOLS].sum() / count),
        rooted(counts[ord("|")] / count),
        rooted(counts[ord("!")] / count),
        # Distinct words grow like a root of the length, so the share is set against that.
        float(np.log1p(len(times)) / np.log1p(count)),
        rooted(twins / count),
        rooted((max(times.values()) if times else 0) / (count + 10)),
        rooted(len(set(lines)) / max(1, len(lines))),
        float(np.log1p(letters / count)),
        rooted(sum(len(w) > 25 for w in times) / count),
        rooted(counts[BLANK].sum() / size),
        rooted(text.count(". ") / count),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (text and any other columns) with ``x``, an array of statistics, in place of the text."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = part[[f.name for f in rest]].copy()
            done["x"] = [statistics(t) for t in part["text"]]
            yield done

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["x array<double>"])
    return docs.withColumn("text", text_of()).mapInPandas(of, schema)


def fold_of(column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % FOLDS


class Discriminant:
    """Means, Cholesky factors and prior of the two classes."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        """``sums``: for each class its count, sums and sums of products."""
        size = len(FEATURES)
        self.counts = np.array([sums[k][0] if k in sums else 0.0 for k in (0, 1)])
        self.usable = bool((self.counts > 1).all())
        if not self.usable:
            return
        self.means = [sums[k][1] / sums[k][0] for k in (0, 1)]
        own = [sums[k][2] / sums[k][0] - np.outer(m, m) for k, m in zip((0, 1), self.means, strict=True)]
        pooled = (self.counts[0] * own[0] + self.counts[1] * own[1]) / self.counts.sum()
        pooled += 1e-4 * np.eye(size)
        pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled))
        self.scale = np.sqrt(np.diag(pooled))
        self.factors = [np.linalg.cholesky((1 - TO_POOLED) * c + TO_POOLED * pooled) for c in own]
        self.offsets = [-np.log(np.diag(f)).sum() for f in self.factors]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            share = (self.counts[1] + 0.5) / (self.counts.sum() + 1) if self.counts.sum() else 0.5
            return np.full(len(x), share)
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            apart = np.clip((x - mean) / self.scale, -REACH, REACH) * self.scale
            logs.append(offset - 0.5 * (np.linalg.solve(factor, apart.T) ** 2).sum(axis=0))
        odds = logs[1] - logs[0] + np.log(self.counts[1] / self.counts[0])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame) -> Discriminant:
    """Learns from the labelled documents whose fold isn't 0."""
    marked = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("y")).distinct()
    size = len(FEATURES)
    # Statistics come before the join: only they are shuffled, never texts.
    known = docs.select("doc_id", "text").filter("doc_id is not null").filter(fold_of() != 0)
    rows = with_statistics(known).join(marked, "doc_id")
    sums = [F.sum(F.col("x")[i]) for i in range(size)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(size) for j in range(i, size)]
    found = {}
    for row in rows.groupBy("y").agg(F.count("*"), F.array(*sums), F.array(*products)).collect():
        square = np.zeros((size, size))
        square[np.triu_indices(size)] = row[3]
        found[row[0]] = (float(row[1]), np.array(row[2]), square + np.triu(square, 1).T)
    return Discriminant(found)


def scored(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (text and any other columns) with ``score`` and ``predicted`` in place of the text."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = part[[f.name for f in rest]].copy()
            x = np.array([statistics(t) for t in part["text"]], float).reshape(len(part), len(FEATURES))
            done["_score"] = np.round(model.scores(x), 9)
            yield done

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["_score double"])
    found = docs.withColumn("text", text_of()).mapInPandas(of, schema)
    return found.withColumn("_predicted", (F.col("_score") >= threshold).cast("int"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, all columns as they came."""
    model = fit(docs, labels)
    rows = docs.select(F.struct("*").alias("_doc"), "text")
    return scored(rows, model).filter("_predicted = 1").select("_doc.*")
