"""Interaction audit of document filters by exact constrained least squares.

Five filters may remove a document. A document is reduced to the set of filters
it fails, a row of the table of all 32 coalitions; what a coalition removes is the
number of documents that fail any of its members. From this table alone follow

- the step counts of every order of the filters, as differences of coalitions, and
- each filter's Shapley share, as the weighted least-squares fit of an additive
  game to the coalition removals with the Shapley kernel as weights and the
  whole removal as constraint. The normal equations are solved in rationals.

Only the reduction sees documents; it is one narrow table, two aggregates and a
join on (digest, doc_id), so that copies of one text, however many, are spread by
their ids.

Cases: a null text is empty and a null lang the part ""; equal texts count as
duplicates of the smallest doc_id among them, rows that share that id and rows
without an id are no duplicates; of several labels of a document a 1 wins; rows
that repeat count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import lru_cache
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import BLANKS, saved, text_of

FILTERS = "ABCDE"
#: The filter that looks at other rows; the others look at the text alone.
DUPLICATE = "E"
FEWEST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 3
COUNTS = ("n", "good", "toxic")
STEP_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in STEP_COLUMNS)


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def failing(text: Column) -> Column:
    """Bits of the filters that a text fails by itself."""
    words = F.array_remove(F.split(text, BLANKS), "")
    conditions = {
        "A": F.size(words) < FEWEST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_UPPER * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    found = F.lit(0)
    for name, fails in conditions.items():
        found = found + F.when(fails, bit(name)).otherwise(0)
    return found


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, digest, doc_id, mask, good, toxic) with the number ``n`` of such documents."""
    text = text_of()
    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select("doc_id", part, failing(text).alias("mask"), F.sha2(text, 256).alias("digest"))
    marks = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))]
    marked = labels.filter("doc_id is not null").groupBy("doc_id").agg(*marks)
    # Rows without an id have no label and would meet in one task of the join.
    known = rows.filter("doc_id is not null").join(marked, "doc_id", "left")
    unknown = rows.filter("doc_id is null").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")})
    both = known.unionByName(unknown).na.fill(False, ["good", "toxic"])
    return both.groupBy("part", "digest", "doc_id", "mask", "good", "toxic").agg(F.count("*").alias("n"))


def coalition_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part with ``cells``: (mask, n, good, toxic) of every set of failed filters that occurs."""
    table = saved(cells(docs, labels), "audit-cells")
    first = table.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("low"))
    same = (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("low"))
    spared = table.join(first.withColumnRenamed("digest", "_digest"), same).drop("_digest", "low")
    spared = spared.unionByName(table.filter("doc_id is null"))
    repeated = bit(DUPLICATE)
    # Every row as a duplicate, less those that are none, plus those without the bit.
    every = table.withColumn("mask", F.col("mask") + repeated)
    less = spared.withColumns({"mask": F.col("mask") + repeated, "n": -F.col("n")})
    summed = every.unionByName(less).unionByName(spared).groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    return summed.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))


def removals(by_mask: Sequence[int]) -> list[int]:
    """For each coalition the number of documents that fail any of its members."""
    whole = len(by_mask)
    return [sum(by_mask[m] for m in range(whole) if m & coalition) for coalition in range(whole)]


def kernel_weight(size: int, players: int) -> Fraction:
    """Shapley kernel of a coalition that is neither empty nor whole."""
    return Fraction(players - 1, comb(players, size) * size * (players - size))


def inverse(matrix: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination in rationals."""
    size = len(matrix)
    rows = [[*row, *[Fraction(int(i == j)) for j in range(size)]] for i, row in enumerate(matrix)]
    for k in range(size):
        pivot = next(i for i in range(k, size) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(size):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [row[size:] for row in rows]


@lru_cache
def normal_inverse(players: int) -> list[list[Fraction]]:
    """Inverse of the normal equations, bordered by the constraint that shares sum to the whole."""
    border = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    for coalition in range(1, 2**players - 1):
        members = [i for i in range(players) if coalition >> i & 1]
        for i in members:
            for j in members:
                border[i][j] += kernel_weight(len(members), players)
    for i in range(players):
        border[i][players] = border[players][i] = Fraction(1)
    return inverse(border)


def shapley(values: Sequence[int]) -> list[Fraction]:
    """Shapley values of a game given by the value of every coalition (the empty one's is zero)."""
    players = len(values).bit_length() - 1
    right = [Fraction(0)] * players + [Fraction(values[-1])]
    for coalition in range(1, len(values) - 1):
        weighted = kernel_weight(coalition.bit_count(), players) * values[coalition]
        for i in range(players):
            if coalition >> i & 1:
                right[i] += weighted
    return [sum(a * b for a, b in zip(row, right, strict=True)) for row in normal_inverse(players)[:players]]


def steps(tables: dict[str, Sequence[int]]) -> list[tuple]:
    """(filter_order, step, counts) of every order, from the counts by failed filters."""
    values = {name: removals(by_mask) for name, by_mask in tables.items()}
    gone, whole, orders = values["n"], len(tables["n"]) - 1, factorial(len(FILTERS))
    shares = [share * orders for share in shapley(gone)]
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            own = bit(name)
            after = before | own
            removed = gone[after] - gone[before]
            lost = [values[c][after] - values[c][before] for c in COUNTS[1:]]
            alone = gone[whole] - gone[whole ^ own]
            kept = sum(tables["n"]) - gone[after]
            out.append((order, step, kept, removed, gone[own] - removed, alone, *lost, int(shares[FILTERS.index(name)])))
            before = after
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step (see SCHEMA)."""

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                tables = {c: [0] * (1 << len(FILTERS)) for c in COUNTS}
                for cell in row["cells"]:
                    for c in COUNTS:
                        tables[c][cell["mask"]] += cell[c]
                found = [(row["part"], *step) for step in steps(tables)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    names = ["part", "filter_order", "step", *STEP_COLUMNS]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(STEP_COLUMNS)]
    return coalition_table(docs, labels).mapInArrow(of, SCHEMA)
