"""SimHash near-duplicates through multi-index hashing.

A 64-bit fingerprint is cut into segments, each the key of one table. Two
fingerprints within ``distance`` bits agree, up to ``distance // segments`` bits,
in some segment, so a small Hamming ball around each segment's value finds every
partner; whole distances are then checked. Equal fingerprints are one entry of
the tables, however many documents share it.

Cases: a null or empty text has fingerprint zero and links like any other; a text
shorter than a shingle is one shingle; a null doc_id counts in its component,
whose id is the smallest id that isn't null (null if there is none); rows that
repeat are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.common import WORD, chosen_rows, file_backed, located, saved, text_of
from cratewise.llm.components import stars

BITS = 64
UPPER_TO_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """Signed 64-bit fingerprint: a bit is set if over half the shingles' hashes have it."""
    found = re.findall(WORD, text.translate(UPPER_TO_LOWER))
    count = max(1, len(found) - words + 1) if found else 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, SHINGLES_AT_ONCE):
        stop = min(count, start + SHINGLES_AT_ONCE)
        digests = b"".join([xxhash.xxh64_digest(" ".join(found[i : i + words]), seed) for i in range(start, stop)])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` (text and any other columns) with ``fp`` in place of the text."""
    rest = [c for c in docs.columns if c != "text"]

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = part[rest].copy()
            done["fp"] = np.array([fingerprint(t, words, seed) for t in part["text"]], np.int64)
            yield done

    kinds = [f for f in docs.schema.fields if f.name in rest]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kinds] + ["fp long"])
    return docs.withColumn("text", text_of()).mapInPandas(of, schema)


def cuts(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits."""
    masks, layer = {0}, {0}
    for _ in range(radius):
        layer = {m ^ (1 << b) for m in layer for b in range(width)}
        masks |= layer
    return sorted(masks)


def links(distinct: DataFrame, distance: int = 4, segments: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most ``distance`` bits.

    The first ``distance % segments + 1`` segments are searched with the full
    radius, the others with one less: no pair within the distance escapes.
    """
    radius, wide = distance // segments, distance % segments + 1
    index, probes = [], []
    for number, (low, width) in enumerate(cuts(segments)):
        value = f"shiftrightunsigned(fp, {low}) & {(1 << width) - 1}L"
        reach = radius if number < wide else radius - 1
        index.append(f"struct({number} as segment, {value} as value)")
        if reach >= 0:
            masks = ", ".join(f"{m}L" for m in ball(width, reach))
            probes.append(f"transform(array({masks}), m -> struct({number} as segment, ({value}) ^ m as value))")
    entries = distinct.selectExpr("fp as b", f"inline(array({', '.join(index)}))")
    asked = distinct.selectExpr("fp as a", f"inline(concat({', '.join(probes)}))")
    near = F.expr(f"a < b and bit_count(a ^ b) <= {distance}")
    # Each side of a pair asks, so the smaller may be left to do it.
    return asked.join(entries, ["segment", "value"]).filter(near).select("a", "b").distinct()


def simhash_groups(docs: DataFrame, distance: int = 4, segments: int = 3) -> DataFrame:
    """``docs`` without its text, with ``fp``, ``root`` (its component's smallest fingerprint) and ``component_id``."""
    marked = saved(fingerprints(docs), "simhash")
    entries = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-entries")
    linked = stars(links(entries.select("fp"), distance, segments))
    rooted = entries.join(linked, F.col("fp") == F.col("node"), "left")
    rooted = saved(rooted.select("fp", F.coalesce("root", "fp").alias("root"), "low"), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return marked.join(rooted.select("fp", "root"), "fp").join(least, "root")


def hex_of(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; all columns as they came.

    Documents without an id come after those that have one.
    """
    docs = file_backed(docs)
    groups = simhash_groups(located(docs.select("doc_id", "text")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_file", "_row")
    first = groups.groupBy("root").agg(F.min(order).alias("first"))
    return chosen_rows(docs, first.select("first._file", "first._row"))
