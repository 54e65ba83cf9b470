"""Fingerprints and likeness against a plain version, and a group of copies that holds a third of the rows."""

import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
import xxhash

from cratewise.llm import imatch

TABLE = "/root/testdata/sf0.01/documents.parquet"
SUBSETS, PART = len(imatch.DENSITIES), imatch.PART


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def term(word):
    return signed(xxhash.xxh64_intdigest(word.encode(), 42))


def words(text):
    return {w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w}


def chained(values):
    """A hash of several longs, each with the one before as its seed."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed)
    return seed


def subset(t):
    """The subset into whose share of all hashes a term falls."""
    at, edge = ((t % 2**64) >> 11) / 2**53, 0.0
    for number, share in enumerate(imatch.DENSITIES):
        edge += share
        if at < edge:
            return number
    return None


def plain(texts, lexicon, cache):
    out = []
    for text in texts:
        own = sorted(term(w) for w in words(text))
        of_own = {t: cache.setdefault(t, subset(t)) for t in own}
        some = [t for t in own if of_own[t] is not None]
        some = [t for t in some if t in lexicon] or some
        parts = [[t for t in some if of_own[t] == n] for n in range(SUBSETS)]
        told = "".join(f"{max(1, chained(p) % 16**PART):0{PART}x}" if p else "0" * PART for p in parts)
        out.append(told if some else f"-{chained(own):016x}")
    return out


def alike(a, b):
    if a == b or a[0] == "-" or b[0] == "-":
        return float(a == b)
    parts = [(a[i : i + PART], b[i : i + PART]) for i in range(0, len(a), PART)]
    some = [(x, y) for x, y in parts if {x, y} != {"0" * PART}]
    return sum(x == y for x, y in some) / len(some) if some else 0.0


def of_table(hot):
    table = pq.read_table(TABLE, columns=["doc_id", "text"]).to_pydict()
    rows = sorted(((i, t or "") for i, t in zip(table["doc_id"], table["text"], strict=True) if t is None or t.isascii()), reverse=True)
    model = next(t for _, t in rows if 150 < len(t.split()) < 400)
    return [(i, model if hot and n % 3 == 0 else t) for n, (i, t) in enumerate(rows)], model


@pytest.mark.parametrize("hot", [False, True])
def test_fingerprints_and_likeness(spark, hot):
    rows, model = of_table(hot)
    texts = [t for _, t in rows]
    following = [*texts[1:], texts[0]]
    edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, following, strict=True)]
    distinct = set(texts)
    counts = Counter(term(w) for t in distinct for w in words(t))
    low, high = (max(2.0, share * len(distinct)) for share in imatch.BAND)
    lexicon, cache = {t for t, n in counts.items() if low <= n <= high}, {}
    own, changed = plain(texts, lexicon, cache), plain(edited, lexicon, cache)
    expected = {
        i: (a, b, pytest.approx(alike(a, b)), pytest.approx(alike(a, own[(n + 1) % len(own)])))
        for n, ((i, _), a, b) in enumerate(zip(rows, own, changed, strict=True))
    }
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = imatch.compared(spark, docs, block_chars=100_000).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in found} == expected
    near = [r["near_edited"] for r in found]
    assert sum(n == 0 for n in near) <= 0.04 * len(near) and sum(near) / len(near) > 0.18
    if hot:
        held = {i for i, t in rows if t == model}
        of_hot = [r["near_edited"] for r in found if r["doc_id"] in held]
        assert min(of_hot) > 0 and sum(of_hot) / len(of_hot) > 0.1
