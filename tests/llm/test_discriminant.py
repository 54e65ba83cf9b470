"""The quality scores of a whole table against a plain version, and the held-out fold against its labels."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from cratewise.llm import quality, queries

TABLES = "/root/testdata/sf0.01"


def plain_statistics(text):
    """The statistics of one text, character by character."""
    if not text:
        return [0.0] * 14
    data = text.encode()
    size, words, lines = len(data), text.split(), [line for line in text.split("\n") if line != ""]
    n = max(1, len(words))
    count = lambda of: sum(1 for b in data if of(b))
    letters = max(1, count(lambda b: chr(b).isalpha() and b < 128 or b >= 128))
    repeats = sum(1 for i in range(1, len(words)) if words[i] == words[i - 1])
    times = Counter(words)
    shares = {
        "upper": count(lambda b: b < 128 and chr(b).isupper()) / letters,
        "digits": count(lambda b: b < 128 and chr(b).isdigit()) / size,
        "marks": count(lambda b: chr(b) in ".,;:?'\"()-") / n,
        "symbols": count(lambda b: chr(b) in "#$%&*+<=>@[]^_`{}~/\\") / n,
        "bars": text.count("|") / n,
        "exclaims": text.count("!") / n,
        "twins": repeats / n,
        "top_word": max(times.values(), default=0) / (n + 10),
        "distinct_lines": len(set(lines)) / max(1, len(lines)),
        "long_words": sum(1 for w in set(words) if len(w) > 25) / n,
        "blanks": count(lambda b: b in (9, 10, 11, 12, 13, 32)) / size,
        "stops": text.count(". ") / n,
    }
    out = {name: math.sqrt(share) for name, share in shares.items()}
    out["distinct_words"] = math.log(1 + len(times)) / math.log(1 + n)
    out["word_length"] = math.log(1 + letters / n)
    return [out[name] for name in quality.FEATURES]


@pytest.fixture(scope="module")
def rows():
    docs = pq.read_table(f"{TABLES}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{TABLES}/labels.parquet").to_pylist()}
    return [(r["doc_id"], plain_statistics(r["text"]), labels.get(r["doc_id"]), zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in docs]


def plain_scores(rows):
    """Log-densities from inverses and determinants of the two covariances."""
    of = [np.array([x for _, x, label, held in rows if label == k and not held]) for k in (0, 1)]
    own = [np.cov(x.T, bias=True) for x in of]
    total = len(of[0]) + len(of[1])
    pooled = sum(len(x) / total * c for x, c in zip(of, own, strict=True)) + 1e-4 * np.eye(14)
    pooled = 0.9 * pooled + 0.1 * np.diag(pooled.diagonal())
    density = []
    for x, c in zip(of, own, strict=True):
        shrunk = 0.7 * c + 0.3 * pooled
        reach = 6 * np.sqrt(pooled.diagonal())
        apart = np.clip(np.array([r[1] for r in rows]) - x.mean(axis=0), -reach, reach)
        distance = np.einsum("ij,jk,ik->i", apart, np.linalg.inv(shrunk), apart)
        density.append(math.log(len(x) / total) - 0.5 * (np.linalg.slogdet(shrunk)[1] + distance))
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def test_scores_equal_a_plain_version(spark, rows):
    found = {r["doc_id"]: r for r in queries.QUERIES["op7_quality"](spark, TABLES).collect()}
    expected = plain_scores(rows)
    assert len(found) == len(rows)
    for (doc_id, _, _, held), score in zip(rows, expected, strict=True):
        assert found[doc_id]["held_out"] == held
        assert found[doc_id]["score"] == pytest.approx(score, abs=1e-6)
        assert found[doc_id]["predicted"] == int(found[doc_id]["score"] >= 0.3)


def test_held_out_labels_are_told_apart(rows):
    scores = plain_scores(rows)
    good, bad = ([s for s, (_, _, label, held) in zip(scores, rows, strict=True) if held and label == k] for k in (1, 0))
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(good) > 10 and len(bad) > 5 and above > 0.9
