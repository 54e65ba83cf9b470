"""Ranked lexical search against every pair of item and document."""

import brute
import numpy as np
import pytest
from rows import ITEMS, ROWS

from cratewise.llm import search
from cratewise.llm.queries import QUERIES

COLUMNS = ("item_id", "rank", "doc_id", "score")


def same(found, expected):
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, expected)))


def test_odd_rows(spark, folder):
    found = QUERIES["op11_search"](spark, str(folder / "full")).select(*COLUMNS).collect()
    same(found, brute.search([(i, t) for i, t, _ in ROWS], ITEMS))


def invented(seed, docs, items):
    """Texts of few words, so that ties and repeated terms abound; some copies, some very long, some without a term."""
    rng = np.random.default_rng(seed)
    words = [f"w{n}" for n in range(60)]
    draw = lambda n: " ".join(rng.choice(words, n, p=np.arange(1, 61) / 1830))
    texts = [draw(int(rng.integers(0, 40))) for _ in range(docs)]
    texts += texts[: docs // 3] + [draw(5000), "", None, "?!"]
    return list(enumerate(texts)), [(i, draw(int(rng.integers(0, 12)))) for i in range(items)]


@pytest.mark.parametrize("k", [1, 10])
def test_trees_lose_no_pair(spark, tmp_path, monkeypatch, k):
    rows, items = invented(1, 900, 70)
    monkeypatch.setattr(search, "TREE_DOCS", 100)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    found = search.ranked(spark, docs, spark.createDataFrame(items, "item_id long, text string"), k)
    same(found.select(*COLUMNS).collect(), brute.search(rows, items, k))


def test_blocks_of_items(spark, tmp_path, monkeypatch):
    rows, items = invented(2, 60, 25)
    monkeypatch.setattr(search, "ITEMS_AT_ONCE", 7)
    monkeypatch.setattr(search, "TERMS_AT_ONCE", 20)
    asked = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(search.blocks_of(asked))
    assert len(blocks) > 3 and all(len(b) <= 7 for b in blocks)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(search.ranked(spark, docs, asked).select(*COLUMNS).collect(), brute.search(rows, items))


def test_bounds_spare_pairs():
    """With starting scores most pairs of a clustered table are never scored."""
    rng = np.random.default_rng(4)
    weight = np.full(400, 1000, np.int64)
    vectors = [{int(t): 1 for t in range(10 * i, 10 * i + 10)} for i in range(40)]
    rows = [(d, 0, d, np.sort(rng.choice(10, 6, replace=False)) + 10 * (d % 40), np.ones(6, np.int64)) for d in range(2000)]
    items = search.Items(vectors, weight, np.full(40, 6, np.int64))
    at = search.Search(items, weight, 2000, 12_000, 5)
    at.add(rows)
    assert at.scored <= 2000
    hits = at.hits().to_pydict()
    assert len(hits["item"]) == 200 and set(hits["score"]) == {6}
    assert sorted(zip(hits["item"], hits["doc_id"], strict=True)) == [(i, i + 40 * n) for i in range(40) for n in range(5)]
