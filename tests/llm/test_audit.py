"""The filter audit against filters that are run in every order, and its shares against their definition."""

from fractions import Fraction
from itertools import permutations

import brute
import duckdb
import numpy as np
import pytest
from rows import ROWS

from cratewise.llm import audit
from cratewise.llm.queries import QUERIES
from cratewise.llm.sql import SQL


def same(found, expected):
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, expected)))


def test_odd_rows(spark, folder):
    found = QUERIES["op12_filter_audit"](spark, str(folder / "full")).collect()
    good = {i for i, _, _ in ROWS if i is not None and i % 2}
    same(found, brute.audit([(i, t, "en") for i, t, _ in ROWS], good, set()))


def test_parts_labels_and_hot_copies(spark, tmp_path):
    rng = np.random.default_rng(2)
    words = [f"Word{n}" for n in range(300)] + ["#", "a", "b"]
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 500)))) for _ in range(60)] + ["", None, "a " * 400]
    rows = [(int(i), texts[int(rng.integers(0, len(texts)))], [None, "", "de", "en"][int(i) % 4]) for i in rng.permutation(200)]
    rows += [(300 + i, texts[0], "de") for i in range(100)] + [(None, texts[0], "en"), (rows[0][0], rows[0][1], rows[0][2])]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 400, 3)] + [(3, 0, 1), (None, 1, 1), (6, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    same(found, brute.audit([(i, t, p or "") for i, t, p in rows], good, toxic))


@pytest.mark.parametrize("players", [2, 3, 5])
def test_least_squares_give_shapley_shares(players):
    rng = np.random.default_rng(players)
    values = [0, *rng.integers(-50, 50, 2**players - 1).tolist()]
    orders = list(permutations(range(players)))
    for i, share in enumerate(audit.shapley(values)):
        gains = [values[sum(1 << p for p in o[: o.index(i) + 1])] - values[sum(1 << p for p in o[: o.index(i)])] for o in orders]
        assert share == Fraction(sum(gains), len(orders))


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    for name in ("op11_search", "op12_filter_audit"):
        found = QUERIES[name](spark, folder)
        same(found.collect(), db.execute(f"SELECT {', '.join(found.columns)} FROM ({SQL[name]})").fetchall())
