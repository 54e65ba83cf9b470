import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rows import ITEMS, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from cratewise.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Documents with extra columns whose names clash with results, labels, and an empty table."""
    top = tmp_path_factory.mktemp("tables")
    kind = "doc_id long, text string, source string, lang string, n_chars long, keep_id long, size long, score double, _file long"
    rows = [(i, t, s, "en", len(t or ""), 7, 8, 0.5, 9) for i, t, s in ROWS]
    for name, some in (("full", rows), ("empty", [])):
        spark.createDataFrame(some, kind).repartition(3).write.parquet(str(top / name / "documents.parquet"))
        labels = [(i, i % 2, 0) for i, _, _ in ROWS if i is not None] if some else []
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(top / name / "labels.parquet"))
        items = spark.createDataFrame(ITEMS if some else [], "item_id long, text string")
        items.write.parquet(str(top / name / "benchmark.parquet"))
    return top
