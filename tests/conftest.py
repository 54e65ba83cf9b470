import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cratewise.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def evaluate(spark):
    """Values of one expression over a list of inputs in a column named ``v``."""

    def run(expression, values, kind="string"):
        rows = [(position, value) for position, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"position int, v {kind}")
        found = df.selectExpr("position", f"{expression} as result").collect()
        return [row["result"] for row in sorted(found, key=lambda row: row["position"])]

    return run
