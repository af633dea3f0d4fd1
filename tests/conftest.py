from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from suite.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("8")
    yield spark
    spark.stop()


@pytest.fixture
def column(spark):
    """Evaluate an expression over a list of values of one column ``c``."""

    def evaluate(values, expression, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r[1] for r in rows.select("i", expression.alias("r")).orderBy("i").collect()]

    return evaluate
