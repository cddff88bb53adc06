from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from parcela.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "tests", "local[8]", **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def values(spark):
    """Evaluate one column expression over a list of values."""
    from pyspark.sql import functions as F

    def run(expression, items, dtype="string"):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {dtype}")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]

    return run
