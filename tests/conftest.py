import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bourseline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", "4")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def column(spark):
    """Evaluate a one-column expression over a list of values."""

    def run(build, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r["x"] for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]

    return run
