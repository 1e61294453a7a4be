import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mdcatalog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate column expressions over one row of literal columns."""
    def run(expression, **values):
        schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
        df = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
        return df.select(expression.alias("x")).first()["x"]
    return run


@pytest.fixture(scope="session")
def raw(spark):
    def make(files: dict, bundle: str = "b"):
        return spark.createDataFrame([(bundle, p, c) for p, c in files.items()], "bundle string, path string, content string")
    return make
