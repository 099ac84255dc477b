import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillmark.session import build_session, shared_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[4]",
        conf={"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
              "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from a schema text and rows."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


@pytest.fixture
def base(spark):
    from tillmark.session import new_dir

    return new_dir(spark, "test")
