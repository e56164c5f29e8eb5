import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from serieslake.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "serieslake-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame: ``frame("a int, b string", (1, "x"), ...)``."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def sf():
    return SF
