import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from flowlantern.session import STREAM_CONF, build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            **STREAM_CONF,
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan(table) -> str:
    """The physical plan as text."""
    return table._jdf.queryExecution().explainString(
        table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def rows(table, *columns):
    picked = table.select(*columns) if columns else table
    return sorted((tuple(row) for row in picked.collect()), key=repr)
