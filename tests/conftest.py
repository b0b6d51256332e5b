from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from temblor.config import build_session, shared_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new folder on shared storage."""
    return shared_dir(spark, "test")


@pytest.fixture
def quakes(spark):
    """Builds a cleaned table from keyword rows; what is not given is NULL."""
    schema = (
        "time BIGINT, place STRING, status STRING, tsunami FLOAT, significance INT, "
        "magnitude FLOAT, state STRING, longitude FLOAT, latitude FLOAT, depth FLOAT, "
        "date STRING"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def build(*rows: dict):
        values = [tuple(row.get(name) for name in names) for row in rows]
        df = spark.createDataFrame(values, schema)
        return df.withColumn("date", df["date"].cast("timestamp"))

    return build


def rows(df) -> list[tuple]:
    """Rows in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan_text(df, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
