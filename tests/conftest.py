from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("citeloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def vertices(spark):
    def build(vectors: dict[str, list[float] | None]):
        rows = [(i, f"title {i}", "v", 2000, v) for i, v in vectors.items()]
        return spark.createDataFrame(rows, "id string, title string, venue string, year int, vector array<double>")

    return build


@pytest.fixture
def citations(spark):
    def build(pairs: list[tuple[str, str]]):
        return spark.createDataFrame(pairs, "src string, dst string")

    return build
