"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


#: The queries of this file's own operators; those of optional subpackages have their own tests.
OWN = sorted(name[2:] for name in vars(driver) if name.startswith("q_"))


def test_every_query_has_sql():
    assert set(OWN) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    columns, rows = spark_rows(driver.queries()[name](spark, SF_DIR))
    assert (columns, rows) == sql_rows(con, driver.oracle_sql()[name])


def test_entry(spark):
    assert driver.entry(spark).count() == 10


def test_arriving_files_are_bounded(spark, monkeypatch):
    """No file that the streamed queries send grows with the input, and the stream still takes several batches."""
    sent = []
    read = driver.updates.read_paper_stream
    monkeypatch.setattr(driver, "RECORDS_PER_FILE", 100, raising=False)
    monkeypatch.setattr(driver.updates, "read_paper_stream", lambda s, path, max_files=None: sent.append((path, max_files)) or read(s, path, max_files))
    driver.queries()["streaming_new_papers"](spark, SF_DIR)
    (path, max_files), = sent
    sizes = [r["count"] for r in spark.read.json(path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 100 and len(sizes) // max_files >= 4
