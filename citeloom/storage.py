"""Shared-folder storage: lineage cuts and scratch tables that are removed again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    that names none gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="citeloom-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def n_files(spark: SparkSession, path: str) -> int:
    """How many data files a written folder holds; names that begin with ``_`` or ``.`` don't count."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sum(not f.getPath().getName().startswith(("_", ".")) for f in found)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what is written inside go with the write; else they stay until the driver collects its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def sorted_groups(spark: SparkSession) -> AbstractContextManager[None]:
    """Aggregates of what is written inside use the order their rows come in, where it is that of the groups."""
    return _setting(spark, "spark.sql.execution.replaceHashWithSortAgg", "true")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the written copy.

    Later readers get only the columns they select. :func:`release` removes
    the copy when nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    with shuffles_removed(spark):
        df.write.parquet(path, compression="zstd")
    written = spark.read.parquet(path)
    written.scratch = path
    return written


def release(df: DataFrame) -> None:
    """Remove the stored copy behind a frame that :func:`cut_lineage` has returned."""
    path = df.__dict__.pop("scratch", None)
    if path is not None:
        delete(df.sparkSession, path)


def written_bytes(df: DataFrame) -> int:
    """The size of a written copy in its folder."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df.__dict__["scratch"])
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


#: Rows that one task of a shuffle sorts or groups, about, and bytes up to which Spark merges tasks again.
ROWS_PER_TASK, BYTES_PER_TASK = 500_000, 16 << 20
_PARTITIONS, _MERGED = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def shuffled_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, shuffles have the session's number of partitions, or more where ``rows`` ask for it, so that a task's memory is bounded.

    Holds for what is written inside.
    """
    before = {name: spark.conf.get(name) for name in (_PARTITIONS, _MERGED)}
    spark.conf.set(_PARTITIONS, str(max(int(before[_PARTITIONS]), -(-rows // ROWS_PER_TASK))))
    spark.conf.set(_MERGED, str(BYTES_PER_TASK))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Rounds:
    """Written intermediate tables of an iteration; all are removed at the end, or before by :func:`release`.

    The result has to be written by :func:`cut_lineage` inside the block.
    """

    def __init__(self) -> None:
        self._held: list[DataFrame] = []

    def __enter__(self) -> Rounds:
        return self

    def __exit__(self, *error) -> None:
        for df in self._held:
            release(df)

    def cut(self, df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
        """Write ``df``; ``instead_of`` is an earlier round that only ``df`` has read."""
        written = cut_lineage(df)
        if instead_of is not None:
            release(instead_of)
        self._held.append(written)
        return written
