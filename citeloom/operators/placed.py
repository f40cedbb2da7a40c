"""Edges laid out once for many rounds of messages along them."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import Rounds, written_bytes
from . import skew

#: Written bytes that one partition of a kept layout should hold.
PART_BYTES = 64 << 20


def parts_for(df: DataFrame) -> int:
    """How many partitions a written table is laid out in, by its measured size."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-written_bytes(df) // PART_BYTES))


def place(df: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Keep ``df`` partitioned and sorted by ``columns``.

    Filling the cache at once makes its layout known to the planner, so later
    joins on these columns neither shuffle nor sort this side. Lost cache
    blocks are recomputed from the lineage.
    """
    kept = df.repartition(parts, *columns).sortWithinPartitions(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


class WrittenEdges:
    """Edges in the shared folder, ready to carry vertex values to their targets.

    Values come by join on the source; hot sources are split over several tasks, and nothing passes through the driver.
    ``hot`` lists them as ``(src, fan)``, None if there are none.
    """

    def __init__(self, edges: DataFrame, keys: list[str], rounds: Rounds, hot_floor: int = skew.HOT_FLOOR) -> None:
        self.written = rounds.cut(edges)
        self._edges = self.written
        self._on = [*keys, "src"]
        self.hot = None
        hot = rounds.cut(skew.hot_keys(self.written, "src", hot_floor))
        if not hot.isEmpty():
            self.hot = hot
            self._edges = skew.salt_rows(self.written, hot, "src", F.col("dst"))
            self._on.append("salt")

    def send(self, values: DataFrame) -> DataFrame:
        """Each edge with the values of its source vertex ``id``."""
        values = values.withColumnRenamed("id", "src")
        if self.hot is not None:
            values = skew.salt_copies(values, self.hot, "src")
        return self._edges.join(values, self._on)


class PlacedEdges(WrittenEdges):
    """Edges that carry vertex values again and again.

    They are written to the shared folder first, so the repair of a lost
    cache block does not compute them again, and their measured size gives the
    number of partitions. They are partitioned and sorted by source and kept:
    the edges stay in place and in order, only the values move.
    """

    def __init__(self, edges: DataFrame, keys: list[str], rounds: Rounds, hot_floor: int = skew.HOT_FLOOR) -> None:
        super().__init__(edges, keys, rounds, hot_floor)
        self.parts = parts_for(self.written)
        self._edges = place(self._edges, self._on, self.parts)

    def release(self) -> None:
        self._edges.unpersist()
