"""References checked as batches come: keys that children use and no parent has, in any order of arrival.

Children and parents come as signed rows (1 for one that came, -1 for one that went), as the current-state
tables and the fact log give them. Per key the difference of both is kept: how many children use it and how
many parents have it. A child that comes before its parent waits as an orphan and is resolved by the
parent's batch; a parent that goes makes orphans of its children again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.versions import VersionedDir

SIGN = "_sign"


class References:
    """The reference of a child column to a parent's key, kept in numbered tables below ``path``.

    One row per key that any child uses or any parent has; a batch reads that table and writes the next, and
    meets neither children nor parents of earlier batches. Batches are numbered from 1; one that is
    applied already changes nothing, one that died is applied anew.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, keep: int = 2):
        self.spark, self.key, self.keep = spark, key, keep
        self._store = VersionedDir(spark, path)

    def version(self) -> int:
        """Number of the last batch applied, 0 before the first."""
        return self._store.latest() or 0

    def apply(self, batch: int, children: DataFrame | None = None, parents: DataFrame | None = None,
              foreign: str | None = None, primary: str | None = None) -> None:
        """Add signed rows: the children's column ``foreign``, the parents' ``primary``; without a sign they came.

        Rows are counted per key before they meet the state, so a hot key is one row a task. NULL refers to
        nothing and is no key.
        """
        at = self.version()
        if batch <= at:
            return
        parts = [self._counted(children, foreign or self.key, "children"), self._counted(parents, primary or self.key, "parents")]
        if at:
            parts.append(self.spark.read.parquet(self._store.path(at)))
        parts = [p for p in parts if p is not None]
        if not parts:
            raise ValueError("a first batch without children and parents has no type of key")
        state = parts[0]
        for part in parts[1:]:
            state = state.unionByName(part)
        state = state.groupBy("key").agg(F.sum("children").alias("children"), F.sum("parents").alias("parents"))
        state.where((F.col("children") != 0) | (F.col("parents") != 0)).write.mode("overwrite").parquet(self._store.path(batch))
        for old in self._store.committed()[:-self.keep]:
            self._store.remove(old)

    @staticmethod
    def _counted(rows: DataFrame | None, column: str, side: str) -> DataFrame | None:
        if rows is None:
            return None
        sign: Column = F.col(SIGN).cast("long") if SIGN in rows.columns else F.lit(1).cast("long")
        none = F.lit(0).cast("long")
        return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.sum(sign).alias("n")).select(
            "key", (F.col("n") if side == "children" else none).alias("children"),
            (F.col("n") if side == "parents" else none).alias("parents"))

    def orphans(self) -> DataFrame:
        """``(key column, row_count)`` of the keys that children use and no parent has."""
        at = self.version()
        if not at:
            raise ValueError("no batch was applied yet")
        waiting = self.spark.read.parquet(self._store.path(at)).where("children > 0 and parents <= 0")
        return waiting.select(F.col("key").alias(self.key), F.col("children").alias("row_count"))
