"""Publish a frame as a table of a layer, and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .versions import VersionedDir


def ensure_schema(spark: SparkSession, layer: str) -> None:
    spark.sql(f"create schema if not exists `{layer}`")


def publish(
    df: DataFrame, root: str, layer: str, name: str, comment: str = "", keep: int = 2, view: bool = True
) -> int:
    """Write ``df`` as the next version of ``layer.name`` and point the catalog view (if any) at it.

    Readers keep the old version until the view moves, and a reader without a catalog takes the
    latest committed folder (``current_table``). The ``keep`` newest versions stay. Returns the
    rows written, which Spark counts from the file footers.
    """
    spark = df.sparkSession
    store = VersionedDir(spark, f"{root}/{layer}/{name}")
    version = (store.latest() or 0) + 1
    df.write.mode("overwrite").parquet(store.path(version))
    if view:
        ensure_schema(spark, layer)
        note = comment.replace("'", "\\'")
        spark.sql(
            f"create or replace view `{layer}`.`{name}` comment '{note}' "
            f"as select * from parquet.`{store.path(version)}`")
    for old in store.committed()[:-keep]:
        store.remove(old)
    return spark.read.parquet(store.path(version)).count()


def current_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    store = VersionedDir(spark, f"{root}/{layer}/{name}")
    version = store.latest()
    if version is None:
        raise FileNotFoundError(f"{layer}.{name} was never published below {root}")
    return spark.read.parquet(store.path(version))
