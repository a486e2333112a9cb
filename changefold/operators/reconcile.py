"""Counts, keys and references checked across tables and layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_counts(layers: Mapping[str, Mapping[str, DataFrame | None]]) -> DataFrame:
    """``(layer, table_name, row_count, status)``; status OK, EMPTY, or MISSING for a None frame."""
    parts = [
        _layer_row(layer, name, df) for layer, tables in layers.items() for name, df in tables.items()
    ]
    rows = F.col("row_count")
    status = F.when(rows.isNull(), "MISSING").when(rows == 0, "EMPTY").otherwise("OK")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def _layer_row(layer: str, name: str, df: DataFrame | None) -> DataFrame:
    if df is None:
        counted = SparkSession.active().range(1).select(F.lit(None).cast("bigint").alias("row_count"))
    else:
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")


def verify_layers(spark: SparkSession, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """``layer_counts`` over catalog tables named ``layer.table``."""
    return layer_counts({
        layer: {
            name: spark.table(f"{layer}.{name}") if spark.catalog.tableExists(f"{layer}.{name}") else None
            for name in names
        }
        for layer, names in expected.items()
    })


def require_ok(report: DataFrame) -> DataFrame:
    """Raise when any table of a layer report (one row per table) is empty or missing."""
    bad = report.where("status <> 'OK'").collect()
    if bad:
        raise RuntimeError("layers failed: " + ", ".join(f"{r.layer}.{r.table_name} {r.status}" for r in bad))
    return report


def count_reconcile(before: DataFrame, after: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Compare two ``table_counts`` frames: delta per table, and whether it reaches ``expected_delta``.

    ``expected`` holds ``(table_name, expected_delta)``; a table it lacks expects no loss.
    """
    joined = (
        before.withColumnRenamed("row_count", "before_rows")
        .join(after.withColumnRenamed("row_count", "after_rows"), "table_name", "full_outer")
        .na.fill(0, ["before_rows", "after_rows"])
        .withColumn("delta", F.col("after_rows") - F.col("before_rows"))
    )
    if expected is None:
        joined = joined.withColumn("expected_delta", F.lit(0).cast("bigint"))
    else:
        joined = joined.join(expected, "table_name", "left").na.fill(0, ["expected_delta"])
    return joined.withColumn("ok", F.col("delta") >= F.col("expected_delta"))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL or not unique, with their row count."""
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where((F.col("row_count") > 1) | missing)


def foreign_key_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their row count; a NULL key refers to nothing.

    The child is counted per key before it meets the parent, so a hot key is one row in the join.
    """
    used = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
