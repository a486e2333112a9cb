"""Counts of events by step, table and batch, taken while the steps write and reconciled without a scan.

A step notes what its query observed per micro-batch. A batch that is repeated replaces its own note; a batch
whose note is missing (a driver that died between commit and note, or more batches than the session keeps
reports of) is a gap, and what has a gap is not judged. A task that is repeated may be counted twice.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.versions import PREFIX, ensure_folder

_NOTE = "step string, table_name string, batch long, measure string, n long"
_VERSION = PREFIX.rstrip("=")

Note = tuple[str, str, int, str, int]


def notes(query: StreamingQuery, step: str, table: str, metrics: Iterable[str]) -> list[Note]:
    """What the named observations of a drained query counted, batch by batch; whole numbers only."""
    return [
        (step, table, p.batchId, measure, n)
        for p in query.recentProgress
        for name in metrics if name in p.observedMetrics
        for measure, n in p.observedMetrics[name].asDict().items() if isinstance(n, int)
    ]


def keep(spark: SparkSession, path: str, found: Sequence[Note]) -> None:
    """Append notes to the ledger at ``path``."""
    if found:
        rows = spark.createDataFrame(list(found), _NOTE).coalesce(1)
        rows.write.parquet(f"{path}/{PREFIX}{time.time_ns()}")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``(step, table_name, batch, measure, n)``: the newest note of each batch; empty before the first."""
    ensure_folder(spark, path)
    rows = spark.read.schema(f"{_NOTE}, {_VERSION} long").parquet(path)
    newest = F.row_number().over(Window.partitionBy("step", "table_name", "batch", "measure").orderBy(F.desc(_VERSION)))
    return rows.withColumn("_rank", newest).where("_rank = 1").drop("_rank", _VERSION)


def totals(rows: DataFrame) -> DataFrame:
    """``(step, table_name, measure, n, gaps)``: sums over batches, and how many batches have no note."""
    return rows.groupBy("step", "table_name", "measure").agg(
        F.sum("n").alias("n"), (F.max("batch") + 1 - F.count(F.lit(1))).alias("gaps"))


def reconcile(counted: DataFrame) -> DataFrame:
    """One row per table of ``totals`` columns: what came, what became of it, and whether it adds up.

    ``landed`` lines are ``parsed`` or ``malformed``; parsed events are ``deletes`` or ``checked``; checked events
    are ``rejected``, ``valid`` facts or ``duplicates`` of them (NULL for folded tables, which keep the last
    event and no first). ``status`` is OK, MISMATCH, or UNKNOWN where a batch has no note. A table nothing
    reads on (dead letters, unknown topics) has only landed lines.
    """
    measures = ("landed", "parsed", "malformed", "deletes", "checked", "rejected", "valid")
    wide = counted.groupBy("table_name").pivot("measure", list(measures)).agg(F.sum("n"))
    gaps = counted.groupBy("table_name").agg(F.sum("gaps").alias("gaps"))
    rows = wide.join(gaps, "table_name").withColumn(
        "duplicates", F.col("checked") - F.col("rejected") - F.col("valid"))
    read_on = F.col("parsed").isNotNull() | F.col("checked").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    adds_up = (
        (zero("landed") == zero("parsed") + zero("malformed")) & (zero("parsed") == zero("deletes") + zero("checked"))
        & (zero("rejected") <= zero("checked")) & (zero("duplicates") >= 0))
    status = F.when(F.col("gaps") > 0, "UNKNOWN").when(~read_on | adds_up, "OK").otherwise("MISMATCH")
    return rows.select("table_name", *measures, "duplicates", "gaps", status.alias("status"))
