"""Landing files to bronze: only unseen files, exactly once, schema learned on the way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.bronze import bronze_rows, discover_schema, parse_seen, read_bronze, seen_long, seen_schema
from ..sources.registry import SchemaRegistry, measured, widen
from ..sources.versions import CODEC

#: Observation of a bronze query.
INGESTED = "bronze"


def start_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    interval: str | None = None,
    max_bytes: int = 1 << 40,
) -> StreamingQuery:
    """Append landing files to bronze; drain and stop, or poll every ``interval``.

    ``max_bytes`` bounds one micro-batch, so a backlog is taken in restartable steps. The schema of
    every batch is measured while it is written, without a second read.
    """
    lines = spark.readStream.option("maxBytesPerTrigger", max_bytes).text(landing)
    rows = bronze_rows(lines, ("value",)).observe(
        INGESTED,
        seen_schema().alias("seen"),
        seen_long("value").alias("long"),
        F.count_if(F.col("event").isNotNull()).alias("events"),
        F.count_if(F.col("event").isNull()).alias("malformed"),
        F.max(F.unix_micros("_ingest_ts")).cast("string").alias("at"),  # no count: the ledger takes whole numbers
    ).drop("value")
    writer = (
        rows.writeStream.format("parquet").outputMode("append").option("compression", CODEC)
        .option("checkpointLocation", checkpoint).option("path", bronze)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def remember(query: StreamingQuery, registry: SchemaRegistry) -> StructType:
    """Merge the schemas a bronze query has reported into the registry."""
    reports = [p.observedMetrics[INGESTED] for p in query.recentProgress if INGESTED in p.observedMetrics]
    seen = (measured(parse_seen(r.seen), parse_seen(r.long)) for r in reports)
    merged = registry.merge(reduce(widen, seen, StructType([])))
    registry.note_measured(int(r.at) for r in reports if r.at is not None)
    return merged


def drain_bronze(spark: SparkSession, registry: SchemaRegistry, query: StreamingQuery, bronze: str) -> None:
    """Wait for a drain-and-stop query and update the registry."""
    query.awaitTermination()
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(query.recentProgress) >= kept:  # older reports are gone: measure the table instead
        registry.merge(discover_schema(read_bronze(spark, bronze)))
    else:
        remember(query, registry)
