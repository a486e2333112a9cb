"""Append-only fact feed: deletes ignored, the first event of each fact, rules, quarantine.

The first event is the first by time, partition and offset, whatever the order of arrival. Streaming aggregation
keeps it per fact, copies meet on the map side first, so a fact with a third of the feed costs one row per
task. A batch appends what became first in it; where that replaces an earlier pick, the row is marked, and
readers take the newest pick of such a fact. Nothing that was written is ever rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType, TimestampType

from ..operators.fold import live, orderable
from ..operators.rules import RuleSet, all_failures
from ..schemas import EVENT_ID, METADATA_COLUMNS
from ..sources.versions import CODEC, PREFIX, VersionedDir, ensure_folder

#: Which event of a fact is its first.
FIRST = ("__ts_ms", *EVENT_ID)
#: Observations of a split: events that came, those checked and rejected, and facts that are new.
TAKEN, QUALITY, FOUND = "taken", "quality", "found"
_VERSION = PREFIX.rstrip("=")
#: What the log holds beside the fact's own columns.
_LOG = (StructField("_fact", StringType()), StructField(_VERSION, IntegerType()),
        StructField("_valid", BooleanType()), StructField("_again", BooleanType()))


def _start(rows: DataFrame, path: str, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def _identified(events: DataFrame) -> DataFrame:
    """Events of a feed without topic partitions are those of partition 0."""
    if EVENT_ID[0] in events.columns:
        return events
    return events.withColumn(EVENT_ID[0], F.lit(0))


def _firsts(rows: DataFrame, fact: Column) -> DataFrame:
    """What became the first event of its fact in this batch, with ``_fact`` and ``_again`` (it replaces one).

    Events of one time, partition and offset rank by their other columns in name order, bookkeeping last.
    All facts ever seen are state, one row each, so it should live on disk (``session.prepare``). Nothing bounds it by
    time: Spark drops rows behind a watermark before any operator sees them.
    """
    sequence = [c for c in FIRST if c in rows.columns]
    rest = sorted((c for c in rows.columns if c not in sequence), key=lambda c: (c in METADATA_COLUMNS, c))
    beside = [f.name for f in rows.schema.fields if not orderable(f.dataType)]
    order = F.struct(*sequence, *(c for c in rest if c not in beside))
    batch = F.current_timestamp()  # one value per micro-batch, the same when it is repeated
    tagged = rows.withColumn("_fact", fact).withColumn("_batch", batch)
    # the aggregate sorts: a hash tells two facts apart at once, their text begins alike
    kept = tagged.groupBy("_fact").agg(
        F.min(F.struct(order.alias("row"), F.col("_batch").alias("batch"))).alias("first"),
        *(F.min_by(c, order).alias(c) for c in beside),
        F.min("_batch").alias("_from"), F.max("_batch").alias("_to"))
    new = kept.where(F.col("first.batch") == batch)
    again = (F.col("_from") != batch) | (F.col("_to") != batch)
    return new.select("_fact", again.alias("_again"), *(
        F.col(c) if c in beside else F.col(f"first.row.{c}").alias(c) for c in rows.columns))


def _log(rows: DataFrame, path: str, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Append each batch's first events as one version of the log; a repeated batch overwrites its own."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        store = VersionedDir(batch.sparkSession, path)
        batch.write.mode("overwrite").option("compression", CODEC).partitionBy("_valid", "_again").parquet(store.path(batch_id))

    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def _key(columns: Sequence[str | Column]) -> Column:
    return F.to_json(F.struct(*columns))


def start_valid(
    events: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    rules: RuleSet,
    path: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Valid facts: non-deletes, the first event per key, then the rules. ``split_outputs`` reads them."""
    rows = _identified(live(events))
    firsts = _firsts(rows, _key(keys))
    firsts = firsts.withColumn("_failed_rules", all_failures(firsts, rules))
    firsts = firsts.withColumn("_valid", F.size("_failed_rules") == 0)
    return _log(firsts.select(*columns, "_failed_rules", "_fact", "_valid", "_again"), path, checkpoint, interval)


def start_quarantine(
    events: DataFrame,
    rules: RuleSet,
    path: str,
    checkpoint: str,
    mode: str = "complete",
    interval: str | None = None,
) -> StreamingQuery:
    """Every failing non-delete, copies included; ``reference`` mode also looks at deletes."""
    if mode == "complete" and "_misfits" in events.columns:
        checked = live(events)
        rows = checked.withColumn("_failed_rules", all_failures(checked, rules)).where(F.size("_failed_rules") > 0)
        rows = rows.withColumn("_quarantine_reason", F.col("_failed_rules")[0]).withColumn(
            "_quarantined_at", F.current_timestamp()).drop("_misfits")
    else:
        rows = rules.quarantine(live(events) if mode == "complete" else events, mode)
    return _start(rows, path, checkpoint, interval)


def start_split(
    events: DataFrame,
    keys: Sequence[str],
    rules: RuleSet,
    path: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Both outputs from one read of the feed; ``split_outputs`` reads them.

    Rules come before the choice here: a bad first copy does not hide a good second one. An event without its
    key fails (``missing_key``), as no copy of it could be told. Every failing event is kept, told from the
    others by ``EVENT_ID``; where that is NULL, by all its columns and a number drawn for it.
    """
    taken = _identified(events).observe(TAKEN, F.count(F.lit(1)).alias("taken"))
    checked = live(taken)
    keyless = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    failed = F.concat(F.when(keyless, F.array(F.lit("missing_key"))).otherwise(F.array().cast("array<string>")),
                      all_failures(checked, rules))
    checked = checked.withColumn("_failed_rules", failed).drop("_misfits")
    checked = checked.withColumn("_valid", F.size("_failed_rules") == 0)
    known = F.col(EVENT_ID[0]).isNotNull() & F.col(EVENT_ID[1]).isNotNull()
    event = F.when(known, F.concat_ws(":", *(F.col(c).cast("string") for c in EVENT_ID))).otherwise(F.expr("uuid()"))
    checked = checked.observe(
        QUALITY, F.count(F.lit(1)).alias("checked"), F.count_if(~F.col("_valid")).alias("rejected"))
    # a valid fact is told by its keys, a failing event by itself
    fact = F.when(F.col("_valid"), _key(list(keys))).otherwise(event)
    rows = _firsts(checked, fact).observe(FOUND, F.count_if(F.col("_valid") & ~F.col("_again")).alias("valid"))
    return _log(rows.withColumn("_quarantined_at", F.when(~F.col("_valid"), F.current_timestamp())), path, checkpoint, interval)


def _read_log(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """The committed versions of the log; empty before the first when a ``schema`` is given."""
    if schema is not None:
        ensure_folder(spark, path)
        schema = StructType([*schema.fields, StructField("_failed_rules", ArrayType(StringType())),
                             StructField("_quarantined_at", TimestampType()), *_LOG])
    latest = VersionedDir(spark, path).latest()
    rows = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    return rows.where(F.col(_VERSION) <= (-1 if latest is None else latest)).withColumns(
        {c: F.col(c).cast("boolean") for c in ("_valid", "_again")})


def _newest(rows: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("_fact").orderBy(F.desc(_VERSION)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _standing(log: DataFrame) -> DataFrame:
    """One row per fact: its newest pick. Only facts that were picked again are joined."""
    again = _newest(log.where("_again"))
    once = log.where("not _again").join(again.select("_fact"), "_fact", "left_anti")
    return once.unionByName(again)


def split_outputs(spark: SparkSession, path: str, schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """What ``start_split`` or ``start_valid`` wrote so far: valid facts, and the rejected with their reason.

    With a ``schema`` (of the feed's own columns) both are empty before the first event.
    """
    rows = _standing(_read_log(spark, path, schema)).drop("_fact", "_again", _VERSION)
    own = [c for c in rows.columns if c in ("_failed_rules", "_quarantined_at")]
    return rows.where("_valid").drop("_valid", *own), rows.where("not _valid").drop("_valid").withColumn(
        "_quarantine_reason", F.col("_failed_rules")[0])


def log_version(spark: SparkSession, path: str) -> int:
    """The newest version of a fact log; -1 before the first."""
    latest = VersionedDir(spark, path).latest()
    return -1 if latest is None else latest


def fact_changes(spark: SparkSession, path: str, since: int, schema: StructType | None = None) -> DataFrame:
    """Valid facts that came or went after version ``since``, with ``_sign`` 1 or -1.

    Only a fact that was picked anew is looked up among what stood before.
    """
    log = _read_log(spark, path, schema)
    new = log.where(F.col(_VERSION) > since)
    redone = new.where("_again").select("_fact").distinct()
    gone = _newest(log.where(F.col(_VERSION) <= since).join(redone, "_fact", "left_semi"))
    changes = _newest(new).withColumn("_sign", F.lit(1)).unionByName(gone.withColumn("_sign", F.lit(-1)))
    return changes.where("_valid").drop("_fact", "_again", "_valid", _VERSION)


def keep_quality(query: StreamingQuery, path: str) -> None:
    """Keep the counts a drained ``start_split`` observed, batch by batch; a repeated batch overwrites its own."""
    seen = [(p.batchId, p.observedMetrics[QUALITY]) for p in query.recentProgress if QUALITY in p.observedMetrics]
    if seen:
        spark = SparkSession.active()
        rows = spark.createDataFrame([(b, m.checked, m.rejected) for b, m in seen], "batch long, checked long, rejected long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{PREFIX}{seen[0][0]}")


def kept_quality(spark: SparkSession, path: str) -> DataFrame:
    """One row: events checked and rejected so far."""
    ensure_folder(spark, path)
    rows = spark.read.schema("batch long, checked long, rejected long").parquet(path).dropDuplicates(["batch"])
    return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("checked", "rejected")))
