"""Change topics to landing files: newline-delimited JSON below ``table=/year=/month=/day=/hour=``.

Input is any frame of the transport's shape ``(topic, offset, timestamp, value)``, with the topic's
``partition`` where it has several; ``kafka_events`` is the one for a live broker. Offsets are committed by
the query's checkpoint after its files are. One query lands all topics, whatever their tables, and reads
and parses every message once: what is no JSON object becomes a line of the table ``dead_letters``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from .versions import _path_fs

TRANSPORT_COLUMNS = ("_bridge_ts", "_kafka_offset", "_kafka_partition", "_topic")
DEAD_LETTERS = "dead_letters"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def kafka_events(
    spark: SparkSession, servers: str, topics: Sequence[str], max_offsets: int | None = None
) -> DataFrame:
    """Stream of change topics from the beginning (needs the Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def table_of(topic: Column) -> Column:
    """Last dot-separated segment of the topic."""
    return F.element_at(F.split(topic, r"\."), -1)


def route(events: DataFrame) -> DataFrame:
    return events.withColumn("table", table_of(F.col("topic")))


def parse_object(text: Column) -> Column:
    """A JSON object as VARIANT; NULL for anything else, malformed text included."""
    return F.try_parse_json(F.when(F.ltrim(text).startswith("{"), text))


def _text(value: Column) -> Column:
    """Message bytes as text on one line, NULL unless UTF-8. Line breaks in JSON are only layout."""
    raw = F.try_validate_utf8(value.cast("string"))
    return F.when(raw.contains("\n") | raw.contains("\r"), F.translate(raw, "\r\n", "  ")).otherwise(raw)


def _parsed(events: DataFrame) -> DataFrame:
    return events.withColumn("text", _text(F.col("value"))).withColumn("event", parse_object(F.col("text")))


def _keep(condition: Column, value: str | Column) -> Column:
    """Generator: one row with ``value`` where the condition holds, else none.

    A filter on a parsed event would be pushed below the parser and parse every message twice.
    """
    return F.explode(F.when(condition, F.array(value)))


def decode(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into events with their parsed ``event`` and dead letters with their raw ``value``."""
    parsed, event = _parsed(events), F.col("event")
    others = [c for c in events.columns if c != "value"]
    good = parsed.select(*events.columns, _keep(event.isNotNull(), event).alias("event"))
    dead = parsed.select(*others, _keep(event.isNull(), F.col("value")).alias("value"))
    return good, dead


def _partition(events: DataFrame) -> Column:
    """The partition of the topic; a transport without partitions has one."""
    return F.col("partition").cast("int") if "partition" in events.columns else F.lit(0)


def _enriched(partition: Column) -> Column:
    """The event as JSON text with the transport columns added, replacing any of the same name.

    They are appended to the text as it came, which keeps every other field to the letter; only an
    event that mentions one of the names is taken apart and written anew.
    """
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    values = dict(zip(TRANSPORT_COLUMNS, (stamp, F.col("offset"), partition, F.col("topic"))))
    text = F.rtrim("text")
    added = F.to_json(F.struct(*(v.alias(k) for k, v in values.items())))
    comma = F.when(text.rlike(r"^\s*\{\s*\}$"), "").otherwise(",")
    spliced = F.concat(F.substr(text, F.lit(1), F.length(text) - 1), comma, F.substr(added, F.lit(2)))

    own = F.map_filter(F.col("event").cast("map<string,variant>"), lambda k, _: ~k.isin(*TRANSPORT_COLUMNS))
    more = F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v.cast("variant"))))
    # quotes are everywhere, so a name is looked for from its underscore first
    mentions = reduce(Column.__or__, (
        F.col("text").contains(f'{c}"') & F.col("text").contains(f'"{c}"') for c in TRANSPORT_COLUMNS))
    return F.when(mentions, F.to_json(F.map_concat(own, more))).otherwise(spliced)


def _parts() -> list[Column]:
    """The folders of a message's arrival hour: ``date_format`` by ``PARTITIONS``, from plain numbers where years have four digits."""
    at, plain = F.col("timestamp"), F.year("timestamp").between(1, 9999)
    numbers = dict(zip(PARTITIONS, (F.year(at), F.month(at), F.dayofmonth(at), F.hour(at))))
    return [F.when(plain, F.lpad(numbers[name].cast("string"), len(pattern), "0")).otherwise(
        F.date_format(at, pattern)).alias(name) for name, pattern in PARTITIONS.items()]


def landing_lines(events: DataFrame) -> DataFrame:
    """``(table, value, year, month, day, hour)``: one JSON line per message, split by UTC arrival hour.

    A message that is no JSON object is a line ``(topic, partition, offset, value in base64)`` of the table
    ``dead_letters``; a table of that name would share its folder.
    """
    partition = _partition(events)
    dead = F.to_json(F.struct("topic", partition.alias("partition"), "offset", F.base64(F.col("value")).alias("value")))
    good = F.col("event").isNotNull()
    parts = _parts()
    # a generator keeps Catalyst from parsing the message once per use of the event; the line is made above it, as a
    # generator with a lambda in it is interpreted
    others = [c for c in events.columns if c not in ("table", "text", "event")]
    parsed = _parsed(route(events)).select("table", "text", *others, F.explode(F.array("event")).alias("event"))
    return parsed.select(
        F.when(good, F.col("table")).otherwise(F.lit(DEAD_LETTERS)).alias("table"),
        F.when(good, _enriched(partition)).otherwise(dead).alias("value"), *parts)


#: Observation of a landing query, and the count in it of lines of tables that were not named.
LANDED = "landed"
OTHERS = "others"


def landing_path(root: str, table: str) -> str:
    return f"{root}/table={table}"


def read_landing(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Landed lines of one table; ``since`` (``YYYY-MM-DD HH``, UTC) prunes to the folders from that hour on."""
    lines = spark.read.text(path)
    if since is None:
        return lines
    day, hour = since.split(" ")
    bound = F.struct(*(F.lit(int(x)).alias(c) for c, x in zip(PARTITIONS, (*day.split("-"), hour))))
    return lines.where(F.struct(*PARTITIONS) >= bound)


def hour_tasks(events: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """``(table, year, month, day, hour, tasks)`` of the hours of a backlog that one task should not write alone.

    ``events`` is the backlog as a batch frame of the transport's shape; values are not read, so counting is
    cheap. Dead letters are found only when messages are parsed, so theirs go by all messages of the hour.
    There are at most two rows for every ``rows_per_task`` messages.
    """
    parts = _parts()
    counts = route(events).select("table", *parts).groupBy("table", *PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
    dead = counts.groupBy(*PARTITIONS).agg(F.sum("n").alias("n")).withColumn("table", F.lit(DEAD_LETTERS))
    return counts.unionByName(dead).groupBy("table", *PARTITIONS).agg(
        F.ceil(F.max("n") / F.lit(rows_per_task)).cast("int").alias("tasks")).where("tasks > 1")


def hour_rounds(events: DataFrame, max_records: int, most_files: int) -> DataFrame:
    """``(year, month, day, hour, round)``: the hours of a backlog in rounds of so many files, one hour's more at most.

    A micro-batch of the file sink holds the names of its files on the driver, and so does a frame that reads them.
    Hours stay whole, as a file closes with its micro-batch. There is one row an hour.
    """
    counts = route(events).select("table", *_parts()).groupBy("table", *PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
    hours = counts.groupBy(*PARTITIONS).agg(F.sum(F.ceil(F.col("n") / F.lit(max_records))).alias("files"))
    before = F.sum("files").over(Window.orderBy(*PARTITIONS)) - F.col("files")
    return hours.select(*PARTITIONS, F.floor(before / F.lit(most_files)).cast("int").alias("round"))


def hour_folders(spark: SparkSession, path: str) -> dict[tuple[str, ...], str]:
    """The folders of a landed table by their hour, as ``PARTITIONS`` names it (``HIVE_NULL`` where it is NULL)."""
    pattern, fs = _path_fs(spark, "/".join([path, *(f"{c}=*" for c in PARTITIONS)]))
    found = [s.getPath().toString() for s in fs.globStatus(pattern) or []]
    return {tuple(p.split("=")[1] for p in folder.split("/")[-len(PARTITIONS):]): folder for folder in found}


def _salt(lines: DataFrame, tasks: int | DataFrame) -> DataFrame:
    """Lines of one table and hour gathered in as many tasks as asked for, in equal parts."""
    salt = F.xxhash64("value")
    # a number keeps AQE from merging shares by their bytes: what they cost is files
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(tasks, int):
        return lines.repartition(partitions, "table", *PARTITIONS, F.pmod(salt, F.lit(tasks)))
    lines = lines.join(F.broadcast(tasks), ["table", *PARTITIONS], "left")  # few rows: see hour_tasks
    dealt = lines.repartition(partitions, "table", *PARTITIONS, F.pmod(salt, F.coalesce("tasks", F.lit(1))))
    return dealt.select("table", "value", *PARTITIONS)


def start_landing(
    events: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = "30 seconds",
    max_records: int = 1_000_000,
    tasks_per_hour: int | DataFrame | None = None,
    tables: Sequence[str] = (),
    compression: str = "none",
) -> StreamingQuery:
    """Write every message below ``landing_path(root, its table)``, dead letters among them.

    A file closes after ``max_records`` events or at the end of an ``interval`` batch, whichever is
    first; ``interval=None`` drains what is there and stops. Without ``tasks_per_hour`` nothing
    is shuffled and every task writes the hours it holds. A backlog spanning many hours would leave
    a file per task and hour; ``tasks_per_hour`` then gathers each hour in that many tasks, salted
    by a hash of the event so that an hour with most of the events is split evenly too. A number goes for
    every hour; the frame ``hour_tasks`` gives several tasks to full hours only and one to each other. Each batch's
    lines are counted while they are written (``LANDED``): dead letters, those of the named ``tables``, all others.

    ``compression`` is that of the files (``gzip`` takes a tenth of the disk). A compressed file is read by one
    task, so ``max_records`` should be smaller then.
    """
    name = F.col("table")
    known = [*tables, DEAD_LETTERS]
    lines = landing_lines(events).observe(
        LANDED, *(F.count_if(name == t).alias(t) for t in known), F.count_if(~name.isin(known)).alias(OTHERS))
    if tasks_per_hour is not None:
        lines = _salt(lines, tasks_per_hour)
    writer = (
        lines.writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records)
        .option("compression", compression)
        .option("path", root)
        .partitionBy("table", *PARTITIONS)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
