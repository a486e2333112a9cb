"""Bronze rows: one parsed landing line each, append-only.

The event is a VARIANT. Spark shreds it into typed Parquet columns on write and pushes
``variant_get`` paths into the scan, so reads stay columnar while new or changed fields need no
table change: a field's type is chosen when it is read, from the schema memory.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NullType, StringType, StructType

from ..functions.lists import names_where
from .landing import PARTITIONS, parse_object
from .registry import EXACT_DIGITS, measured
from .versions import ensure_folder

# Read on every pass over bronze, so kept as plain columns beside the event.
_LIFTED = {
    "__op": "string", "__ts_ms": "bigint", "__table": "string", "_kafka_offset": "bigint", "_kafka_partition": "int"}

_OFFSET = "_kafka_offset"

#: Declared, so that a table is readable before its first event.
BRONZE_SCHEMA = ", ".join([
    "event variant", "_corrupt_record string", *(f"{name} {t}" for name, t in _LIFTED.items()),
    *(f"{name} int" for name in PARTITIONS), "_ingest_ts timestamp", "_source_file string"])


def bronze_rows(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines (``value`` and path partitions) to bronze; a line that is no object stays as text.

    ``keep`` names columns of the lines to carry along.
    """
    event = parse_object(F.col("value"))
    partitions = [(F.col(c) if c in lines.columns else F.lit(None)).cast("int").alias(c) for c in PARTITIONS]
    parsed = lines.select(
        event.alias("event"), "value", *partitions, F.col("_metadata.file_path").alias("_source_file"))
    return parsed.select(
        "event",
        F.when(F.col("event").isNull(), F.col("value")).alias("_corrupt_record"),
        *(_lifted(name, t).alias(name) for name, t in _LIFTED.items()),
        *partitions,
        F.current_timestamp().alias("_ingest_ts"),
        "_source_file",
        *keep,
    )


def _lifted(name: str, data_type: str) -> Column:
    """A small number is read as the type JSON numbers have: any other makes Spark build a cast per row."""
    if data_type != "int":
        return variant_field("event", name, data_type)
    return variant_field("event", name, "bigint").try_cast("int")


def bronze_events(bronze: DataFrame) -> DataFrame:
    return bronze.where("_corrupt_record is null")


def dead_letters(bronze: DataFrame) -> DataFrame:
    return bronze.where("_corrupt_record is not null").select("_corrupt_record", "_ingest_ts", "_source_file")


def seen_schema() -> Column:
    """Aggregate: the merged schema of all events, as text (usable in ``observe``)."""
    return F.schema_of_variant_agg("event")


def seen_long(text: Column | str) -> Column:
    """Aggregate: a schema, as text, of just the fields with an exact number of more digits than a double keeps.

    ``text`` is the event's JSON; only events where it has a long number beside the offset are looked into; the offset
    is judged by its column, since a feed may number its events by hashes. Fields inside objects and arrays are not
    told apart.
    """
    own = F.col(text) if isinstance(text, str) else text
    fields = F.map_filter(F.col("event").cast("map<string,variant>"), lambda _, v: _many_digits(v))
    offset, long = F.col(_OFFSET), 10 ** EXACT_DIGITS
    whole_offset = rf'(?<=[{{,]"{_OFFSET}":)-?[0-9]+[,}}]'
    suspect = own.rlike(rf":(?!{whole_offset})\s*-?[0-9][0-9.]{{{EXACT_DIGITS}}}")
    written = F.concat(F.lit(f'"{_OFFSET}":'), offset.cast("string"))
    long_offset = ((offset >= long) | (offset <= -long)) & own.contains(written)
    only_offset = F.parse_json(F.lit(json.dumps({_OFFSET: long})))
    return F.schema_of_variant_agg(F.when(suspect, F.to_variant_object(fields)).when(long_offset, only_offset))


def _many_digits(value: Column) -> Column:
    digits = F.regexp_replace(F.regexp_replace(F.try_variant_get(value, "$", "string"), "[-.]", ""), "^0+", "")
    return F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL)") & (F.length(digits) > EXACT_DIGITS)


def parse_seen(text: str | None) -> StructType:
    """What ``seen_schema`` returned, as a type. Back-quoted names are left untouched."""
    if not text or not text.startswith("OBJECT<"):
        return StructType([])
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m.group(1) or "STRUCT<", text)
    return StructType.fromDDL(f"root {ddl}")["root"].dataType


def discover_schema(bronze: DataFrame) -> StructType:
    seen, long = bronze.agg(seen_schema(), seen_long(F.col("event").cast("string"))).first()
    return measured(parse_seen(seen), parse_seen(long))


def variant_field(column: str, name: str, data_type: str) -> Column:
    """One top-level field, NULL where it is absent or does not fit. Paths know no escapes, only two quotes."""
    if "'" in name and '"' in name:
        field = F.element_at(F.col(column).cast("map<string,variant>"), F.lit(name))
        return F.try_variant_get(field, "$", data_type)
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(F.col(column), f"$[{quote}{name}{quote}]", data_type)


def misfits(column: str, types: StructType) -> Column:
    """Names of the fields that hold a value which does not fit its type: reading it would blank it."""
    def lost(name: str, t) -> Column:
        return variant_field(column, name, t.simpleString()).isNull() & variant_field(column, name, "string").isNotNull()

    # any value fits a text
    return names_where({f"misfit:{f.name}": lost(f.name, f.dataType) for f in types.fields if f.dataType != StringType()})


def project(bronze: DataFrame, schema: StructType, hints: StructType | None = None) -> DataFrame:
    """Bronze as plain columns: each field of ``schema`` in its remembered type (or its hint's).

    A field never seen with a value has no type yet and is left out, unless hinted. ``_misfits`` names the
    hinted fields whose value does not fit, which come out NULL.
    """
    known = {f.name: f for f in schema.fields if not isinstance(f.dataType, NullType)}
    known.update({f.name: f for f in hints.fields} if hints else {})
    beside = [c for c in bronze.columns if c not in ("event", "_corrupt_record")]
    return bronze.select(
        *(variant_field("event", name, f.dataType.simpleString()).alias(name, metadata=f.metadata)
          for name, f in known.items() if name not in beside),
        *beside,
        *([misfits("event", hints).alias("_misfits")] if hints else []),
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze so far; a table that never had an event is empty."""
    ensure_folder(spark, path)
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


def stream_bronze(spark: SparkSession, path: str) -> DataFrame:
    ensure_folder(spark, path)
    return spark.readStream.schema(BRONZE_SCHEMA).parquet(path)


def stream_parts(spark: SparkSession, path: str) -> DataFrame:
    """Bronze as a stream of just where its rows are, ``(file, at)``, ``at`` telling the batch that wrote them.

    A micro-batch handed to a function is read with all its columns, every event put together again from its Parquet
    columns; ``read_parts`` reads the batch's files instead, and of them the fields that are asked for.
    """
    return stream_bronze(spark, path).select(
        F.col("_metadata.file_path").alias("file"), F.unix_micros("_ingest_ts").alias("at"))


def read_parts(batch: DataFrame) -> tuple[DataFrame, set[int]]:
    """The bronze rows of a micro-batch of ``stream_parts``, and which batches wrote them; a file is of one batch."""
    parts = batch.distinct().collect()  # a row a file, which the stream's own file source lists too
    files = sorted({unquote(r.file) for r in parts})
    reader = batch.sparkSession.read.schema(BRONZE_SCHEMA)
    rows = reader.parquet(*files) if files else batch.sparkSession.createDataFrame([], BRONZE_SCHEMA)
    return rows, {r["at"] for r in parts}
