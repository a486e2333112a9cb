"""Helpers the text operators share: Arrow-batch columns, written intermediates, shared binary files."""

from __future__ import annotations

import gc
import posixpath
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from changefold.session import scratch


#: Folds UTF-8 to words: A-Z become a-z, ASCII outside letters and digits becomes a blank, the rest stays.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
#: The same words in text that is not folded yet.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")


def pieces(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text, so that what a task holds stays bounded."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def append_columns(df: DataFrame, inputs: list[str], fields: list[StructField],
                   compute: Callable[[], Callable[..., list[pa.Array]]]) -> DataFrame:
    """Add columns computed from Arrow batches of ``inputs``, texts first; other columns pass through untouched.

    ``compute()`` runs once per task and returns the function applied to each batch. A column of the
    input with the name of a new one (in any case) is replaced, as ``withColumn`` does.
    """
    new = {f.name.lower() for f in fields}
    at = [df.columns.index(c) for c in inputs]
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in new]
    schema = StructType([df.schema.fields[i] for i in keep] + fields)
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = compute()
        for whole in batches:
            for batch in pieces(whole, at[0]):
                made = apply(*(batch.column(i) for i in at))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *made], names=names)

    return df.mapInArrow(run, schema)


_HELD: dict[tuple, object] = {}


def held(key: tuple, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept by this Python worker until another model is asked for.

    A worker serves many tasks and stages; it keeps one model with what that has memorised, not one of
    every operator. Models turn the cycle search off for their memos, so it is run here.
    """
    if key not in _HELD:
        let_go()
        _HELD[key] = build()
    return _HELD[key]


def let_go() -> None:
    """Give up the model this Python worker holds, before work that needs the room and no model."""
    _HELD.clear()
    gc.enable()
    gc.collect()


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; NULL for a NULL key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Hadoop's names of schemes that pyarrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder's URI or of an absolute path."""
    if not uri.startswith("/"):
        scheme, rest = uri.split(":", 1)
        uri = f"{SCHEMES.get(scheme, scheme)}:{rest if rest.startswith('//') else '//' + rest}"
    return fs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, parts: Iterable[bytes]) -> str:
    """Write a file under its final name only once complete, so repeated or lost tasks do no harm."""
    system, root = open_fs(folder)
    system.create_dir(root, recursive=True)
    final = posixpath.join(root, name)
    temporary = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
    with system.open_output_stream(temporary) as out:
        for part in parts:
            out.write(part)
    system.move(temporary, final)
    return posixpath.join(folder, name)
