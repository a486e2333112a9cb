"""Schema memory: every column a feed has ever shown, with a type wide enough for all its values.

Of each number column it also knows whether a value had more digits than a double keeps. Only without such
a value do exact numbers and doubles meet in a double; with one the column is read as text, which keeps both.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType,
    StringType, StructField, StructType,
)

from .versions import VersionedDir


# Digits a value of each whole-number type can have, narrowest first.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_REAL = (FloatType, DoubleType)
_NUMBERS = (*_WHOLE, *_REAL, DecimalType)
#: Digits any decimal number keeps when it becomes a double and text again.
EXACT_DIGITS = 15
_LONG = "more_digits_than_a_double"


def widen(a: StructType, b: StructType) -> StructType:
    """Least schema holding both: columns are only added, types only grow. Order of merging is free."""
    merged = {f.name: f for f in a.fields}
    for f in b.fields:
        merged[f.name] = _widen_field(merged[f.name], f) if f.name in merged else f
    return StructType(list(merged.values()))


def measured(seen: StructType, long: StructType) -> StructType:
    """``seen`` with what was measured of its numbers: the columns of ``long`` had values of many digits."""
    names = set(long.fieldNames())
    return StructType([_measured_field(f, f.name in names) for f in seen.fields])


def _measured_field(f: StructField, long: bool) -> StructField:
    if not isinstance(f.dataType, _NUMBERS):
        return f
    return _field(f.name, StringType() if long and isinstance(f.dataType, _REAL) else f.dataType, long)


def _field(name: str, t: DataType, long: bool) -> StructField:
    """A column of a number type whose note says only what the type does not say by itself."""
    noted = isinstance(t, _NUMBERS) and long != _many_digits(t)
    return StructField(name, t, metadata={_LONG: long} if noted else None)


def _many_digits(t: DataType) -> bool:
    """Whether values of a type may have more digits than a double keeps."""
    return isinstance(t, (*_WHOLE, DecimalType)) and sum(_digits(t)) > EXACT_DIGITS


def _is_long(f: StructField) -> bool:
    return f.metadata.get(_LONG, _many_digits(f.dataType))


def _widen_field(a: StructField, b: StructField) -> StructField:
    if isinstance(b.dataType, NullType):
        return a
    if isinstance(a.dataType, NullType):
        return b
    if isinstance(a.dataType, _NUMBERS) and isinstance(b.dataType, _NUMBERS):
        long = _is_long(a) or _is_long(b)
        return _field(a.name, _widen_number(a.dataType, b.dataType, long), long)
    return StructField(a.name, _widen_type(a.dataType, b.dataType))


def _widen_number(a: DataType, b: DataType, long: bool) -> DataType:
    if a == b:
        return a
    if isinstance(a, _REAL) and isinstance(b, _REAL):
        return DoubleType()
    inexact = StringType() if long else DoubleType()
    if isinstance(a, _REAL) or isinstance(b, _REAL):
        return inexact
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    (ia, sa), (ib, sb) = _digits(a), _digits(b)
    whole, scale = max(ia, ib), max(sa, sb)
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else inexact


def _widen_type(a: DataType, b: DataType) -> DataType:
    """Inside arrays and structs nothing is measured, so a type's own digits count."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return widen(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_widen_type(a.elementType, b.elementType))
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        return _widen_number(a, b, _many_digits(a) or _many_digits(b))
    return StringType()


def _digits(t: DataType) -> tuple[int, int]:
    return (t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_WHOLE[type(t)], 0)


class SchemaRegistry:
    """The remembered schema of one feed, kept in a folder beside the feed's checkpoint.

    Each merge adds a note and none is ever rewritten; what holds is the least schema of all notes. Two
    writers therefore lose nothing, whatever their order.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._dir = VersionedDir(spark, path)
        self._taken = VersionedDir(spark, f"{path}/measured")

    def load(self) -> StructType:
        notes = [StructType.fromJson(json.loads(text)) for text in self._dir.read_notes()]
        return reduce(widen, notes, StructType([]))

    def merge(self, seen: StructType) -> StructType:
        """Remember ``seen`` too; returns the schema that now holds."""
        known = self.load()
        merged = widen(known, seen)
        if merged != known:
            self._dir.write_note(time.time_ns(), merged.json())
        return merged

    def note_measured(self, batches: Iterable[int]) -> None:
        """Remember that the schemas of these bronze batches were merged, after they were."""
        new = sorted({*batches} - self.measured())
        if new:
            self._taken.write_note(time.time_ns(), json.dumps(new))

    def measured(self) -> set[int]:
        """The bronze batches whose schema is known to be in."""
        return {n for text in self._taken.read_notes() for n in json.loads(text)}
