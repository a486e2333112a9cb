"""Decode epoch numbers. The unit is always named by the caller, never guessed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_PER_DAY = {"days": 1, "ms": 86_400_000, "us": 86_400_000_000}
_LAST_DAY = 2_932_896  # 9999-12-31


def in_temporal_range(value: Column, unit: str) -> Column:
    """True when the epoch number lies between years 1 and 9999 (a wrong unit seldom does)."""
    return value.between(-719_162 * _PER_DAY[unit], (_LAST_DAY + 1) * _PER_DAY[unit] - 1)


def decode_temporal(value: Column, unit: str) -> Column:
    """Epoch ``days`` to DATE, ``ms`` or ``us`` to TIMESTAMP; NULL for numbers out of range."""
    if unit not in _PER_DAY:
        raise ValueError(f"unit must be one of {sorted(_PER_DAY)}, got {unit!r}")
    number = value.cast("bigint")
    if unit == "days":
        decoded = F.date_from_unix_date(number.cast("int"))
    elif unit == "ms":
        decoded = F.timestamp_millis(number)
    else:
        decoded = F.timestamp_micros(number)
    return F.when(in_temporal_range(number, unit), decoded)


def days_since(moment: Column, as_of: Column) -> Column:
    return F.datediff(as_of, F.to_date(moment))
