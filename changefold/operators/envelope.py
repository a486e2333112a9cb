"""Change events in their nested form ``{before, after, source, op, ts_ms}``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def unwrap_envelope(events: DataFrame, payload: str = "payload") -> DataFrame:
    """Lift the row image to the top level with ``__op __table __ts_ms __before __deleted`` beside it.

    A delete shows its before-image and is kept; an event without payload (tombstone) is not a row.
    """
    row = events.where(F.col(payload).isNotNull()).select(
        F.coalesce(F.col(f"{payload}.after"), F.col(f"{payload}.before")).alias("image"),
        F.col(f"{payload}.op").alias("__op"),
        F.col(f"{payload}.source.table").alias("__table"),
        F.col(f"{payload}.ts_ms").alias("__ts_ms"),
        F.col(f"{payload}.before").alias("__before"),
        F.coalesce(F.col(f"{payload}.op") == "d", F.lit(False)).alias("__deleted"),
    )
    return row.select("image.*", "__op", "__table", "__ts_ms", "__before", "__deleted")


def before_after(
    events: DataFrame, key: str, fields: Mapping[str, str], payload: str = "payload"
) -> DataFrame:
    """One row per change with ``before_x`` and ``after_x`` for each ``x -> column`` in ``fields``."""
    pairs = [
        F.col(f"{payload}.{side}.{column}").alias(f"{side}_{name}")
        for name, column in fields.items()
        for side in ("before", "after")
    ]
    extra = [c for c in ("_ingested_at", "_source_file") if c in events.columns]
    return events.where(F.col(payload).isNotNull()).select(
        F.coalesce(F.col(f"{payload}.after.{key}"), F.col(f"{payload}.before.{key}")).alias(key),
        *pairs,
        F.col(f"{payload}.op").alias("op"),
        F.col(f"{payload}.source.table").alias("source_table"),
        F.col(f"{payload}.source.lsn").alias("source_lsn"),
        F.timestamp_millis(F.col(f"{payload}.ts_ms")).alias("event_ts"),
        *extra,
    )
