"""Keyed change feeds: latest row per key, deletes, dedup, insert-if-absent.

Every "one row per key" here is ``row_number() = 1`` straight above its window. Catalyst plans a
group limit before and after the shuffle for that shape, so a task sends at most one row per key
and a key holding a third of the feed costs the reducer one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..schemas import DEFAULT_OP, METADATA_COLUMNS, SEQUENCE
from .rules import RuleSet

IS_DELETE = "_is_delete"
DELETES = "__op = 'd'"


def orderable(data_type: DataType) -> bool:
    """Whether values of the type have an order."""
    if isinstance(data_type, (MapType, VariantType)):
        return False
    if isinstance(data_type, ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return True


def _first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def fold_latest(
    events: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str] = SEQUENCE,
    deletes: str = DELETES,
    keep_image: bool = False,
) -> DataFrame:
    """The latest event of each key, deletes kept as rows with ``_is_delete`` set.

    Rows rank by ``sequence``, then deletes before upserts, then by their remaining columns in name
    order: a total order, so folding is associative and commutative and any split of the feed into
    batches gives the same result. ``keep_image`` also keeps the last upsert of a deleted key.
    """
    if IS_DELETE not in events.columns:
        events = events.withColumn(IS_DELETE, F.coalesce(F.expr(deletes), F.lit(False)))
    return _first(events, [*keys, IS_DELETE] if keep_image else keys, latest_first(events.schema, keys, sequence))


def latest_first(schema: StructType, keys: Sequence[str], sequence: Sequence[str]) -> list[Column]:
    """The order a fold ranks the events of a key by."""
    ranked = {*keys, *sequence, IS_DELETE}
    rest = sorted(f.name for f in schema.fields if f.name not in ranked and orderable(f.dataType))
    order = [F.col(c).desc_nulls_last() for c in sequence]
    order += [F.col(IS_DELETE).desc()]
    return order + [F.col(c).desc_nulls_last() for c in rest]


def published(
    folded: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str] = SEQUENCE,
    delete_mode: str = "hard",
    except_columns: Sequence[str] = METADATA_COLUMNS,
) -> DataFrame:
    """What readers see of a fold.

    ``hard`` leaves deleted keys out. ``soft`` needs a fold with ``keep_image``; it shows the last
    image of every key with ``_is_deleted`` and ``_deleted_at`` (the delete's first sequence value).
    """
    if delete_mode == "hard":
        return folded.where(~F.col(IS_DELETE)).drop(IS_DELETE, *except_columns)
    if delete_mode != "soft":
        raise ValueError(f"unknown delete mode {delete_mode!r}")
    seq = F.struct(*(F.col(c) for c in sequence))
    w = Window.partitionBy(*keys).orderBy(F.col(IS_DELETE))
    upserts_first = (
        folded.withColumn("_seq", seq)
        .withColumn("_next", F.lead("_seq").over(w))
        .withColumn("_row", F.row_number().over(w))
        .where("_row = 1")
    )
    deleted = F.col(IS_DELETE) | F.coalesce(F.col("_next") >= F.col("_seq"), F.lit(False))
    deleted_at = F.coalesce(F.col(f"_next.{sequence[0]}"), F.col(f"_seq.{sequence[0]}"))
    return (
        upserts_first.withColumn("_is_deleted", deleted)
        .withColumn("_deleted_at", F.when(F.col("_is_deleted"), deleted_at))
        .drop("_seq", "_next", "_row", IS_DELETE, *except_columns)
    )


def apply_changes(
    events: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str] = SEQUENCE,
    deletes: str = DELETES,
    except_columns: Sequence[str] = METADATA_COLUMNS,
    rules: RuleSet | None = None,
    delete_mode: str = "hard",
) -> DataFrame:
    """Current state of a whole feed. Rules check upserts before the fold; deletes bypass them.

    What it cannot use, ``set_aside`` gives with the reason: the two hold every event between them.
    """
    events = events.where(usable(keys, sequence))
    if rules is not None:
        events = events.where(rules.passes() | F.coalesce(F.expr(deletes), F.lit(False)))
    folded = fold_latest(events, keys, sequence, deletes, keep_image=delete_mode == "soft")
    return published(folded, keys, sequence, delete_mode, except_columns)


def usable(keys: Sequence[str], sequence: Sequence[str]) -> Column:
    """Only events with all keys and a first sequence value can be placed in a fold."""
    ok = F.col(sequence[0]).isNotNull()
    for key in keys:
        ok = ok & F.col(key).isNotNull()
    return ok


def set_aside(
    events: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str] = SEQUENCE,
    deletes: str = DELETES,
    rules: RuleSet | None = None,
) -> DataFrame:
    """The events ``apply_changes`` leaves out, with ``_failed_rules`` and ``_quarantine_reason``."""
    none = F.array().cast("array<string>")
    broken = none if rules is None else F.when(F.coalesce(F.expr(deletes), F.lit(False)), none).otherwise(rules.failures())
    failed = F.when(~usable(keys, sequence), F.array(F.lit("missing_key_or_sequence"))).otherwise(broken)
    bad = events.withColumn("_failed_rules", failed).where(F.size("_failed_rules") > 0)
    return bad.withColumn("_quarantine_reason", F.col("_failed_rules")[0])


def live(events: DataFrame, op: str = "__op") -> DataFrame:
    """Leave deletes out; an event without an operation code counts as a snapshot read."""
    return events.where(F.coalesce(F.col(op), F.lit(DEFAULT_OP)) != "d")


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of each key by ``order_by`` (ascending, NULLs first)."""
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    return _first(df, keys, order)


def insert_if_absent(
    new: DataFrame, existing: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Rows of ``new`` to append: keys ``existing`` lacks, the first by ``order_by`` of each."""
    return dedup_first(new, keys, order_by).join(existing.select(*keys), list(keys), "left_anti")


def op_distribution(events: DataFrame, by: Sequence[str] = (), op: str = "__op") -> DataFrame:
    """Events per operation code (and per ``by`` columns)."""
    return events.groupBy(*by, op).agg(F.count(F.lit(1)).alias("events"))
