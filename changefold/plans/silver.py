"""Silver: bronze events in their real types, folded (customers, loans) or validated (transactions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.lists import names_where
from ..functions.temporal import decode_temporal
from ..operators.fold import dedup_first, live
from ..operators.rules import CUSTOMER_RULES, LOAN_RULES, TXN_RULES
from ..schemas import CUSTOMERS, LOANS, TRANSACTIONS, Table
from ..sources.bronze import bronze_events, discover_schema, project, read_parts
from ..sources.registry import SchemaRegistry
from ..streaming.scd1 import Scd1Target

TRANSACTION_COLUMNS = (
    "txn_id", "loan_id", "amount", "txn_type", "txn_date", "remarks", "created_at", "_ingest_ts", "_source_file",
)


def wire_types(table: Table) -> StructType:
    """How the known columns are read from an event: epoch numbers as numbers, the rest as they end up."""
    epochs = {*table.epoch_dates, *table.epoch_timestamps}
    return StructType([
        StructField(f.name, LongType() if f.name in epochs else f.dataType) for f in table.columns.fields
    ])


def typed(wire: DataFrame, table: Table, unit: str = "ms") -> DataFrame:
    """Decode the epoch columns; ``unit`` is that of the feed's timestamps.

    A number out of range joins ``_misfits`` (where there is such a column) instead of just becoming NULL.
    """
    units = {**dict.fromkeys(table.epoch_dates, "days"), **dict.fromkeys(table.epoch_timestamps, unit)}
    decoded = {c: decode_temporal(wire[c], u) for c, u in units.items()}
    if "_misfits" in wire.columns and units:
        out = names_where({f"misfit:{c}": wire[c].isNotNull() & decoded[c].isNull() for c in units})
        decoded["_misfits"] = F.concat("_misfits", out)
    return wire.withColumns(decoded)


def from_bronze(bronze: DataFrame, table: Table, schema: StructType, unit: str = "ms") -> DataFrame:
    return typed(project(bronze_events(bronze), schema, wire_types(table)), table, unit)


def parts_reader(table: Table, registry: SchemaRegistry, unit: str = "ms") -> Callable[[DataFrame], DataFrame]:
    """For a fold target: a micro-batch of ``stream_parts`` as typed columns, new source columns included.

    Bronze measures the schema of what it writes. Rows of which that is not noted are measured here before they are
    read, so a column shows up in silver from the very rows that introduced it.
    """

    def read(batch: DataFrame) -> DataFrame:
        rows, batches = read_parts(batch)
        known = sorted(batches & registry.measured())
        if len(known) < len(batches):
            unknown = rows if not known else rows.where(~F.unix_micros("_ingest_ts").isin(known))
            registry.merge(discover_schema(unknown))
        return from_bronze(rows, table, registry.load(), unit)

    return read


def customers_target(spark: SparkSession, root: str, **options) -> Scd1Target:
    return Scd1Target(spark, root, [CUSTOMERS.key], rules=CUSTOMER_RULES, **options)


def loans_target(spark: SparkSession, root: str, **options) -> Scd1Target:
    return Scd1Target(spark, root, [LOANS.key], rules=LOAN_RULES, **options)


def fixed_transactions(bronze: DataFrame, unit: str = "ms") -> DataFrame:
    """Transactions have a fixed projection: no field beyond the known ones is looked for."""
    return from_bronze(bronze, TRANSACTIONS, StructType([]), unit)


def valid_transactions(events: DataFrame, order_by, op: str = "__op", rules_first: bool = False) -> DataFrame:
    """Batch form of the transaction feed: non-deletes, first copy per id, valid rows only.

    The first copy is taken before the rules look at it unless ``rules_first``.
    """
    rows = live(events, op)
    if rules_first:
        return dedup_first(TXN_RULES.valid(rows), [TRANSACTIONS.key], order_by)
    return TXN_RULES.valid(dedup_first(rows, [TRANSACTIONS.key], order_by))


__all__ = [
    "TRANSACTION_COLUMNS", "wire_types", "typed", "from_bronze", "parts_reader", "customers_target",
    "loans_target", "fixed_transactions", "valid_transactions",
]
