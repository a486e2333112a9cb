"""Tables of the loan book: keys, domains, wire encoding, metadata columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType, DateType, DecimalType, IntegerType, StringType, StructField, StructType, TimestampType,
)

# Domains of the source tables.
LOAN_TYPES = ("HOME", "PERSONAL", "BUSINESS", "AUTO")
LOAN_STATUSES = ("pending", "active", "defaulted", "closed")
TXN_TYPES = ("DISBURSEMENT", "PAYMENT", "PENALTY", "FORECLOSURE")

# Fixed value: an event without an operation code is a snapshot read.
DEFAULT_OP = "r"

# Bookkeeping columns that never reach a current-state table.
METADATA_COLUMNS = (
    "_ingest_ts", "_source_file",
    "__op", "__ts_ms", "__table", "__before", "__deleted",
    "_kafka_offset", "_topic", "_bridge_ts", "_kafka_partition", "_misfits",
    "year", "month", "day", "hour",
)

# What tells one event of a feed from another: an offset counts within its partition of the topic only.
EVENT_ID = ("_kafka_partition", "_kafka_offset")

# Later wins: millisecond event time, then the offset the transport gave the event.
SEQUENCE = ("__ts_ms", "_kafka_offset")


@dataclass(frozen=True, eq=False)
class Table:
    """One source relation.

    ``columns`` holds the types a current-state table shows. ``epoch_columns`` names those that
    travel as epoch numbers (dates as days, timestamps in the feed's unit), everything else
    travels as itself.
    """

    name: str
    key: str
    columns: StructType
    epoch_dates: tuple[str, ...] = ()
    epoch_timestamps: tuple[str, ...] = ()


_TEXT, _INT, _MONEY, _RATE = StringType(), IntegerType(), DecimalType(12, 2), DecimalType(5, 2)
_DATE, _MOMENT = DateType(), TimestampType()


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, t) for name, t in columns.items()])


CUSTOMERS = Table(
    "customers", "customer_id",
    _struct(
        customer_id=_TEXT, name=_TEXT, email=_TEXT, credit_score=_INT, city=_TEXT, state=_TEXT,
        annual_income=_MONEY, created_at=_MOMENT, updated_at=_MOMENT),
    epoch_timestamps=("created_at", "updated_at"),
)

LOANS = Table(
    "loans", "loan_id",
    _struct(
        loan_id=_TEXT, customer_id=_TEXT, loan_amount=_MONEY, loan_type=_TEXT, status=_TEXT,
        interest_rate=_RATE, tenure_months=_INT, disbursed_at=_MOMENT, created_at=_MOMENT, updated_at=_MOMENT),
    epoch_timestamps=("disbursed_at", "created_at", "updated_at"),
)

TRANSACTIONS = Table(
    "transactions", "txn_id",
    _struct(
        txn_id=_TEXT, loan_id=_TEXT, amount=_MONEY, txn_type=_TEXT, txn_date=_DATE, remarks=_TEXT,
        created_at=_MOMENT),
    epoch_dates=("txn_date",),
    epoch_timestamps=("created_at",),
)

TABLES = {t.name: t for t in (CUSTOMERS, LOANS, TRANSACTIONS)}
