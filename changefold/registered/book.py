"""A loan book projected from the given tables, one SQL text for Spark and for the oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, TimestampNTZType, TimestampType

from ..operators.rules import LOAN_RULES
from ..plans.silver import valid_transactions
from ..session import prepare

AS_OF = "2002-01-01"

CUSTOMERS = """
select concat('C', cast(c_custkey as string)) customer_id, c_name as name,
  concat(lower(replace(c_name, '#', '.')), '@example.com') email,
  cast(550 + floor((c_acctbal + 1000) / 40) as int) credit_score, n_name city, r_name state,
  cast((c_acctbal + 1000) * 100 as decimal(14,2)) annual_income
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey"""

# Customers of whom some lack an address or a city, or have a score that cannot be.
WANTING = """
select customer_id, name, case when cast(substr(customer_id, 2) as int) % 13 = 0 then null else email end email,
  case when cast(substr(customer_id, 2) as int) % 17 = 0 then 950 else credit_score end credit_score,
  case when cast(substr(customer_id, 2) as int) % 19 = 0 then null else city end city
from {customers}"""

LOANS = """
select concat('L', cast(o_orderkey as string)) loan_id, concat('C', cast(o_custkey as string)) customer_id,
  cast(o_totalprice as decimal(12,2)) loan_amount,
  case substr(o_orderpriority, 1, 1) when '1' then 'HOME' when '2' then 'PERSONAL' when '3' then 'BUSINESS'
    when '4' then 'AUTO' else 'MORTGAGE' end loan_type,
  case when o_orderstatus = 'P' then 'pending' when o_orderstatus = 'O' then 'active'
    when o_orderkey % 5 = 0 then 'defaulted' else 'closed' end status,
  cast(0.5 + (o_orderkey % 64) * 0.5 as decimal(5,2)) interest_rate,
  cast(6 + (o_orderkey % 61) * 6 as int) tenure_months,
  case when o_orderstatus = 'P' then null else o_orderdate end disbursed_at
from {orders}"""

TRANSACTIONS = """
select concat('T', cast(l_orderkey as string), '-', cast(l_linenumber as string)) txn_id,
  case when l_linenumber = 7 and l_partkey % 50 = 0 then null
    else concat('L', cast(l_orderkey as string)) end loan_id,
  cast(case when l_tax >= 0.075 then null when l_discount < 0.005 then -l_extendedprice
    else l_extendedprice end as decimal(12,2)) amount,
  case when l_returnflag = 'A' and l_linestatus = 'F' then 'DISBURSEMENT'
    when l_returnflag = 'N' and l_linestatus = 'O' then 'PENALTY'
    when l_returnflag = 'R' and l_linestatus = 'F' then 'FORECLOSURE'
    when l_returnflag = 'R' then 'REFUND' else 'PAYMENT' end txn_type,
  cast(l_shipdate as date) txn_date, case when l_quantity = 50 then 'd' else 'c' end op, l_partkey, l_suppkey
from {lineitem}"""

CHANGEFEED = """
select user_id, ts, event_id,
  case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end op, event_type, value
from {events}"""

TXN_ORDER = ("txn_date", "amount", "loan_id", "txn_type", "op", "l_partkey", "l_suppkey")
TXN_TYPES_SQL = "('DISBURSEMENT', 'PAYMENT', 'PENALTY', 'FORECLOSURE')"
LOAN_OK = """loan_amount > 0 and interest_rate between 1 and 30 and tenure_months between 12 and 360
  and loan_type in ('HOME', 'PERSONAL', 'BUSINESS', 'AUTO') and status in ('pending', 'active', 'defaulted', 'closed')"""
TXN_OK = f"amount > 0 and txn_type in {TXN_TYPES_SQL} and loan_id is not null"

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_BARE = {t: t for t in _TABLES}
_ORDER_SQL = ", ".join(f"{c} asc nulls first" for c in TXN_ORDER)

# Relations an oracle may name; each may build on the ones above it.
RELATIONS = {
    "f_customers": CUSTOMERS.format(**_BARE),
    "f_loans": LOANS.format(**_BARE),
    "f_txns": TRANSACTIONS.format(**_BARE),
    "f_feed": CHANGEFEED.format(**_BARE),
    "f_kept": "select * from f_loans where cast(substr(loan_id, 2) as int) % 97 <> 0",
    "f_wanting": WANTING.format(customers="f_customers"),
    "s_kept": f"select * from f_kept where {LOAN_OK}",
    "s_loans": f"select * from f_loans where {LOAN_OK}",
    "s_txns": f"""
select * from (select *, row_number() over (partition by txn_id order by {_ORDER_SQL}) rn
  from f_txns where op <> 'd') t where rn = 1 and {TXN_OK}""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Book:
    """The loan book over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream. A stream takes one file only as a pattern, hence ``[e]vents``."""
        pattern = f"{self.sf_dir}/[{name[0]}]{name[1:]}.parquet"
        return self.spark.readStream.schema(self.table(name).schema).parquet(pattern)

    def _project(self, sql: str) -> DataFrame:
        used = {t: self.table(t) for t in _TABLES if f"{{{t}}}" in sql}
        return self.spark.sql(sql, **used)

    @cached_property
    def customers(self) -> DataFrame:
        return self._project(CUSTOMERS)

    @cached_property
    def loans(self) -> DataFrame:
        return self._project(LOANS)

    @cached_property
    def transactions(self) -> DataFrame:
        return self._project(TRANSACTIONS)

    @cached_property
    def wanting_customers(self) -> DataFrame:
        return self.spark.sql(WANTING, customers=self.customers)

    @cached_property
    def feed(self) -> DataFrame:
        return self._project(CHANGEFEED)

    @cached_property
    def silver_loans(self) -> DataFrame:
        return LOAN_RULES.valid(self.loans)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        return valid_transactions(self.transactions, TXN_ORDER, op="op")

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("date")


def plain(df: DataFrame) -> DataFrame:
    """Types two engines hash alike: decimals as doubles, dates, times and lists as text."""
    def column(f):
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, ArrayType):
            c = F.concat_ws(",", c)
        return c.alias(f.name)

    return df.select(*(column(f) for f in df.schema.fields))


def query(oracle: str | None = None):
    """Register a function of a ``Book`` under its own name, with its oracle.

    An oracle names relations by ``f_*`` and ``s_*``; those it uses are put in front as CTEs.
    """
    def register(fn: Callable[[Book], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(Book(spark, sf_dir)))
        if oracle is not None:
            ORACLES[fn.__name__] = with_relations(oracle)
        return fn

    return register


def with_relations(sql: str) -> str:
    needed: list[str] = []

    def need(text: str) -> None:
        for name, body in RELATIONS.items():
            if name in text and name not in needed:
                need(body)
                needed.append(name)

    need(sql)
    ctes = [f"{name} as ({RELATIONS[name].strip()})" for name in needed]
    body = sql.strip()
    if body.lower().startswith("with "):
        ctes.append(body[5:])
        return "with " + ",\n".join(ctes)
    return "with " + ",\n".join(ctes) + "\n" + body if ctes else body


def avg_2(x: str) -> str:
    """Oracle text: exact half-up average of non-negative amounts, to cents."""
    return f"cast((2 * cast(sum({x}) * 100 as hugeint) + count({x})) // (2 * count({x})) as double) / 100"


def avg_0(x: str) -> str:
    """Oracle text: exact half-up average of non-negative amounts, to units."""
    return f"cast((2 * cast(sum({x}) * 100 as hugeint) + 100 * count({x})) // (200 * count({x})) as double)"
