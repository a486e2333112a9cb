"""Rules, quarantine, reports, keys and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.fold import insert_if_absent as absent, live
from ..operators.reconcile import (
    count_reconcile as reconcile, foreign_key_orphans, key_violations, layer_counts as count_layers, table_counts,
)
from ..operators.rules import CHECKS, CUSTOMER_RULES, LOAN_RULES, REQUIRED, TXN_RULES
from ..plans import gold
from ..session import scratch
from ..streaming.references import References
from .book import LOAN_OK, TXN_OK, TXN_ORDER, TXN_TYPES_SQL, Book, query

_TXN = ("txn_id", "loan_id", "amount", "txn_type", "txn_date")
_TXN_SQL = "txn_id, loan_id, cast(amount as double) amount, txn_type, cast(txn_date as varchar) txn_date"
_LOAN = ("loan_id", "loan_amount", "loan_type", "status", "interest_rate", "tenure_months")
_LOAN_SQL = """loan_id, cast(loan_amount as double) loan_amount, loan_type, status,
  cast(interest_rate as double) interest_rate, tenure_months"""
_REASONS = f"""concat_ws(',', case when not coalesce(amount > 0, false) then 'invalid_amount' end,
  case when not coalesce(txn_type in {TXN_TYPES_SQL}, false) then 'invalid_txn_type' end,
  case when loan_id is null then 'missing_loan_id' end)"""
_LOAN_REASONS = """concat_ws(',', case when not coalesce(loan_amount > 0, false) then 'valid_loan_amount' end,
  case when not coalesce(interest_rate between 1 and 30, false) then 'valid_interest_rate' end,
  case when not coalesce(tenure_months between 12 and 360, false) then 'valid_tenure' end,
  case when not coalesce(loan_type in ('HOME', 'PERSONAL', 'BUSINESS', 'AUTO'), false) then 'valid_loan_type' end,
  case when not coalesce(status in ('pending', 'active', 'defaulted', 'closed'), false) then 'valid_status' end)"""


@query(f"select {_TXN_SQL} from f_txns where op <> 'd' and {TXN_OK}")
def txn_valid(b: Book) -> DataFrame:
    return TXN_RULES.valid(live(b.transactions, "op")).select(*_TXN)


@query(f"""
select {_TXN_SQL}, {_REASONS} _failed_rules, split_part({_REASONS}, ',', 1) _quarantine_reason
from f_txns where op <> 'd' and not coalesce({TXN_OK}, false)""")
def txn_quarantine(b: Book) -> DataFrame:
    return TXN_RULES.quarantine(live(b.transactions, "op")).select(*_TXN, "_failed_rules", "_quarantine_reason")


@query(f"""
select {_TXN_SQL}, case when amount <= 0 then 'invalid_amount' when txn_type not in {TXN_TYPES_SQL}
  then 'invalid_txn_type' else 'missing_loan_id' end _quarantine_reason
from f_txns where amount <= 0 or txn_type not in {TXN_TYPES_SQL} or loan_id is null""")
def txn_quarantine_ref(b: Book) -> DataFrame:
    return TXN_RULES.quarantine(b.transactions, mode="reference").select(*_TXN, "_quarantine_reason")


@query(f"select {_TXN_SQL} from s_txns")
def silver_transactions(b: Book) -> DataFrame:
    return b.silver_transactions.select(*_TXN)


@query(f"select {_LOAN_SQL} from s_loans")
def loans_valid(b: Book) -> DataFrame:
    return b.silver_loans.select(*_LOAN)


@query(f"""
select {_LOAN_SQL}, {_LOAN_REASONS} _failed_rules, split_part({_LOAN_REASONS}, ',', 1) _quarantine_reason
from f_loans where not coalesce({LOAN_OK}, false)""")
def loans_quarantine(b: Book) -> DataFrame:
    return LOAN_RULES.quarantine(b.loans).select(*_LOAN, "_failed_rules", "_quarantine_reason")


@query("""
select customer_id, email, city, credit_score from f_customers
where credit_score between 300 and 900 and email is not null and city is not null""")
def customers_valid(b: Book) -> DataFrame:
    return CUSTOMER_RULES.valid(b.customers).select("customer_id", "email", "city", "credit_score")


@query("""
select customer_id, email, city, credit_score, concat_ws(',', case when credit_score not between 300 and 900 then 'valid_credit_score' end,
    case when email is null then 'email_not_null' end, case when city is null then 'city_not_null' end) reasons,
  case when credit_score not between 300 and 900 then 'valid_credit_score' when email is null then 'email_not_null'
    else 'city_not_null' end reason
from f_wanting
where not coalesce(credit_score between 300 and 900 and email is not null and city is not null, false)""")
def customers_quarantine(b: Book) -> DataFrame:
    return CUSTOMER_RULES.quarantine(b.wanting_customers).select(
        "customer_id", "email", "city", "credit_score", F.array_join("_failed_rules", ",").alias("reasons"),
        F.col("_quarantine_reason").alias("reason"))


def _rate(name: str, ok: str, source: str) -> str:
    return f"""select '{name}' table_name, count(case when {ok} then 1 end) passed,
  count(*) - count(case when {ok} then 1 end) quarantined,
  round(count(case when {ok} then 1 end) / count(*) * 100, 2) pass_rate,
  count(case when {ok} then 1 end) / count(*) * 100 < 95 breached from {source}"""


@query(" union all ".join((
    _rate("loans", LOAN_OK, "f_loans"),
    _rate("transactions", TXN_OK, "(select * from f_txns where op <> 'd') t"),
    _rate("customers", "credit_score between 300 and 900 and email is not null and city is not null", "f_customers"),
)))
def dq_pass_rate(b: Book) -> DataFrame:
    rates = {
        "loans": LOAN_RULES.pass_rate(b.loans),
        "transactions": TXN_RULES.pass_rate(live(b.transactions, "op")),
        "customers": CUSTOMER_RULES.pass_rate(b.customers),
    }
    named = (rate.select(F.lit(name).alias("table_name"), "*") for name, rate in rates.items())
    return reduce(DataFrame.unionByName, named)


def _report(source: str, rules, null_passes: bool = False) -> str:
    default = str(null_passes).lower()
    return " union all ".join(
        f"""select '{r.name}' "rule", count(*) checked, count(case when not coalesce({r.expr}, {default}) then 1 end) failed,
  count(case when coalesce({r.expr}, {default}) then 1 end) passed,
  round(count(case when coalesce({r.expr}, {default}) then 1 end) / count(*) * 100, 2) pass_rate from {source}"""
        for r in rules.rules)


@query(_report("(select * from f_txns where op <> 'd') t", TXN_RULES) + " union all " + _report("f_loans", LOAN_RULES))
def dq_rule_report(b: Book) -> DataFrame:
    return TXN_RULES.report(live(b.transactions, "op")).unionByName(LOAN_RULES.report(b.loans))


@query(" union all ".join((
    _report("f_txns", REQUIRED["transactions"]), _report("f_txns", CHECKS["transactions"], True),
    _report("f_loans", REQUIRED["loans"]), _report("f_loans", CHECKS["loans"], True),
    _report("f_customers", REQUIRED["customers"]),
)))
def constraint_report(b: Book) -> DataFrame:
    reports = (
        REQUIRED["transactions"].report(b.transactions), CHECKS["transactions"].report(b.transactions),
        REQUIRED["loans"].report(b.loans), CHECKS["loans"].report(b.loans), REQUIRED["customers"].report(b.customers),
    )
    return reduce(DataFrame.unionByName, reports)


@query("select txn_id, count(*) row_count from f_txns group by txn_id having count(*) > 1 or txn_id is null")
def pk_violations(b: Book) -> DataFrame:
    return key_violations(b.transactions, ["txn_id"])


_ORPHANS = """
select t.loan_id, count(*) row_count from f_txns t where t.loan_id is not null
  and not exists (select 1 from s_loans l where l.loan_id = t.loan_id) group by t.loan_id"""


@query(_ORPHANS)
def fk_orphans(b: Book) -> DataFrame:
    return foreign_key_orphans(b.transactions, "loan_id", b.silver_loans, "loan_id")


@query(_ORPHANS)
def fk_orphans_incremental(b: Book) -> DataFrame:
    """Payments and loans in three batches, of which a payment's may come before its loan's."""
    references = References(b.spark, scratch(b.spark, "references"), "loan_id")
    for n in range(3):
        in_batch = lambda *key: F.pmod(F.xxhash64(*key), F.lit(3)) == n
        references.apply(n + 1, b.transactions.where(in_batch("txn_id", "l_partkey", "loan_id")), b.silver_loans.where(in_batch("loan_id")))
    return references.orphans()


_ABSENT_ORDER = ", ".join(f"{c} asc nulls first" for c in TXN_ORDER)


@query(f"""
select {_TXN_SQL} from (select *, row_number() over (partition by txn_id order by {_ABSENT_ORDER}) rn from f_txns t
  where not exists (select 1 from s_txns s where s.txn_id = t.txn_id)) x where rn = 1""")
def insert_if_absent(b: Book) -> DataFrame:
    return absent(b.transactions, b.silver_transactions, ["txn_id"], TXN_ORDER).select(*_TXN)


_COUNTED = (
    ("bronze", "customers_raw", "f_customers"), ("bronze", "loans_raw", "f_loans"),
    ("bronze", "transactions_raw", "f_txns"), ("silver", "loans", "s_loans"),
    ("silver", "transactions", "s_txns"),
    ("silver", "customers_quarantine", "(select * from f_customers where not coalesce(credit_score between 300 and 900"
     " and email is not null and city is not null, false))"),
    ("gold", "portfolio_summary", "(select distinct loan_type, status from s_loans)"),
)


@query("select *, case when row_count = 0 then 'EMPTY' else 'OK' end status from (" + " union all ".join(
    f"select '{layer}' layer, '{name}' table_name, count(*) row_count from {source} t{i}"
    for i, (layer, name, source) in enumerate(_COUNTED)) + ") c")
def layer_counts(b: Book) -> DataFrame:
    return count_layers({
        "bronze": {"customers_raw": b.customers, "loans_raw": b.loans, "transactions_raw": b.transactions},
        "silver": {
            "loans": b.silver_loans, "transactions": b.silver_transactions,
            "customers_quarantine": CUSTOMER_RULES.quarantine(b.customers),
        },
        "gold": {"portfolio_summary": gold.portfolio_summary(b.silver_loans)},
    })


@query(f"""
with before as (select 'loans' table_name, count(*) n from s_loans union all
  select 'transactions', count(*) from f_txns where op <> 'd' and {TXN_OK}),
after as (select 'loans' table_name, count(*) n from f_loans union all select 'transactions', count(*) from f_txns),
expected as (select 'loans' table_name, count(*) n from f_loans where not coalesce({LOAN_OK}, false))
select a.table_name, b.n before_rows, a.n after_rows, a.n - b.n delta, coalesce(e.n, 0) expected_delta,
  a.n - b.n >= coalesce(e.n, 0) ok
from after a join before b on a.table_name = b.table_name left join expected e on a.table_name = e.table_name""")
def count_reconcile(b: Book) -> DataFrame:
    before = table_counts({"loans": b.silver_loans, "transactions": TXN_RULES.valid(live(b.transactions, "op"))})
    after = table_counts({"loans": b.loans, "transactions": b.transactions})
    expected = table_counts({"loans": LOAN_RULES.quarantine(b.loans)}).withColumnRenamed("row_count", "expected_delta")
    return reconcile(before, after, expected)
