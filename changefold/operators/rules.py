"""Declarative row rules: drop, quarantine, report. Rules are SQL text, so they stay data.

A rule passes only when its expression is true: NULL fails, and a failing row is always in the
quarantine, so ``valid`` and ``quarantine`` split their input without loss.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lists import names_where
from ..schemas import LOAN_STATUSES, LOAN_TYPES, TXN_TYPES


@dataclass(frozen=True)
class Rule:
    name: str
    expr: str
    reason: str | None = None

    @property
    def label(self) -> str:
        return self.reason or self.name


class RuleSet:
    """An ordered set of rules; ``null_passes`` gives SQL CHECK semantics instead."""

    def __init__(self, *rules: Rule, null_passes: bool = False):
        self.rules = rules
        self.null_passes = null_passes

    def _ok(self, rule: Rule) -> Column:
        return F.coalesce(F.expr(rule.expr), F.lit(self.null_passes))

    def passes(self) -> Column:
        return reduce(Column.__and__, (self._ok(r) for r in self.rules))

    def failures(self) -> Column:
        """Labels of the rules a row breaks, in rule order; empty for a valid row."""
        return names_where([(r.label, ~self._ok(r)) for r in self.rules])

    def valid(self, df: DataFrame) -> DataFrame:
        """Rows passing every rule. Plain filters, so comparisons reach the Parquet scan."""
        if self.null_passes:
            return df.where(self.passes())
        return reduce(lambda kept, rule: kept.where(F.expr(rule.expr)), self.rules, df)

    def quarantine(self, df: DataFrame, mode: str = "complete", at: Column | None = None) -> DataFrame:
        """Failing rows with ``_quarantine_reason`` (first broken rule) and ``_quarantined_at``.

        ``complete`` keeps exactly the rows ``valid`` drops and lists all broken rules in
        ``_failed_rules``. ``reference`` keeps the rows for which some rule is false under
        three-valued logic, so a row whose only fault is a NULL operand is in neither output.
        """
        at = F.current_timestamp() if at is None else at
        if mode == "complete":
            failed = df.where(~self.passes()).withColumn("_failed_rules", self.failures())
            reason = F.col("_failed_rules")[0]
        elif mode == "reference":
            broken = [~F.expr(r.expr) for r in self.rules]
            failed = df.where(reduce(Column.__or__, broken))
            reason = F.coalesce(*(F.when(b, F.lit(r.label)) for b, r in zip(broken, self.rules)))
        else:
            raise ValueError(f"unknown quarantine mode {mode!r}")
        return failed.withColumn("_quarantine_reason", reason).withColumn("_quarantined_at", at)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return self.valid(df), self.quarantine(df)

    def report(self, df: DataFrame) -> DataFrame:
        """One row per rule ``(rule, checked, passed, failed, pass_rate)`` from a single scan."""
        counts = df.agg(
            F.count(F.lit(1)).alias("checked"),
            *(F.count_if(~self._ok(r)).alias(f"failed_{i}") for i, r in enumerate(self.rules)),
        )
        rows = F.array(*(
            F.struct(F.lit(r.name).alias("rule"), F.col("checked"), F.col(f"failed_{i}").alias("failed"))
            for i, r in enumerate(self.rules)
        ))
        long = counts.select(F.inline(rows)).withColumn("passed", F.col("checked") - F.col("failed"))
        return long.select("rule", "checked", "passed", "failed", _percent("passed", "checked").alias("pass_rate"))

    def pass_rate(self, df: DataFrame, threshold: float = 95.0) -> DataFrame:
        """One row: share of rows passing all rules, and whether it falls below ``threshold`` percent."""
        counts = df.agg(F.count_if(self.passes()).alias("passed"), F.count(F.lit(1)).alias("checked"))
        exact = F.try_divide(F.col("passed"), F.col("checked")) * 100
        return counts.select(
            "passed", (F.col("checked") - F.col("passed")).alias("quarantined"),
            _percent("passed", "checked").alias("pass_rate"), (exact < threshold).alias("breached"),
        )

    def metrics(self) -> list[Column]:
        """Counters to hang on ``df.observe(name, *rules.metrics())`` in a batch or a stream."""
        return [F.count(F.lit(1)).alias("checked"), F.count_if(self.passes()).alias("passed")] + [
            F.count_if(~self._ok(r)).alias(f"failed_{r.name}") for r in self.rules
        ]


def all_failures(df: DataFrame, rules: RuleSet | None) -> Column:
    """What makes a row unfit: values lost in typing (``_misfits``, where there is such a column), then rules."""
    parts = [F.coalesce("_misfits", F.array().cast("array<string>"))] if "_misfits" in df.columns else []
    if rules is not None:
        parts.append(rules.failures())
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def _percent(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 2)


# The rules of the loan book.
LOAN_RULES = RuleSet(
    Rule("valid_loan_amount", "loan_amount > 0"),
    Rule("valid_interest_rate", "interest_rate between 1 and 30"),
    Rule("valid_tenure", "tenure_months between 12 and 360"),
    Rule("valid_loan_type", f"loan_type in {LOAN_TYPES}"),
    Rule("valid_status", f"status in {LOAN_STATUSES}"),
)
TXN_RULES = RuleSet(
    Rule("valid_amount", "amount > 0", "invalid_amount"),
    Rule("valid_txn_type", f"txn_type in {TXN_TYPES}", "invalid_txn_type"),
    Rule("has_loan_id", "loan_id is not null", "missing_loan_id"),
)
CUSTOMER_RULES = RuleSet(
    Rule("valid_credit_score", "credit_score between 300 and 900"),
    Rule("email_not_null", "email is not null"),
    Rule("city_not_null", "city is not null"),
)
# NOT NULL columns of the source tables, and their CHECK constraints (NULL passes a CHECK).
REQUIRED = {
    "customers": RuleSet(*(Rule(f"{c}_required", f"{c} is not null") for c in ("customer_id", "name", "email"))),
    "loans": RuleSet(*(Rule(f"{c}_required", f"{c} is not null") for c in ("loan_id", "loan_amount"))),
    "transactions": RuleSet(
        *(Rule(f"{c}_required", f"{c} is not null") for c in ("txn_id", "amount", "txn_date"))),
}
CHECKS = {
    "loans": RuleSet(LOAN_RULES.rules[3], LOAN_RULES.rules[4], null_passes=True),
    "transactions": RuleSet(TXN_RULES.rules[1], null_passes=True),
}
# Column defaults, as SQL text.
DEFAULTS = {
    "customers": {"created_at": "current_timestamp()", "updated_at": "current_timestamp()"},
    "loans": {"status": "'pending'", "created_at": "current_timestamp()", "updated_at": "current_timestamp()"},
    "transactions": {"created_at": "current_timestamp()"},
}


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill the columns the source would default, where they are present and NULL."""
    fills = {c: F.coalesce(F.col(c), F.expr(e)) for c, e in DEFAULTS[table].items() if c in df.columns}
    return df.withColumns(fills)
