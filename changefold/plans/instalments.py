"""Instalments due and missed.

Instalment ``n`` of a loan falls in the n-th calendar month after disbursement, on the due day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.loans import emi


def _first_month() -> Column:
    return F.add_months(F.trunc("disbursed_at", "month"), 1)


def _emi() -> Column:
    return emi(F.col("loan_amount"), F.col("interest_rate"), F.col("tenure_months")).cast("decimal(14,2)")


def instalment_calendar(loans: DataFrame, due_day: int = 5, until: Column | None = None) -> DataFrame:
    """One row per loan and instalment: ``(loan_id, instalment_no, due_date, emi)``.

    The whole tenure, or what falls due up to and including ``until``; later rows are then never made.
    Loans are spread before each becomes up to hundreds of rows: the narrow rows are cheap to move, and
    the size of an input file no longer decides how long its task runs.
    """
    count = F.col("tenure_months") if until is None else _months_due(until, due_day)
    per_loan = loans.where("disbursed_at is not null and tenure_months >= 1").select(
        "loan_id", count.alias("n"), _first_month().alias("first_month"), _emi().alias("emi"))
    numbered = per_loan.where("n >= 1").repartition("loan_id").select(
        "loan_id", "first_month", "emi", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("instalment_no"))
    due_date = F.date_add(F.add_months("first_month", F.col("instalment_no") - 1), due_day - 1)
    return numbered.select("loan_id", "instalment_no", due_date.alias("due_date"), "emi")


def due_by_month(loans: DataFrame) -> DataFrame:
    """Instalments and amount due per calendar month, without a row per instalment.

    A loan adds its instalment in its first month and takes it back after its last; the running sum
    over calendar months (some thousands of rows, whatever the number of loans) is what is due.
    """
    per_loan = loans.where("disbursed_at is not null and tenure_months >= 1").select(
        _first_month().alias("first_month"), "tenure_months", _emi().alias("emi"))

    def step(month: Column, sign: int) -> Column:
        return F.struct(month.alias("month"), F.lit(sign).alias("n"), (F.col("emi") * sign).alias("amount"))

    steps = per_loan.select(F.inline(F.array(
        step(F.col("first_month"), 1), step(F.add_months("first_month", F.col("tenure_months")), -1))))
    changes = steps.groupBy("month").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    span = changes.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null")
    months = span.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    running = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return (
        months.join(changes, "month", "left")
        .select(
            "month", F.sum("n").over(running).alias("instalments"), F.sum("amount").over(running).alias("amount_due"))
        .where("instalments > 0")
    )


def _months_due(as_of: Column, due_day: int) -> Column:
    """Instalments due up to and including ``as_of``, from dates alone."""
    elapsed = (F.year(as_of) - F.year("disbursed_at")) * 12 + F.month(as_of) - F.month("disbursed_at")
    reached = F.when(F.dayofmonth(as_of) >= due_day, elapsed).otherwise(elapsed - 1)
    return F.least(F.greatest(reached, F.lit(0)), F.col("tenure_months"))


def paid_months(transactions: DataFrame) -> DataFrame:
    """One row per loan and calendar month with a payment."""
    return (
        transactions.where("txn_type = 'PAYMENT' and loan_id is not null")
        .select("loan_id", F.trunc("txn_date", "month").alias("month")).distinct()
    )


def missed_instalments(loans: DataFrame, transactions: DataFrame, as_of: Column, due_day: int = 5) -> DataFrame:
    """Per loan: instalments due by ``as_of``, of those paid in their month, and missed.

    Due months are counted from the dates, not listed, so no row per instalment is made; payments
    are reduced to one row per loan with its months before they are matched, and loans are read once.
    """
    due = loans.where("disbursed_at is not null and tenure_months >= 1").select(
        "loan_id", "status", _first_month().alias("first_month"), _months_due(as_of, due_day).alias("due"))
    # one entry per calendar month, so the list is bounded by time and not by the payments
    months = paid_months(transactions).groupBy("loan_id").agg(F.collect_list("month").alias("months"))
    in_schedule = F.filter("months", lambda m: (m >= F.col("first_month")) & (
        m < F.add_months("first_month", F.col("due"))))
    n_paid = F.coalesce(F.size(in_schedule), F.lit(0)).cast("bigint")
    n_paid = F.when(F.col("months").isNull(), F.lit(0).cast("bigint")).otherwise(n_paid)
    return due.join(months, "loan_id", "left").select(
        "loan_id", "status", F.col("due").cast("bigint").alias("due"), n_paid.alias("paid"),
        (F.col("due") - n_paid).alias("missed"))


def missed_calendar(loans: DataFrame, transactions: DataFrame, as_of: Column, due_day: int = 5) -> DataFrame:
    """The missed instalments themselves: calendar rows due by ``as_of`` without a payment in their month."""
    return (
        instalment_calendar(loans, due_day, until=as_of).withColumn("month", F.trunc("due_date", "month"))
        .join(paid_months(transactions), ["loan_id", "month"], "left_anti").drop("month")
    )
