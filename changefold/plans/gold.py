"""Gold: aggregates over silver tables. Silver holds one row per key, which the plans here use.

Averages are exact decimal quotients of a sum and a count, so they do not depend on row order.
Facts are always aggregated to their join key before the join: a customer or loan with a third of
all rows is one row by the time it is shuffled. Nothing is sorted; ``panels`` sorts what it shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bands import CREDIT_TIERS, band
from ..functions.temporal import days_since
from ..operators.skew import meet


def average(total: Column, count: Column, places: int) -> Column:
    return F.round(F.try_divide(total, count.cast("decimal(20,0)")), places)


def portfolio_summary(loans: DataFrame, stamp: bool = False) -> DataFrame:
    """Exposure by loan type and status; ``stamp`` adds ``refreshed_at``."""
    out = loans.groupBy("loan_type", "status").agg(
        F.count("loan_id").alias("loan_count"),
        F.round(F.sum("loan_amount"), 2).alias("total_exposure"),
        average(F.sum("loan_amount"), F.count("loan_amount"), 2).alias("avg_loan_amount"),
        average(F.sum("interest_rate"), F.count("interest_rate"), 2).alias("avg_interest_rate"),
    )
    return out.withColumn("refreshed_at", F.current_timestamp()) if stamp else out


def customer_risk_profile(customers: DataFrame, loans: DataFrame, dedupe_customers: bool = False) -> DataFrame:
    """Active exposure by credit tier.

    By default a customer counts once per active loan (at least once), in ``customer_count`` and as
    the weight of both averages, which is what a plain left join gives; ``dedupe_customers`` counts
    each customer once.
    """
    active = (
        loans.where("status = 'active' and customer_id is not null")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n_active"), F.sum("loan_amount").alias("exposure"))
    )
    n_active = F.coalesce(F.col("n_active"), F.lit(0))
    weight = F.lit(1).cast("bigint") if dedupe_customers else F.greatest(n_active, F.lit(1))
    per_customer = customers.join(active, "customer_id", "left").select(
        band(F.col("credit_score"), CREDIT_TIERS).alias("credit_tier"),
        "credit_score", "annual_income", "exposure", n_active.alias("n_active"), weight.alias("weight"),
    )

    def weighted(column: str) -> Column:
        value, weights = F.col(column).cast("decimal(14,2)"), F.col("weight").cast("decimal(10,0)")
        return average(F.sum(value * weights), F.sum(F.when(value.isNotNull(), F.col("weight"))), 0)

    return per_customer.groupBy("credit_tier").agg(
        F.sum("weight").alias("customer_count"),
        F.sum("n_active").alias("active_loans"),
        F.round(F.sum("exposure"), 2).alias("total_active_exposure"),
        weighted("credit_score").alias("avg_credit_score"),
        weighted("annual_income").alias("avg_annual_income"),
    )


def daily_collections(transactions: DataFrame) -> DataFrame:
    """Instalment payments by day."""
    return transactions.where("txn_type = 'PAYMENT'").groupBy("txn_date").agg(
        F.count("txn_id").alias("payment_count"),
        F.round(F.sum("amount"), 2).alias("total_collected"),
        average(F.sum("amount"), F.count("amount"), 2).alias("avg_emi"),
    )


def npa_watchlist(loans: DataFrame, customers: DataFrame, as_of: Column | None = None, share: float | None = None) -> DataFrame:
    """Defaulted loans with their borrower; ``as_of`` defaults to today. ``share``: see ``operators.skew.meet``."""
    as_of = F.current_date() if as_of is None else as_of
    borrowers = customers.select("customer_id", F.col("name").alias("borrower_name"), "city", "credit_score")
    return meet(loans.where("status = 'defaulted'"), borrowers, "customer_id", share).select(
        "loan_id", "customer_id", "borrower_name", "city", "credit_score", "loan_type", "loan_amount",
        "interest_rate", "tenure_months", "disbursed_at",
        days_since(F.col("disbursed_at"), as_of).alias("days_since_disbursement"),
    )


def default_risk_customers(customers: DataFrame, loans: DataFrame, share: float | None = None) -> DataFrame:
    """Active loans of customers scoring below 650."""
    risky = customers.where("credit_score < 650").select("customer_id", "name", "city", "credit_score")
    active = loans.where("status = 'active'").select("customer_id", "loan_id", "loan_amount", "loan_type", "status")
    return meet(active, risky, "customer_id", share).select(
        "customer_id", "name", "city", "credit_score", "loan_id", "loan_amount", "loan_type", "status")


def monthly_disbursements(transactions: DataFrame, loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Disbursed amount and number of loans by month and city.

    One row per loan and month meets the loans, so counting rows counts distinct loans; one row per
    customer and month meets the customers, however many loans a customer has.
    """
    per_loan = (
        transactions.where("txn_type = 'DISBURSEMENT' and loan_id is not null")
        .groupBy("loan_id", F.trunc("txn_date", "month").alias("first_day"))
        .agg(F.sum("amount").alias("amount"))
    )
    per_customer = (
        per_loan.join(loans.select("loan_id", "customer_id"), "loan_id")
        .groupBy("customer_id", "first_day").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    )
    return (
        per_customer.join(customers.select("customer_id", "city"), "customer_id")
        .groupBy("first_day", "city")
        .agg(F.sum("amount").alias("total_disbursed"), F.sum("n").alias("loans_disbursed"))
        .select(F.date_format("first_day", "yyyy-MM").alias("month"), "city", "total_disbursed", "loans_disbursed")
    )


def repayment_health(loans: DataFrame, transactions: DataFrame) -> DataFrame:
    """Payments, penalties and repaid amount per loan, loans without transactions included."""
    is_payment = F.col("txn_type") == "PAYMENT"
    per_loan = transactions.where("loan_id is not null and txn_type in ('PAYMENT', 'PENALTY')").groupBy("loan_id").agg(
        F.count_if(is_payment).alias("payments_made"),
        F.count_if(~is_payment).alias("penalties_incurred"),
        F.sum(F.when(is_payment, F.col("amount"))).alias("total_repaid"),
    )
    return (
        loans.select("loan_id", "customer_id", "loan_type", "status")
        .join(per_loan, "loan_id", "left")
        .select(
            "loan_id", "customer_id", "loan_type", "status",
            *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("payments_made", "penalties_incurred", "total_repaid")),
        )
    )
