"""Dashboard panels: what a reader sees, sorted and limited here and nowhere earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.bands import CREDIT_BANDS, band
from ..functions.loans import npa_percentage
from .gold import average


def portfolio_health(loans: DataFrame) -> DataFrame:
    """One row of book counters."""
    def amount_in(status: str):
        return F.sum(F.when(F.col("status") == status, F.col("loan_amount")).otherwise(0))

    return loans.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.sum("loan_amount").alias("total_book_value"),
        amount_in("active").alias("active_exposure"),
        amount_in("defaulted").alias("npa_exposure"),
        amount_in("closed").alias("closed_value"),
        npa_percentage(amount_in("defaulted"), F.sum("loan_amount")).alias("npa_percentage"),
    )


def loans_by_type_status(loans: DataFrame) -> DataFrame:
    return loans.groupBy("loan_type", "status").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.round(F.sum("loan_amount"), 2).alias("total_amount"),
        average(F.sum("loan_amount"), F.count("loan_amount"), 2).alias("avg_amount"),
        average(F.sum("interest_rate"), F.count("interest_rate"), 2).alias("avg_rate"),
    ).orderBy("loan_type", "status")


def credit_band_distribution(customers: DataFrame) -> DataFrame:
    return customers.groupBy(band(F.col("credit_score"), CREDIT_BANDS).alias("credit_band")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        average(F.sum("annual_income"), F.count("annual_income"), 0).alias("avg_income"),
        average(F.sum("credit_score").cast("decimal(20,0)"), F.count("credit_score"), 0).alias("avg_score"),
    ).orderBy(F.col("avg_score").desc_nulls_last(), "credit_band")


def collections_trend(daily_collections: DataFrame, days: int = 30) -> DataFrame:
    """The latest ``days`` days with collections."""
    return daily_collections.select(
        F.col("txn_date").alias("collection_date"), "payment_count",
        F.round("total_collected", 2).alias("total_collected"), F.round("avg_emi", 2).alias("avg_emi"),
    ).orderBy(F.col("collection_date").desc()).limit(days)


def npa_panel(npa_watchlist: DataFrame, top: int | None = None) -> DataFrame:
    """The watchlist by amount, largest first; ``top`` keeps that many."""
    rows = npa_watchlist.select(
        "loan_id", "borrower_name", "city", "credit_score", "loan_type",
        F.round("loan_amount", 2).alias("loan_amount"), F.round("interest_rate", 2).alias("interest_rate"),
        "days_since_disbursement",
    ).orderBy(F.col("loan_amount").desc(), "loan_id")
    return rows if top is None else rows.limit(top)


def risk_tier_panel(customer_risk_profile: DataFrame) -> DataFrame:
    return customer_risk_profile.select(
        "credit_tier", "customer_count", "active_loans",
        F.round("total_active_exposure", 2).alias("total_active_exposure"),
        F.round("avg_credit_score", 0).alias("avg_credit_score"),
        F.round("avg_annual_income", 0).alias("avg_annual_income"),
    ).orderBy(F.col("avg_credit_score").desc_nulls_last(), "credit_tier")


def active_amount(portfolio_summary: DataFrame) -> DataFrame:
    return portfolio_summary.where("status = 'active'").agg(F.sum("total_exposure").alias("active_amount"))


def city_distribution(customers: DataFrame, loans: DataFrame) -> DataFrame:
    """Loans by borrower's city; loans are summed per customer before the join."""
    per_customer = loans.where("customer_id is not null").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("loan_amount").alias("amount"))
    return (
        per_customer.join(customers.select("customer_id", "city"), "customer_id")
        .groupBy("city").agg(F.sum("n").alias("loan_count"), F.sum("amount").alias("total_amount"))
    )


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)


def preview(df: DataFrame, *order_by: str, rows: int = 5) -> DataFrame:
    """First rows by the given columns: a per-task top-n, then a merge."""
    return df.orderBy(*(F.col(c).asc_nulls_first() for c in order_by)).limit(rows)


def sample(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """``rows`` random rows, the same ones for the same seed whatever the partitioning."""
    return df.orderBy(F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(rows)
