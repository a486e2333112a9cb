"""Work lists over current loans: who may default, foreclose, be approved, or is priced off the card.

With a ``share`` the loans of hot customers are salted, see ``operators.skew.meet``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bands import PRICING_TIERS, band
from ..functions.loans import RATE_TOLERANCE, rate_card
from ..operators.skew import meet

# Score limits and ages in days of the work lists.
DEFAULT_SCORE, DEFAULT_AGE = 640, 90
FORECLOSURE_SCORE, FORECLOSURE_AGE = 750, 365


def _older_than(as_of: Column, days: int) -> Column:
    return F.col("disbursed_at") < as_of - F.make_dt_interval(F.lit(days))


def default_candidates(loans: DataFrame, customers: DataFrame, as_of: Column, top: int | None = None, share: float | None = None) -> DataFrame:
    """Active loans older than 90 days of customers scoring below 640, weakest score first."""
    weak = customers.where(F.col("credit_score") < DEFAULT_SCORE).select("customer_id", "name", "credit_score")
    due = loans.where((F.col("status") == "active") & _older_than(as_of, DEFAULT_AGE))
    out = meet(due.select("loan_id", "customer_id"), weak, "customer_id", share).select("loan_id", "name", "credit_score")
    return out if top is None else out.orderBy("credit_score", "loan_id").limit(top)


def foreclosure_candidates(loans: DataFrame, customers: DataFrame, as_of: Column, top: int | None = None, share: float | None = None) -> DataFrame:
    """Active loans older than a year of customers scoring 750 or more, best score first."""
    strong = customers.where(F.col("credit_score") >= FORECLOSURE_SCORE).select("customer_id", "name", "credit_score")
    due = loans.where((F.col("status") == "active") & _older_than(as_of, FORECLOSURE_AGE))
    out = meet(due.select("loan_id", "customer_id", "loan_amount"), strong, "customer_id", share).select(
        "loan_id", "loan_amount", "name", "credit_score")
    return out if top is None else out.orderBy(F.desc("credit_score"), "loan_id").limit(top)


def pending_applications(loans: DataFrame, customers: DataFrame, top: int | None = None, share: float | None = None) -> DataFrame:
    """Loans that wait for a decision, largest first."""
    pending = loans.where("status = 'pending'").select(
        "loan_id", "customer_id", "loan_amount", "interest_rate", "tenure_months")
    out = meet(pending, customers.select("customer_id", "credit_score", "name"), "customer_id", share).select(
        "loan_id", "loan_amount", "interest_rate", "tenure_months", "credit_score", "name")
    return out if top is None else out.orderBy(F.desc("loan_amount"), "loan_id").limit(top)


def rate_card_deviation(loans: DataFrame, customers: DataFrame, share: float | None = None) -> DataFrame:
    """Loans whose rate is further from the card than the tolerance.

    The card is 16 fixed rows, the only broadcast side the library asks for.
    """
    priced = (
        meet(loans.select("loan_id", "customer_id", "loan_type", "interest_rate"),
             customers.select("customer_id", "credit_score"), "customer_id", share)
        .withColumn("pricing_tier", band(F.col("credit_score"), PRICING_TIERS))
        .join(F.broadcast(rate_card(loans.sparkSession)), ["loan_type", "pricing_tier"])
    )
    deviation = F.col("interest_rate") - F.col("card_rate")
    return priced.where(F.abs(deviation) > F.lit(RATE_TOLERANCE).cast("decimal(5,2)")).select(
        "loan_id", "loan_type", "pricing_tier", "interest_rate", "card_rate", deviation.alias("deviation"))
