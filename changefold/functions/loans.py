"""Loan arithmetic as column expressions, all inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Base annual rate in percent by loan type and pricing tier.
RATE_CARD = {
    "HOME": {"excellent": "8.35", "good": "8.75", "average": "9.25", "poor": "10.50"},
    "PERSONAL": {"excellent": "11.50", "good": "13.00", "average": "15.50", "poor": "18.00"},
    "BUSINESS": {"excellent": "10.50", "good": "11.50", "average": "13.00", "poor": "15.00"},
    "AUTO": {"excellent": "8.50", "good": "9.25", "average": "10.00", "poor": "11.50"},
}
# Fixed value: a sanctioned rate may differ from the card by this many percentage points.
RATE_TOLERANCE = "0.25"


def emi(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Equated monthly instalment of a reducing-balance loan, rounded to cents.

    A zero rate splits the principal evenly; NULL for a loan without months.
    """
    amount = principal.cast("double")
    monthly = annual_rate.cast("double") / 1200
    growth = F.pow(1 + monthly, months.cast("double"))
    reducing = F.try_divide(amount * monthly * growth, growth - 1)
    even = F.try_divide(amount, months.cast("double"))
    return F.round(F.when(monthly == 0, even).otherwise(reducing), 2)


def npa_percentage(defaulted: Column, total: Column) -> Column:
    """Share of the book in default in percent; NULL for an empty or zero book."""
    return F.round(F.try_divide(defaulted, total) * 100, 2)


def is_business_hours(moment: Column) -> Column:
    """Monday to Friday, from 9:00 up to but not including 18:00."""
    return (F.weekday(moment) < 5) & F.hour(moment).between(9, 17)


def in_emi_window(day: Column) -> Column:
    """Within a few days of the usual due days, the 5th and the 10th."""
    return F.dayofmonth(day).between(3, 12)


def rate_card(spark: SparkSession) -> DataFrame:
    """The card as 16 rows ``(loan_type, pricing_tier, card_rate)``."""
    rows = ", ".join(
        f"('{loan_type}', '{tier}', cast({rate} as decimal(5,2)))"
        for loan_type, tiers in RATE_CARD.items()
        for tier, rate in tiers.items()
    )
    return spark.sql(f"select * from values {rows} as t(loan_type, pricing_tier, card_rate)")
