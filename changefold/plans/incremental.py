"""Gold that follows changes: sums per group, kept up to date from signed rows.

The fold and the fact log give what a commit changed as old images with sign -1 and new ones with 1. A gold
table keeps, per group, the sums and counts its columns are made of; a refresh adds the signed sums of the
changes and drops groups that are empty then. The state is a small table per version of what it is made
from, so the version says what it contains: a repeated refresh adds nothing twice, and one that died wrote none.
Where changes are not known (a first load, versions that were cleaned up) the sums are taken over the whole table.

Customers are a table of contributions by customer, itself a fold target that gives signed changes: a batch of
loans or customers reads the customers it touches, and their old and new contributions go to the tiers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.bands import CREDIT_TIERS, band
from ..sources.versions import VersionedDir
from ..streaming.scd1 import Scd1Target
from . import gold

SIGN, ROWS = "_sign", "n_rows"
_SUM = "decimal(38,2)"


def group_sums(
    spark: SparkSession,
    path: str,
    upto: int,
    changes: Callable[[int], DataFrame | None],
    whole: Callable[[], DataFrame],
    groups: Sequence[str],
    measures: Mapping[str, Column],
    keep: int = 2,
) -> DataFrame:
    """``groups``, the sum of each measure over the rows of a group, and their number ``n_rows``, as of ``upto``.

    ``changes(version)`` gives the signed rows since a version or None, ``whole()`` all rows of now. The state
    of ``upto`` is written below ``path`` if it is not there; groups without a row have none.
    """
    store = VersionedDir(spark, path)
    at = store.latest()
    if at != upto:
        signed = changes(at) if at is not None and at < upto else None
        state = _signed_sums(whole().withColumn(SIGN, F.lit(1)) if signed is None else signed, groups, measures)
        if signed is not None:
            state = spark.read.parquet(store.path(at)).unionByName(state).groupBy(*groups).agg(
                *(F.sum(m).cast(_SUM).alias(m) for m in measures), F.sum(ROWS).alias(ROWS))
        for newer in [v for v in store.committed() if v > upto]:  # of a table that was rebuilt since
            store.remove(newer)
        state.where(F.col(ROWS) > 0).coalesce(1).write.mode("overwrite").parquet(store.path(upto))  # a row a group
        for old in store.committed()[:-keep]:
            store.remove(old)
    return spark.read.parquet(store.path(upto))


def _signed_sums(rows: DataFrame, groups: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Sums of signed rows; NULL measures count nothing."""
    return rows.groupBy(*groups).agg(
        *(F.coalesce(F.sum(m.cast("decimal(28,2)") * F.col(SIGN)), F.lit(0)).cast(_SUM).alias(name) for name, m in measures.items()),
        F.sum(F.col(SIGN).cast("long")).alias(ROWS))


def _known(column: str) -> Column:
    return F.col(column).isNotNull().cast("int")


def _total(total: str, count: str, kind: str) -> Column:
    """A kept sum in the type a plain sum has; NULL without a value, as a plain sum is."""
    return F.when(F.col(count) > 0, F.col(total).cast(kind))


def _average(total: str, count: str, kind: str, places: int) -> Column:
    return gold.average(F.col(total).cast(kind), F.col(count).cast("long"), places)


def portfolio_summary(loans: Scd1Target, path: str) -> DataFrame:
    """``gold.portfolio_summary`` of the target's current loans."""
    sums = group_sums(loans.spark, f"{path}/portfolio_summary", loans.version(), loans.changes_since, loans.current, ["loan_type", "status"], {
        "loan_count": _known("loan_id"), "amount": F.col("loan_amount"), "n_amount": _known("loan_amount"),
        "rate": F.col("interest_rate"), "n_rate": _known("interest_rate")})
    return sums.select(
        "loan_type", "status", F.col("loan_count").cast("long").alias("loan_count"),
        _total("amount", "n_amount", "decimal(22,2)").alias("total_exposure"),
        _average("amount", "n_amount", "decimal(22,2)", 2).alias("avg_loan_amount"),
        _average("rate", "n_rate", "decimal(15,2)", 2).alias("avg_interest_rate"))


def daily_collections(spark: SparkSession, upto: int, changes: Callable[[int], DataFrame],
                      whole: Callable[[], DataFrame], path: str) -> DataFrame:
    """``gold.daily_collections`` of a fact log: version ``upto``, its signed changes and its standing facts."""
    paid = lambda rows: rows.where("txn_type = 'PAYMENT'")
    sums = group_sums(spark, f"{path}/daily_collections", upto, lambda v: paid(changes(v)), lambda: paid(whole()), ["txn_date"], {
        "payment_count": _known("txn_id"), "amount": F.col("amount"), "n_amount": _known("amount")})
    return sums.select(
        "txn_date", F.col("payment_count").cast("long").alias("payment_count"),
        _total("amount", "n_amount", "decimal(22,2)").alias("total_collected"),
        _average("amount", "n_amount", "decimal(22,2)", 2).alias("avg_emi"))


_CONTRIBUTIONS = ("known", "credit_score", "annual_income", "n_active", "exposure")


def _active(loans: DataFrame, sign: Column) -> DataFrame:
    """Signed number and amount of active loans by customer."""
    return loans.where("status = 'active' and customer_id is not null").groupBy("customer_id").agg(
        F.sum(sign).cast("long").alias("n_active"),
        F.sum(F.coalesce("loan_amount", F.lit(0)).cast("decimal(28,2)") * sign).cast("decimal(28,2)").alias("exposure"))


def follow_customers(contributions: Scd1Target, customers: Scd1Target, loans: Scd1Target) -> None:
    """Bring the contributions up to the current customers and loans, reading the customers that changed."""
    upto = {"customers": customers.version(), "loans": loans.version()}
    done = contributions.applied() if contributions.exists() else {}
    if done == upto:
        return
    stamp = F.lit(contributions.version() + 1).cast("long")
    shown = ["customer_id", F.lit(True).alias("known"), "credit_score", "annual_income"]
    people = customers.changes_since(done["customers"]) if done else None
    lent = loans.changes_since(done["loans"]) if done else None
    if people is None or lent is None:
        new = customers.current().select(*shown).join(_active(loans.current(), F.lit(1)), "customer_id", "full")
    else:
        met = people.select("customer_id").distinct()
        now = customers.of_keys(met).where("not _is_delete").select(*shown)
        people = met.join(now, "customer_id", "left").withColumn("met", F.lit(True))
        moved = _active(lent, F.col(SIGN)).withColumnsRenamed({"n_active": "more", "exposure": "added"})
        touched = met.unionByName(moved.select("customer_id")).distinct()
        old = contributions.of_keys(touched).where("not _is_delete").select(
            "customer_id", *(F.col(c).alias(f"old_{c}") for c in _CONTRIBUTIONS))
        new = touched.join(old, "customer_id", "left").join(people, "customer_id", "left").join(moved, "customer_id", "left").select(
            "customer_id",
            *(F.when(F.col("met"), F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in _CONTRIBUTIONS[:3]),
            (F.coalesce("old_n_active", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_active"),
            (F.coalesce("old_exposure", F.lit(0)) + F.coalesce("added", F.lit(0))).alias("exposure"))
    rows = new.select(
        "customer_id", F.coalesce("known", F.lit(False)).alias("known"), "credit_score", "annual_income",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("exposure", F.lit(0)).cast("decimal(28,2)").alias("exposure"), stamp.alias("version"))
    rows = rows.withColumn("gone", ~F.col("known") & (F.col("n_active") == 0))
    if people is None or lent is None:
        contributions.full_refresh(rows, upto)
    else:
        contributions.apply_upto(rows, upto)


def contributions_target(spark: SparkSession, path: str, **options) -> Scd1Target:
    """One row per customer: whether it is in the table, what the tiers need of it, its active loans."""
    return Scd1Target(spark, f"{path}/contributions", ["customer_id"], ["version"], "gone",
                      except_columns=("version", "gone"), deltas=True, **options)


def customer_risk_profile(customers: Scd1Target, loans: Scd1Target, path: str, **options) -> DataFrame:
    """``gold.customer_risk_profile`` of the targets' current customers and loans, customers weighted by loans."""
    spark = customers.spark
    contributions = contributions_target(spark, path, **options)
    follow_customers(contributions, customers, loans)

    def tiers(rows: DataFrame | None) -> DataFrame | None:
        if rows is None:
            return None
        return rows.where("known").withColumns({
            "credit_tier": band(F.col("credit_score"), CREDIT_TIERS), "weight": F.greatest("n_active", F.lit(1))})

    def weighted(column: str) -> Column:
        return F.col(column).cast("decimal(14,2)") * F.col("weight").cast("decimal(10,0)")

    sums = group_sums(
        spark, f"{path}/customer_risk_profile", contributions.version(), lambda v: tiers(contributions.changes_since(v)),
        lambda: tiers(contributions.current()), ["credit_tier"], {
            "customer_count": F.col("weight"), "active_loans": F.col("n_active"), "exposure": F.col("exposure"),
            "score": weighted("credit_score"), "n_score": F.col("weight") * _known("credit_score"),
            "income": weighted("annual_income"), "n_income": F.col("weight") * _known("annual_income")})
    return sums.select(
        "credit_tier", F.col("customer_count").cast("long").alias("customer_count"), F.col("active_loans").cast("long").alias("active_loans"),
        _total("exposure", "active_loans", "decimal(32,2)").alias("total_active_exposure"),
        _average("score", "n_score", "decimal(35,2)", 0).alias("avg_credit_score"),
        _average("income", "n_income", "decimal(35,2)", 0).alias("avg_annual_income"))
