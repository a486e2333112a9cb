"""Gold tables, panels, work lists and loan arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.bands import CREDIT_BANDS, CREDIT_TIERS, band
from ..functions.loans import RATE_CARD, emi, in_emi_window, is_business_hours
from ..operators.rules import with_defaults
from ..plans import candidates, gold, instalments, panels
from .book import AS_OF, Book, avg_0, avg_2, query

_TIER = """case when credit_score >= 750 then 'Excellent' when credit_score >= 700 then 'Good'
  when credit_score >= 650 then 'Average' else 'Poor' end"""
_BAND = """case when credit_score >= 800 then '800+ Excellent' when credit_score >= 750 then '750-799 Very Good'
  when credit_score >= 700 then '700-749 Good' when credit_score >= 650 then '650-699 Average'
  when credit_score >= 600 then '600-649 Below Average' else 'Below 600 Poor' end"""


# -- gold -----------------------------------------------------------------------------------------

PORTFOLIO_SQL = f"""
select loan_type, status, count(loan_id) loan_count, cast(sum(loan_amount) as double) total_exposure,
  {avg_2('loan_amount')} avg_loan_amount, {avg_2('interest_rate')} avg_interest_rate
from s_loans group by loan_type, status"""


@query(PORTFOLIO_SQL)
def portfolio_summary(b: Book) -> DataFrame:
    return gold.portfolio_summary(b.silver_loans)


@query(f"select loan_type, status, loan_count, true stamped from ({PORTFOLIO_SQL}) p")
def portfolio_stamp(b: Book) -> DataFrame:
    rows = gold.portfolio_summary(b.silver_loans, stamp=True)
    stamp = next(f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp")
    return rows.select("loan_type", "status", "loan_count", (F.col(stamp) <= F.current_timestamp()).alias("stamped"))


RISK_SQL = f"""
select {_TIER} credit_tier, count(c.customer_id) customer_count, count(distinct loan_id) active_loans,
  cast(sum(loan_amount) as double) total_active_exposure, {avg_0('credit_score')} avg_credit_score,
  {avg_0('annual_income')} avg_annual_income
from f_customers c left join (select * from s_loans where status = 'active') l on c.customer_id = l.customer_id
group by 1"""


@query(RISK_SQL)
def customer_risk_profile(b: Book) -> DataFrame:
    return gold.customer_risk_profile(b.customers, b.silver_loans)


@query(f"""
with active as (select customer_id, count(*) n, sum(loan_amount) s from s_loans where status = 'active' group by 1)
select {_TIER} credit_tier, count(*) customer_count, cast(sum(coalesce(n, 0)) as bigint) active_loans,
  cast(sum(s) as double) total_active_exposure, {avg_0('credit_score')} avg_credit_score,
  {avg_0('annual_income')} avg_annual_income
from f_customers c left join active a on c.customer_id = a.customer_id group by 1""")
def customer_risk_profile_dedup(b: Book) -> DataFrame:
    return gold.customer_risk_profile(b.customers, b.silver_loans, dedupe_customers=True)


@query(RISK_SQL + " order by avg_credit_score desc")
def risk_tier_panel(b: Book) -> DataFrame:
    return panels.risk_tier_panel(gold.customer_risk_profile(b.customers, b.silver_loans))


_DAILY = f"""
select cast(txn_date as varchar) txn_date, count(txn_id) payment_count, cast(sum(amount) as double) total_collected,
  {avg_2('amount')} avg_emi
from s_txns where txn_type = 'PAYMENT' group by txn_date"""


@query(_DAILY)
def daily_collections(b: Book) -> DataFrame:
    return gold.daily_collections(b.silver_transactions)


@query(f"""
select txn_date collection_date, payment_count, total_collected, avg_emi from ({_DAILY}) d
order by collection_date desc limit 30""")
def collections_last30(b: Book) -> DataFrame:
    return panels.collections_trend(gold.daily_collections(b.silver_transactions))


NPA_SQL = f"""
select l.loan_id, c.customer_id, c.name borrower_name, c.city, c.credit_score, l.loan_type,
  cast(l.loan_amount as double) loan_amount, cast(l.interest_rate as double) interest_rate, l.tenure_months,
  cast(l.disbursed_at as varchar) disbursed_at,
  datediff('day', cast(l.disbursed_at as date), date '{AS_OF}') days_since_disbursement
from s_loans l join f_customers c on l.customer_id = c.customer_id where l.status = 'defaulted'"""


@query(NPA_SQL)
def npa_watchlist(b: Book) -> DataFrame:
    return gold.npa_watchlist(b.silver_loans, b.customers, b.as_of)


_HOT_LOANS = """select s.* exclude (customer_id),
  case when cast(substr(loan_id, 2) as bigint) % 3 = 0 then 'C1' else customer_id end customer_id from s_loans s"""


def hot_loans(b: Book) -> DataFrame:
    """The loans, every third of them moved to one customer."""
    third = F.expr("cast(substr(loan_id, 2) as bigint) % 3 = 0")
    return b.silver_loans.withColumn("customer_id", F.when(third, F.lit("C1")).otherwise(F.col("customer_id")))


@query(f"with h_loans as ({_HOT_LOANS}) {NPA_SQL.replace('s_loans', 'h_loans')} /* s_loans */")
def watchlist_hot_customer(b: Book) -> DataFrame:
    """A third of all loans on one customer: its loans are salted, its row is repeated per salt."""
    return gold.npa_watchlist(hot_loans(b), b.customers, b.as_of, share=0.05)


@query(f"""
with h_loans as ({_HOT_LOANS})
select l.loan_id, c.name, c.credit_score from h_loans l join f_customers c on l.customer_id = c.customer_id
where l.status = 'active' and c.credit_score < 640 and l.disbursed_at < date '{AS_OF}' - interval 90 day""")
def default_candidates_hot_customer(b: Book) -> DataFrame:
    return candidates.default_candidates(hot_loans(b), b.customers, b.as_of, share=0.05)


@query(f"select loan_id, true counted from ({NPA_SQL}) n where disbursed_at is not null")
def npa_today(b: Book) -> DataFrame:
    """Days count up to the current date unless one is given."""
    rows = gold.npa_watchlist(b.silver_loans, b.customers).where("disbursed_at is not null")
    return rows.select("loan_id", (F.col("days_since_disbursement") == F.datediff(F.current_date(), F.to_date("disbursed_at"))).alias("counted"))


@query(f"""
select loan_id, borrower_name, city, credit_score, loan_type, loan_amount, interest_rate, days_since_disbursement
from ({NPA_SQL}) n order by loan_amount desc, loan_id""")
def npa_panel(b: Book) -> DataFrame:
    return panels.npa_panel(gold.npa_watchlist(b.silver_loans, b.customers, b.as_of))


@query(f"""
select loan_id, borrower_name, city, credit_score, loan_type, loan_amount, interest_rate, days_since_disbursement
from ({NPA_SQL}) n order by loan_amount desc, loan_id limit 10""")
def npa_top(b: Book) -> DataFrame:
    return panels.npa_panel(gold.npa_watchlist(b.silver_loans, b.customers, b.as_of), top=10)


@query("""
select c.customer_id, c.name, c.city, c.credit_score, l.loan_id, cast(l.loan_amount as double) loan_amount,
  l.loan_type, l.status
from f_customers c join s_loans l on c.customer_id = l.customer_id
where c.credit_score < 650 and l.status = 'active'""")
def default_risk_customers(b: Book) -> DataFrame:
    return gold.default_risk_customers(b.customers, b.silver_loans)


@query("""
select strftime(t.txn_date, '%Y-%m') "month", c.city, cast(sum(t.amount) as double) total_disbursed,
  count(distinct t.loan_id) loans_disbursed
from s_txns t join s_loans l on t.loan_id = l.loan_id join f_customers c on l.customer_id = c.customer_id
where t.txn_type = 'DISBURSEMENT' group by 1, 2""")
def monthly_disbursements(b: Book) -> DataFrame:
    return gold.monthly_disbursements(b.silver_transactions, b.silver_loans, b.customers)


@query("""
select l.loan_id, l.customer_id, l.loan_type, l.status,
  count(case when t.txn_type = 'PAYMENT' then 1 end) payments_made,
  count(case when t.txn_type = 'PENALTY' then 1 end) penalties_incurred,
  cast(sum(case when t.txn_type = 'PAYMENT' then t.amount else 0 end) as double) total_repaid
from s_loans l left join s_txns t on l.loan_id = t.loan_id
group by l.loan_id, l.customer_id, l.loan_type, l.status""")
def repayment_health(b: Book) -> DataFrame:
    return gold.repayment_health(b.silver_loans, b.silver_transactions)


# -- panels ---------------------------------------------------------------------------------------

@query("""
select count(*) total_loans, cast(sum(loan_amount) as double) total_book_value,
  cast(sum(case when status = 'active' then loan_amount else 0 end) as double) active_exposure,
  cast(sum(case when status = 'defaulted' then loan_amount else 0 end) as double) npa_exposure,
  cast(sum(case when status = 'closed' then loan_amount else 0 end) as double) closed_value,
  round(sum(case when status = 'defaulted' then loan_amount else 0 end) / nullif(sum(loan_amount), 0) * 100, 2)
    npa_percentage
from s_loans""")
def portfolio_health(b: Book) -> DataFrame:
    return panels.portfolio_health(b.silver_loans)


@query(f"""
select loan_type, status, count(*) loan_count, cast(sum(loan_amount) as double) total_amount,
  {avg_2('loan_amount')} avg_amount, {avg_2('interest_rate')} avg_rate
from s_loans group by loan_type, status order by loan_type, status""")
def loans_by_type_status(b: Book) -> DataFrame:
    return panels.loans_by_type_status(b.silver_loans)


@query(f"""
select {_BAND} credit_band, count(*) customer_count, {avg_0('annual_income')} avg_income,
  {avg_0('credit_score')} avg_score
from f_customers group by 1 order by avg_score desc""")
def credit_band_distribution(b: Book) -> DataFrame:
    return panels.credit_band_distribution(b.customers)


@query(f"select customer_id, credit_score, {_BAND} credit_band from f_customers")
def credit_band(b: Book) -> DataFrame:
    return b.customers.select("customer_id", "credit_score", band(F.col("credit_score"), CREDIT_BANDS).alias("credit_band"))


@query(f"select customer_id, credit_score, {_TIER} credit_tier from f_customers")
def credit_tier(b: Book) -> DataFrame:
    return b.customers.select("customer_id", "credit_score", band(F.col("credit_score"), CREDIT_TIERS).alias("credit_tier"))


@query("select cast(sum(loan_amount) as double) active_amount from s_loans where status = 'active'")
def active_amount(b: Book) -> DataFrame:
    return panels.active_amount(gold.portfolio_summary(b.silver_loans))


@query("""
select city, count(*) loan_count, cast(sum(loan_amount) as double) total_amount
from s_loans l join f_customers c on l.customer_id = c.customer_id group by city""")
def city_distribution(b: Book) -> DataFrame:
    return panels.city_distribution(b.customers, b.silver_loans)


@query("select status, count(*) row_count from f_loans group by status order by status")
def status_breakdown(b: Book) -> DataFrame:
    return panels.breakdown(b.loans, "status")


@query("select txn_type, count(*) row_count from f_txns group by txn_type order by txn_type")
def txn_type_breakdown(b: Book) -> DataFrame:
    return panels.breakdown(b.transactions, "txn_type")


@query("""
select loan_id, cast(loan_amount as double) loan_amount, status from f_loans
order by loan_amount asc nulls first, loan_id limit 5""")
def preview_topn(b: Book) -> DataFrame:
    return panels.preview(b.loans.select("loan_id", "loan_amount", "status"), "loan_amount", "loan_id")


@query("select loan_id, md5(concat('42', loan_id)) draw from f_loans order by md5(concat('42', loan_id)) limit 5")
def sample_n(b: Book) -> DataFrame:
    drawn = panels.sample(b.loans, "loan_id", 5, seed=42)
    return drawn.select("loan_id", F.md5(F.concat(F.lit("42"), "loan_id").cast("binary")).alias("draw"))


@query("select status, count(*) row_count from f_loans group by status order by status")
def default_status(b: Book) -> DataFrame:
    blank = b.loans.withColumn("status", F.nullif(F.col("status"), F.lit("pending")))
    return panels.breakdown(with_defaults(blank, "loans"), "status")


# -- work lists -----------------------------------------------------------------------------------

@query(f"""
select l.loan_id, c.name, c.credit_score from s_loans l join f_customers c on l.customer_id = c.customer_id
where l.status = 'active' and c.credit_score < 640 and l.disbursed_at < date '{AS_OF}' - interval 90 day""")
def default_candidates(b: Book) -> DataFrame:
    return candidates.default_candidates(b.silver_loans, b.customers, b.as_of)


@query(f"""
select l.loan_id, cast(l.loan_amount as double) loan_amount, c.name, c.credit_score
from s_loans l join f_customers c on l.customer_id = c.customer_id
where l.status = 'active' and c.credit_score >= 750 and l.disbursed_at < date '{AS_OF}' - interval 365 day""")
def foreclosure_candidates(b: Book) -> DataFrame:
    return candidates.foreclosure_candidates(b.silver_loans, b.customers, b.as_of)


@query("""
select l.loan_id, cast(l.loan_amount as double) loan_amount, cast(l.interest_rate as double) interest_rate,
  l.tenure_months, c.credit_score, c.name
from s_loans l join f_customers c on l.customer_id = c.customer_id where l.status = 'pending'""")
def pending_applications(b: Book) -> DataFrame:
    return candidates.pending_applications(b.silver_loans, b.customers)


@query(f"""
select l.loan_id, c.name, c.credit_score from s_loans l join f_customers c on l.customer_id = c.customer_id
where l.status = 'active' and c.credit_score < 640 and l.disbursed_at < date '{AS_OF}' - interval 90 day
order by c.credit_score, l.loan_id limit 10""")
def default_candidates_top(b: Book) -> DataFrame:
    return candidates.default_candidates(b.silver_loans, b.customers, b.as_of, top=10)


@query(f"""
select l.loan_id, cast(l.loan_amount as double) loan_amount, c.name, c.credit_score
from s_loans l join f_customers c on l.customer_id = c.customer_id
where l.status = 'active' and c.credit_score >= 750 and l.disbursed_at < date '{AS_OF}' - interval 365 day
order by c.credit_score desc, l.loan_id limit 10""")
def foreclosure_candidates_top(b: Book) -> DataFrame:
    return candidates.foreclosure_candidates(b.silver_loans, b.customers, b.as_of, top=10)


@query("""
select l.loan_id, cast(l.loan_amount as double) loan_amount, cast(l.interest_rate as double) interest_rate,
  l.tenure_months, c.credit_score, c.name
from s_loans l join f_customers c on l.customer_id = c.customer_id where l.status = 'pending'
order by l.loan_amount desc, l.loan_id limit 10""")
def pending_applications_top(b: Book) -> DataFrame:
    return candidates.pending_applications(b.silver_loans, b.customers, top=10)


_CARD = ", ".join(
    f"('{t}', '{tier}', cast({rate} as decimal(5,2)))" for t, tiers in RATE_CARD.items() for tier, rate in tiers.items())


@query(f"""
with card as (select * from (values {_CARD}) v(loan_type, pricing_tier, card_rate)),
priced as (select l.loan_id, l.loan_type, l.interest_rate, case when credit_score >= 780 then 'excellent'
    when credit_score >= 720 then 'good' when credit_score >= 650 then 'average' else 'poor' end pricing_tier
  from f_loans l join f_customers c on l.customer_id = c.customer_id)
select p.loan_id, p.loan_type, p.pricing_tier, cast(p.interest_rate as double) interest_rate,
  cast(card_rate as double) card_rate, cast(p.interest_rate - card_rate as double) deviation
from priced p join card on p.loan_type = card.loan_type and p.pricing_tier = card.pricing_tier
where abs(p.interest_rate - card_rate) > 0.25""")
def rate_card_deviation(b: Book) -> DataFrame:
    return candidates.rate_card_deviation(b.loans, b.customers)


# -- arithmetic, flags, instalments ---------------------------------------------------------------

_R = "(cast(interest_rate as double) / 1200)"
_G = f"pow(1 + {_R}, tenure_months)"
_EMI = f"round(cast(loan_amount as double) * {_R} * {_G} / ({_G} - 1), 2)"


@query(f"select loan_id, {_EMI} emi from f_loans")
def emi_amount(b: Book) -> DataFrame:
    amount = emi(F.col("loan_amount"), F.col("interest_rate"), F.col("tenure_months"))
    return b.loans.select("loan_id", amount.alias("emi"))


_DUE_BY_MONTH = f"""
with due as (select cast({_EMI} as decimal(14,2)) emi,
    cast(date_trunc('month', disbursed_at) as date) m, unnest(range(1, tenure_months + 1)) n
  from f_loans where disbursed_at is not null)
select strftime(m + to_months(cast(n as integer)), '%Y-%m') due_month, count(*) instalments,
  cast(sum(emi) as double) amount_due from due group by 1"""


@query(_DUE_BY_MONTH)
def due_by_month(b: Book) -> DataFrame:
    return instalments.due_by_month(b.loans).select(
        F.date_format("month", "yyyy-MM").alias("due_month"), "instalments", "amount_due")


@query(_DUE_BY_MONTH)
def instalment_calendar(b: Book) -> DataFrame:
    per_day = instalments.instalment_calendar(b.loans).groupBy("due_date").agg(
        F.count(F.lit(1)).alias("instalments"), F.sum("emi").alias("amount_due"))
    return per_day.select(F.date_format("due_date", "yyyy-MM").alias("due_month"), "instalments", "amount_due")


_MISSED = f"""
with due as (select loan_id, status, n,
    cast(date_trunc('month', disbursed_at) + to_months(cast(n as integer)) as date) m
  from (select *, unnest(range(1, tenure_months + 1)) n from s_loans where disbursed_at is not null) x),
ripe as (select * from due where m + interval 4 day <= date '{AS_OF}'),
pay as (select distinct loan_id, cast(date_trunc('month', txn_date) as date) m from s_txns where txn_type = 'PAYMENT'),
hit as (select r.loan_id, r.n, r.m, p.m is not null paid from ripe r left join pay p on r.loan_id = p.loan_id and r.m = p.m)
"""


@query(_MISSED + """
select l.loan_id, l.status, count(h.n) due, count(case when h.paid then 1 end) paid,
  count(case when not h.paid then 1 end) missed
from s_loans l left join hit h on l.loan_id = h.loan_id where l.disbursed_at is not null group by l.loan_id, l.status""")
def missed_instalments(b: Book) -> DataFrame:
    return instalments.missed_instalments(b.silver_loans, b.silver_transactions, b.as_of)


@query(_MISSED + """
select loan_id, count(*) missed, min(n) first_missed, cast(max(m + interval 4 day) as date)::varchar last_due
from hit where not paid group by loan_id""")
def missed_calendar(b: Book) -> DataFrame:
    return instalments.missed_calendar(b.silver_loans, b.silver_transactions, b.as_of).groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("missed"), F.min("instalment_no").cast("bigint").alias("first_missed"),
        F.max("due_date").alias("last_due"))


@query("""
select event_type, count(case when isodow(ts) <= 5 and hour(ts) between 9 and 17 then 1 end) in_hours,
  count(*) all_events from events group by event_type""")
def business_hours(b: Book) -> DataFrame:
    return b.table("events").groupBy("event_type").agg(
        F.count_if(is_business_hours(F.col("ts"))).alias("in_hours"), F.count(F.lit(1)).alias("all_events"))


@query("""
select txn_type, count(case when day(txn_date) between 3 and 12 then 1 end) in_window, count(*) all_rows
from f_txns group by txn_type""")
def emi_window(b: Book) -> DataFrame:
    return b.transactions.groupBy("txn_type").agg(
        F.count_if(in_emi_window(F.col("txn_date"))).alias("in_window"), F.count(F.lit(1)).alias("all_rows"))
