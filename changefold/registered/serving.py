"""Row filters and column masks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from ..operators.secure import ANALYST_POLICY, DEFAULT_POLICY, Principal, create_sql_functions, secured_view
from .book import Book, query

_CITIES = ("NATION_0", "NATION_3", "NATION_7")
_CITIES_SQL = "('NATION_0', 'NATION_3', 'NATION_7')"
_POLICY = replace(DEFAULT_POLICY, cities=_CITIES)
_READER = Principal("reader")
_ADMIN = Principal("admin", frozenset({"admins"}))
_ALL = "customer_id, name, email, credit_score, city, state, cast(annual_income as double) annual_income"


@query(f"""
select customer_id, name, concat(left(email, 1), '***@masked.com') email, credit_score, city, state,
  cast(null as double) annual_income from f_customers where city in {_CITIES_SQL}""")
def row_filter_nonadmin(b: Book) -> DataFrame:
    return secured_view(b.customers, _POLICY, _READER)


@query(f"select {_ALL} from f_customers")
def row_filter_admin(b: Book) -> DataFrame:
    return secured_view(b.customers, _POLICY, _ADMIN)


@query("""
with held as (select concat('analyst_', lower(r_name)) principal, n_name city
  from nation join region on n_regionkey = r_regionkey)
select customer_id, city, state from f_customers
where city in (select city from held where principal = 'analyst_asia')""")
def row_filter_entitlement(b: Book) -> DataFrame:
    regions = b.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
    held = b.table("nation").join(regions, "n_regionkey").select(
        F.concat(F.lit("analyst_"), F.lower("r_name")).alias("principal"), F.col("n_name").alias("city"))
    seen = secured_view(b.customers, _POLICY, Principal("analyst_asia"), held)
    return seen.select("customer_id", "city", "state")


@query("""
select customer_id, concat(left(email, 1), '***@masked.com') email, cast(null as double) annual_income, credit_score
from f_customers""")
def masked_customers(b: Book) -> DataFrame:
    seen = secured_view(b.customers, replace(DEFAULT_POLICY, cities=None), _READER)
    return seen.select("customer_id", "email", "annual_income", "credit_score")


@query("""
select customer_id, concat(left(email, 2), '***@***.com') email, cast(annual_income as double) annual_income,
  -1 credit_score, city from f_customers where city = 'NATION_3'""")
def masked_customers_plan(b: Book) -> DataFrame:
    seen = secured_view(b.customers, ANALYST_POLICY, Principal("n3", attributes={"city": "NATION_3"}))
    return seen.select("customer_id", "email", "annual_income", "credit_score", "city")


@query(f"""
select customer_id, concat(left(email, 1), '***@masked.com') email, cast(null as double) annual_income
from f_customers where city in {_CITIES_SQL}""")
def policy_sql_functions(b: Book) -> DataFrame:
    create_sql_functions(b.spark, _POLICY)
    return b.spark.sql(
        "select customer_id, mask_email(email, false) as email, mask_annual_income(annual_income, false) as annual_income "
        "from {customers} where city_row_filter(city, false)", customers=b.customers)
