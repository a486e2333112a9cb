"""Row filters and column masks as a projection over a table.

These are view conventions, not enforcement: whoever can read the files can read everything.
Grant readers the view, keep the files private. A predicate put on top of the view sees the
masked value, so filters cannot probe what a mask hides.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Principal:
    """The reader: a name, group memberships, attributes such as a city."""

    name: str
    groups: frozenset[str] = frozenset()
    attributes: Mapping[str, str] = field(default_factory=dict)


def _literal(text: str) -> str:
    """Text as an SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Mask:
    """``kind``: ``null``; ``sentinel`` (shows ``value``); ``prefix`` (first ``length`` characters, then ``value``)."""

    kind: str
    group: str
    value: str | int | None = None
    length: int = 0

    def sql(self, column: str) -> str:
        if self.kind == "null":
            return "null"
        if self.kind == "sentinel":
            return str(int(self.value))
        if self.kind == "prefix":
            return f"concat(left({column}, {int(self.length)}), {_literal(self.value)})"
        raise ValueError(f"unknown mask kind {self.kind!r}")


@dataclass(frozen=True)
class Policy:
    """``cities`` and ``city_attribute`` both restrict readers outside ``admin_group``; None means no limit."""

    masks: Mapping[str, Mask]
    admin_group: str = "admins"
    cities: tuple[str, ...] | None = None
    city_attribute: str | None = None

    def row_filter(self, principal: Principal) -> Column:
        if self.admin_group in principal.groups:
            return F.lit(True)
        allowed = F.lit(True)
        if self.cities is not None:
            allowed = allowed & F.col("city").isin(*self.cities)
        if self.city_attribute is not None:
            allowed = allowed & (F.col("city") == F.lit(principal.attributes.get(self.city_attribute)))
        return allowed


# The two policies in use.
FILTER_CITIES = (
    "Chennai", "Bangalore", "Hyderabad", "Kochi", "Coimbatore", "Mysore", "Visakhapatnam", "Madurai",
)
DEFAULT_POLICY = Policy(
    masks={
        "email": Mask("prefix", "admins", "***@masked.com", 1),
        "annual_income": Mask("null", "admins"),
    },
    cities=FILTER_CITIES,
)
ANALYST_POLICY = Policy(
    masks={
        "email": Mask("prefix", "admins", "***@***.com", 2),
        "credit_score": Mask("sentinel", "analysts", -1),
    },
    city_attribute="city",
)


def secured_view(
    df: DataFrame, policy: Policy, principal: Principal, entitlements: DataFrame | None = None
) -> DataFrame:
    """The table as ``principal`` may see it.

    ``entitlements`` ``(principal, city)`` replaces the policy's own row rule for non-admins: only
    rows whose city the principal holds. Whether that side is broadcast is left to its measured size.
    """
    if entitlements is None or policy.admin_group in principal.groups:
        rows = df.where(policy.row_filter(principal))
    else:
        held = entitlements.where(F.col("principal") == principal.name).select("city")
        rows = df.join(held, "city", "left_semi").select(*df.columns)
    types = dict(df.dtypes)
    return rows.select(*(
        F.expr(policy.masks[c].sql(c)).cast(types[c]).alias(c)
        if c in policy.masks and policy.masks[c].group not in principal.groups
        else F.col(c)
        for c in df.columns
    ))


def create_sql_functions(spark: SparkSession, policy: Policy = DEFAULT_POLICY, types: Mapping[str, str] | None = None):
    """Offer the policy to SQL users: ``city_row_filter(city, is_admin)`` and ``mask_<column>(value, is_member)``."""
    types = {"email": "STRING", "annual_income": "DOUBLE", "credit_score": "INT", **(types or {})}
    cities = ", ".join(map(_literal, policy.cities or ()))
    allowed = f"city in ({cities})" if cities else "true"
    spark.sql(
        "create or replace temporary function city_row_filter(city STRING, is_admin BOOLEAN) "
        f"returns BOOLEAN return is_admin or {allowed}")
    for column, mask in policy.masks.items():
        spark.sql(
            f"create or replace temporary function mask_{column}(value {types[column]}, is_member BOOLEAN) "
            f"returns {types[column]} return case when is_member then value else {mask.sql('value')} end")
