"""Lists of names made without a lambda: Spark interprets a lambda, and with it every expression around it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def names_where(named: dict[str, Column] | list[tuple[str, Column]]) -> Column:
    """The names whose condition is true, in order; empty where none is."""
    none = F.array().cast("array<string>")
    pairs = named.items() if isinstance(named, dict) else named
    return F.concat(none, *(F.when(condition, F.array(F.lit(name))).otherwise(none) for name, condition in pairs))
