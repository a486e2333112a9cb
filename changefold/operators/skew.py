"""Joins of a fact to a unique key where few keys hold most of the rows.

A sketch of the fact side names its heavy keys; only their rows get a salt, and only their rows of the unique
side are repeated, once per salt. All other keys join as before, in the same shuffle, so no key's rows make
a task larger than the share that was asked for, whatever the thresholds of the session.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import MapType, VariantType

SALT = "_salt"


def hot_keys(facts: DataFrame, key: str, share: float) -> dict:
    """Number of shares each key fills that holds over ``share`` of the rows; at most ``1 / share`` keys.

    Misra-Gries style counts from a sketch of bounded size that tasks merge: a count may be off by little,
    which changes how evenly rows are dealt but no result. NULL keys join nothing and are left out.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    most = math.ceil(1 / share)
    if most > 1000:
        raise ValueError("a share under a thousandth of all rows needs no salt")
    tracked = 1 << max(6, (8 * most - 1).bit_length())
    found = facts.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    floor = max(1.0, found.rows * share)
    return {t["item"]: math.ceil(t["count"] / floor) for t in found.top or () if t["item"] is not None and t["count"] > floor}


def salted_join(facts: DataFrame, unique: DataFrame, key: str, how: str = "inner", share: float | None = None,
                hot: dict | None = None) -> DataFrame:
    """``facts.join(unique, key, how)`` for a ``unique`` side of one row per key, hot keys dealt to several tasks.

    ``how`` keeps unmatched facts (``left``, ``left_anti``, ``left_semi``) or not (``inner``); sides that keep
    unmatched rows of ``unique`` would see its repeated rows and are refused. ``share`` is the largest part
    of the facts one task may get from a key, by default one shuffle partition's part; ``hot`` are keys
    and shares found before. The salt is a hash of the fact, so a task that is run again deals alike; facts
    equal in every column stay together.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    if hot is None:
        partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_keys(facts, key, max(1.0 / partitions, 0.001) if share is None else share)
    if not hot:
        return facts.join(unique, key, how)
    salts = F.create_map(*(F.lit(x) for item in hot.items() for x in item))
    kind = facts.schema[key].dataType
    wide = F.coalesce(F.element_at(salts, F.col(key).cast(kind)), F.lit(1))
    hashed = [F.col(f"`{f.name}`") for f in facts.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    dealt = facts.withColumn(SALT, F.pmod(F.xxhash64(*hashed), wide).cast("int"))
    repeated = unique.withColumn(SALT, F.explode(F.sequence(F.lit(0), (wide - 1).cast("int"))))
    return dealt.join(repeated, [key, SALT], how).drop(SALT)


def meet(facts: DataFrame, unique: DataFrame, key: str, share: float | None) -> DataFrame:
    """Inner join; with a ``share`` hot keys are salted, without one AQE splits what its thresholds call skewed."""
    return facts.join(unique, key) if share is None else salted_join(facts, unique, key, share=share)
