"""Sharding by weighted rendezvous hashing of stable record keys, in DataFrame expressions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import tasks


def _score(digest: Column, shard: int, weight: float) -> Column:
    """-weight / ln(u) for a uniform u in (0, 1) drawn by key and shard; the largest score wins."""
    u = (F.shiftrightunsigned(F.xxhash64(digest, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
    return F.lit(-weight) / F.log(u)


def shard_of(key: str | Column, weights: Sequence[float]) -> Column:
    """Shard of a key among ``len(weights)`` shards; NULL keys form one key of their own.

    A shard's scores do not depend on the other shards, hence adding a shard moves only the keys it
    wins, and changing one weight moves keys only from or to that shard. Shards of weight 0 get
    nothing. Equal scores go to the lowest shard.
    """
    if not weights or any(not (w >= 0 and math.isfinite(w)) for w in weights) or not any(weights):
        raise ValueError("weights must be finite, not negative and not all zero")
    column = F.col(key) if isinstance(key, str) else key
    digest = F.xxhash64(F.coalesce(column.cast("string"), F.lit("\0null")))
    scored = [F.struct(_score(digest, s, w).alias("score"), F.lit(-s).alias("shard"))
              for s, w in enumerate(weights) if w]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return -best["shard"]


def place(records: DataFrame, key: str, weights: Sequence[float], grown_weight: float = 1.0,
          blocks: int | None = None) -> DataFrame:
    """``records`` with ``shard``, a gapless ``slot`` within the shard, and ``grown_shard``.

    ``grown_shard`` is the shard after one more shard of ``grown_weight`` joins. ``records`` should be
    narrow (keys and sizes, not texts): equal rows are first counted together, so a key or row that
    holds a third of the table is one row per map task in the shuffle. Slots number each shard's rows
    by hash block, key, then the remaining columns; a block is a share of one shard, so no task sees
    a whole shard and ``blocks`` (default: the shuffle partitions) may grow with the data.
    Columns named like the results are replaced; all columns must be groupable (no maps). NULL keys
    are placed like a key; repeated rows get slots of their own; an empty table gives no rows.
    """
    results = ("shard", "slot", "grown_shard")
    columns = [c for c in records.columns if c.lower() not in results]
    if key not in columns:
        raise ValueError(f"the key {key!r} is not a column that the result keeps")
    blocks = blocks or tasks(records.sparkSession)
    named = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)]
    keyed = f"__c{columns.index(key)}"
    ids = [f"__c{i}" for i in range(len(columns))]
    rows = records.select(*named).groupBy(*ids).agg(F.count(F.lit(1)).alias("__n"))
    grown = [*weights, grown_weight]
    rows = rows.withColumns({
        "__shard": shard_of(keyed, weights), "__grown": shard_of(keyed, grown),
        "__block": F.pmod(F.xxhash64(*ids), F.lit(blocks)),
    })
    filled = rows.groupBy("__shard", "__block").agg(F.sum("__n").alias("__rows"))
    before = Window.partitionBy("__shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.select("__shard", "__block", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    order = Window.partitionBy("__shard", "__block").orderBy(keyed, *(c for c in ids if c != keyed))
    within = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0)))
    first = F.col("__start") + F.col("__before")
    return (
        numbered.join(starts, ["__shard", "__block"])
        .select("*", F.explode(F.sequence(first, first + F.col("__n") - 1)).alias("__slot"))
        .select(*(F.col(i).alias(c) for i, c in zip(ids, columns)), F.col("__shard").alias("shard"),
                F.col("__slot").alias("slot"), F.col("__grown").alias("grown_shard"))
    )
