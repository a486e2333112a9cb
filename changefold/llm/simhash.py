"""Near duplicates by SimHash and pigeonring filtering.

A fingerprint's 64 bits are four segments on a ring. If two fingerprints differ in at most d bits, there is
a segment from which on the differences, summed over any number of consecutive segments, stay within
their share of d: for three bits, 0 in the first, at most 1 in two, 2 in three, 3 in all. Candidates share
the first segment exactly and, of the second, at least one half; the chain is checked before the full
Hamming distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import append_columns, utf8, written
from .components import connected_components

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SEED = 42
SEGMENTS, SEGMENT_BITS = 4, 16


def simhash(text: bytes | None, width: int) -> int:
    """64-bit SimHash over word shingles, repeats included; zero without words."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    pairs = list(zip(starts[:n].tolist(), ends[width - 1:].tolist()))
    for at in range(0, n, 1 << 16):
        part = pairs[at:at + (1 << 16)]
        hashes = np.fromiter([digest(line[a:b], SEED) for a, b in part], np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """``docs`` with ``fingerprint``, the SimHash of the whole text as a signed long. NULL and blank texts: 0."""

    def start():
        def apply(texts):
            made = np.array([simhash(t, width) for t in utf8(texts)], np.uint64)
            return [pa.array(made.view(np.int64), pa.int64())]

        return apply

    return append_columns(docs, [text], [StructField("fingerprint", LongType())], start)


def as_hex(column: str = "fingerprint"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _first_masks() -> list[tuple[int, int]]:
    """(first segment, mask): all of that segment and either half of the next one on the ring."""
    half = SEGMENT_BITS // 2
    masks = []
    for first in range(SEGMENTS):
        after = (first + 1) % SEGMENTS * SEGMENT_BITS
        whole = ((1 << SEGMENT_BITS) - 1) << first * SEGMENT_BITS
        masks += [(first, whole | ((1 << half) - 1) << after + h * half) for h in (0, 1)]
    return masks


def _finer(mask: int, distance: int) -> list[int]:
    """Masks that add one of distance + 1 pieces of the other bits: a near pair agrees on one piece at least."""
    other = [b for b in range(64) if not mask >> b & 1]
    pieces = np.array_split(other, min(distance + 1, len(other)))
    return [mask | sum(1 << int(b) for b in piece) for piece in pieces]


def chained(difference: np.ndarray, first: int, distance: int) -> np.ndarray:
    """Whether the bits that differ stay within their share along the ring from segment ``first``."""
    total = np.zeros(difference.shape, np.uint8)
    fits = np.ones(difference.shape, bool)
    for length in range(1, SEGMENTS + 1):
        shift = np.uint64((first + length - 1) % SEGMENTS * SEGMENT_BITS)
        total += np.bitwise_count((difference >> shift) & np.uint64((1 << SEGMENT_BITS) - 1))
        fits &= total <= length * distance // SEGMENTS
    return fits


def forest(members: np.ndarray, first: int, distance: int, block: int = 256) -> list[tuple[int, int]]:
    """Links (root, member) that connect what chains of near pairs connect among the members of a bucket."""
    n = len(members)
    parent = np.arange(n)
    for at in range(0, n, block):
        rows = members[at:at + block]
        near = chained(rows[:, None] ^ members[None, at:], first, distance)
        a, b = np.nonzero(near)
        a, b = a + at, b + at
        keep = a < b
        a, b = a[keep], b[keep]
        while len(a):  # hook the larger root to the smaller until every near pair has one root
            while (parent != parent[parent]).any():
                parent = parent[parent]
            x, y = parent[a], parent[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
    while (parent != parent[parent]).any():
        parent = parent[parent]
    return [(int(members[p]), int(members[i])) for i, p in enumerate(parent.tolist()) if p != i]


def near_links(prints: DataFrame, distance: int = 3, bucket: int = 4096) -> DataFrame:
    """Links (``a``, ``b``) between distinct ``fingerprint``s that connect all pairs within ``distance`` bits.

    Per bucket only a spanning forest is given, never all pairs. Buckets are counted before they are
    gathered; one of more than ``bucket`` fingerprints is split by further exact pieces of the remaining
    bits, as often as needed, until each fits one task.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError("first segments agree exactly for distances below the number of segments only")
    spark = prints.sparkSession
    masks = _first_masks()
    rows = prints.select("fingerprint", F.explode(F.array(*(
        F.struct(F.lit(f).alias("first"), F.lit(_signed(m)).alias("mask")) for f, m in masks))).alias("k"))
    rows = rows.select("fingerprint", "k.first", "k.mask")
    links = []
    while True:
        rows = rows.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
        key = ["first", "mask", "value"]
        shared = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = written(rows.join(shared, key), "simhash-buckets")
        gathered = rows.where(F.col("n") <= bucket).groupBy(*key).agg(F.collect_list("fingerprint").alias("members"))
        links.append(written(_solve(gathered.select("first", "members"), distance), "simhash-links"))
        large = rows.where(F.col("n") > bucket).drop("n", "value")
        if large.isEmpty():
            break
        used = sorted({m for _, m in masks})
        finer = {m: _finer(m, distance) for m in used if m != (1 << 64) - 1}
        pairs = spark.createDataFrame([(_signed(m), _signed(x)) for m in finer for x in finer[m]], "mask long, finer long")
        rows = large.join(F.broadcast(pairs), "mask").select("fingerprint", "first", F.col("finer").alias("mask")).distinct()
        masks = sorted({(f, x) for f, m in masks if m in finer for x in finer[m]})
    made = links[0]
    for more in links[1:]:
        made = made.unionByName(more)
    return made


def _solve(buckets: DataFrame, distance: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            pairs = []
            for first, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.sort(members.values.to_numpy().view(np.uint64))
                pairs += forest(own, first, distance)
            made = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

    return buckets.mapInArrow(run, StructType([StructField("a", LongType()), StructField("b", LongType())]))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3,
                    distance: int = 3) -> DataFrame:
    """(key, ``fingerprint``, ``component_id``) for every row of ``docs``.

    Documents link when their fingerprints differ in at most ``distance`` bits; a component is what links
    connect, and is named after its smallest key. Equal fingerprints are one node of the graph, however
    many documents have it. NULL and blank texts have fingerprint zero and link like any other; NULL
    keys never name a component unless it holds nothing else (then NULL); repeated rows come back
    repeated; other columns are not read; an empty table gives no rows.
    """
    prints = fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", width)
    prints = written(prints.select("key", "fingerprint"), "simhash-prints")
    nodes = written(prints.groupBy("fingerprint").agg(F.min("key").alias("least")), "simhash-nodes")
    roots = connected_components(near_links(nodes, distance), "simhash-components")
    nodes = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "fingerprint"))
    names = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.select("fingerprint", "root").join(names, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")
