"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows."""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from .common import FOLD, WORD, append_columns, utf8, written

SPAN = StructType([StructField("first", IntegerType()), StructField("last", IntegerType())])
PLACE = StructType([StructField("start", LongType()), StructField("end", LongType())])
FIELDS = [
    StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("hit_items", ArrayType(StringType())), StructField("hit_spans", ArrayType(SPAN)),
    StructField("hit_offsets", ArrayType(PLACE)),
]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def windows_of(text: bytes | None, size: int) -> set[bytes]:
    """The distinct windows of ``size`` words; a shorter text, if not empty, is one window."""
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


class Scanner:
    """An automaton over windows with a blank on either side, so that it matches whole words only."""

    def __init__(self, items: list[tuple[str, bytes | None]], size: int):
        holders: dict[bytes, set[str]] = {}
        for item, text in items:
            for window in windows_of(text, size):
                holders.setdefault(window, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, ids in holders.items():
            self.automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(ids)))
        self.empty = not holders
        if holders:
            self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of the text, merged runs of hit words (first, last), items with an occurring window."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), [], set()
        line = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(line.decode("latin-1")))
        if not found:
            return len(words), [], set()
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        last = np.searchsorted(blanks, [end for end, _ in found]) - 1
        first = last - np.array([n for _, (n, _) in found]) + 1
        return len(words), merge(zip(first.tolist(), last.tolist())), set().union(*(ids for _, (_, ids) in found))


def merge(spans) -> list[tuple[int, int]]:
    """Runs of words covered by any span, touching runs joined."""
    merged: list[list[int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return [(a, b) for a, b in merged]


def offsets(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges (start, end) of word runs in the original text."""
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b][1]) for a, b in spans]


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The different items in as many shares as keep each share's text near ``block_bytes``."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    share = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(share == b) for b in range(n)] if n > 1 else [items]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                       item_text: str = "text", window: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_items``, ``hit_spans`` and ``hit_offsets``.

    Texts are folded to words (A-Z lowered, ASCII other than letters and digits is a break) and scanned
    once by an automaton over all windows of the benchmark. ``hit_spans`` are runs of hit words,
    ``hit_offsets`` the same runs as byte ranges of the original text, ``hit_items`` the sorted ids of
    items with an occurring window. The automaton is sent to every task, so the benchmark's size is
    measured first: beyond ``block_bytes`` of text it is cut into shares, the documents pass each share's
    automaton in turn, with the state so far written out between passes.

    NULL and empty texts have no words. Items without words match nothing; a NULL item id counts as an
    item named ''; items that share an id are one item. Repeated documents are judged one by one. An
    empty benchmark hits nothing. Columns named like the results are replaced.
    """
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    marked = docs
    for i, block in enumerate(blocks):
        marked = _pass(marked, block, text, window, first=i == 0)
        if i + 1 < len(blocks):
            marked = written(marked, "decontaminate")
    return marked


def _pass(docs: DataFrame, block: DataFrame, text: str, window: int, first: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(
        [(r.item, r.text.encode() if r.text is not None else None) for r in block.collect()])

    def start():
        scanner = Scanner(sent.value, window)

        def apply(texts, *earlier):
            spans_before = earlier[0].to_pylist() if earlier else None
            items_before = earlier[1].to_pylist() if earlier else None
            made = []
            for i, body in enumerate(utf8(texts)):
                n, spans, items = scanner.scan(body)
                if earlier:
                    spans = merge([*spans, *((s["first"], s["last"]) for s in spans_before[i])])
                    items |= set(items_before[i])
                made.append((n, sum(b - a + 1 for a, b in spans), sorted(items),
                             [{"first": a, "last": b} for a, b in spans],
                             [{"start": a, "end": b} for a, b in offsets(body, spans)] if spans else []))
            columns = list(zip(*made)) if made else [[]] * len(TYPES)
            return [pa.array(list(c), t) for c, t in zip(columns, TYPES)]

        return apply

    inputs = [text] if first else [text, "hit_spans", "hit_items"]
    return append_columns(docs, inputs, FIELDS, start)


TYPES = [
    pa.int64(), pa.int64(), pa.list_(pa.string()),
    pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
]


def is_contaminated(share: int = 20):
    """At least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def digest_items():
    """Lower-case hex SHA-256 of the sorted, comma-joined item ids."""
    return F.sha2(F.array_join("hit_items", ","), 256)
