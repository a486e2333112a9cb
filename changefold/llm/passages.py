"""Fuzzy passages that texts share, by collinear chaining of k-mer seeds.

Every text is cut into words; hashes of ``k`` words in a row are thinned to the
smallest of each ``window``, so two texts with ``k + window - 1`` equal words in a row share a seed. Each
occurrence of a seed is joined with its first document in table order (never all pairs). Per pair of documents the
matches are chained in order of both texts, gaps at a cost, with a Fenwick tree over the other text's
positions. Chains are then aligned word by word on slices of both texts: gaps between seeds by their common
words, both ends by a banded alignment that crosses exchanged, added and dropped words, as far as that pays;
chains are cut where they differ too much. What is left of at least ``least`` words is a passage.

The first document of a seed need not have the whole passage: shorter repeats may hide the one that does. Where
repeated seeds reach over a passage's length but not inside one that was found, two further looks take
longer keys, each joined with its first document once more: every run of ``least`` words, which finds what is equal
word for word; and pairs of repeated seeds nearly ``least`` words apart, whatever is between, for what is not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from changefold.session import scratch

from .common import FOLD, WORD, append_columns, pieces, utf8, written

_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass(frozen=True)
class Settings:
    """``k`` words to a seed, the smallest of ``window`` seeds kept; passages of ``least`` words and
    ``similarity`` equal words; chains of ``matches`` seeds; seeds further apart than ``gap`` words are not aligned
    over; a gap costs ``cost`` a word in chaining; slices start and end on multiples of ``grid`` words; at the ends
    texts may shift by ``band`` words; keys of two seeds are up to ``spread`` words longer than needed."""
    k: int = 5
    window: int = 8
    least: int = 50
    similarity: float = 0.8
    matches: int = 2
    gap: int = 40
    cost: float = 0.05
    grid: int = 64
    band: int = 12
    spread: int = 25

    @property
    def apart(self) -> int:
        """Words from the first to the last seed that any ``least`` equal words have in common at least."""
        return self.least - self.k - 2 * (self.window - 1)


class _Powers:
    """Powers of the hash base and its inverse, grown as texts need them."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(int(_BASE), m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(int(_INVERSE), m, 1 << 64))])


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of a text's words in order."""
    line = np.frombuffer(b" " + (text or b"").translate(FOLD) + b" ", np.uint8)
    inside = line != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    _POWERS.reach(len(line) + 1)
    sums = np.zeros(len(line) + 1, np.uint64)
    np.cumsum(line * _POWERS.up[:len(line)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _POWERS.down[starts])


def seeds(words: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the kept runs of ``k`` words; none if there are fewer words."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = _grams(words, k)
    if n <= window:
        kept = np.array([int(np.argmin(grams))])
    else:
        least, place, size = grams, np.arange(n), 1
        while size < window:  # first minimum of twice as many, of two overlapping runs at last
            step = min(size, window - size)
            later = least[step:] < least[:-step]
            place = np.where(later, place[step:], place[:-step])
            least, size = np.minimum(least[step:], least[:-step]), size + step
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]  # places never fall
        kept = place[new]
    return grams[kept], kept


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    runs, size = words, 1
    for bit in bin(k)[3:]:  # runs of twice as many words, and of one more
        runs, size = runs[:-size] * np.uint64(pow(int(_BASE), size, 1 << 64)) + runs[size:], 2 * size
        if bit == "1":
            runs, size = runs[:-1] * _BASE + words[size:], size + 1
    return _mix(runs)


class Fenwick:
    """Largest (score, index) over a growing prefix of ranks."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, rank: int, value: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.best):
            if value > self.best[rank]:
                self.best[rank] = value
            rank += rank & -rank

    def top(self, ranks: int) -> tuple[float, int]:
        """Best value at ranks below ``ranks``."""
        best = (float("-inf"), -1)
        while ranks:
            if self.best[ranks] > best:
                best = self.best[ranks]
            ranks -= ranks & -ranks
        return best


def chains(matches: list[tuple[int, int]], k: int, gap: int, cost: float) -> list[list[tuple[int, int]]]:
    """Collinear chains of matches (position here, position there), best first, no match in two chains.

    A chain's score is ``k`` per match less ``cost`` per word of distance in both texts; a match joins the
    best chain before it in both texts if that pays, else it begins one. Chains are cut where matches
    are more than ``gap`` words apart.
    """
    matches = sorted(set(matches))
    ranks = {p: i for i, p in enumerate(sorted({b for _, b in matches}))}
    tree = Fenwick(len(ranks))
    score, before = [0.0] * len(matches), [-1] * len(matches)
    waiting: list[int] = []  # matches at the same position here do not precede each other
    for i, (a, b) in enumerate(matches):
        if waiting and matches[waiting[0]][0] < a:
            for w in waiting:
                tree.put(ranks[matches[w][1]], (score[w] + cost * (matches[w][0] + matches[w][1]), w))
            waiting = []
        value, j = tree.top(ranks[b])
        gain = value - cost * (a + b)
        score[i] = k + max(0.0, gain)
        if j >= 0 and gain > 0:
            before[i] = j
        waiting.append(i)
    made, used = [], [False] * len(matches)
    for end in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        path = []
        while end >= 0 and not used[end]:
            used[end] = True
            path.append(matches[end])
            end = before[end]
        piece: list[tuple[int, int]] = []
        for match in reversed(path):
            if piece and max(match[0] - piece[-1][0], match[1] - piece[-1][1]) > gap + k:
                made.append(piece)
                piece = []
            piece.append(match)
        if piece:
            made.append(piece)
    return made


def equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words of the best alignment (longest common subsequence) of two short runs."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int32)
    for word in a:
        step = np.maximum(row[1:], np.where(b == word, row[:-1] + 1, 0))
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


#: Score of an equal word is 1; an exchanged, added or dropped one costs this much, more where that was too lax.
LOSSES = (2, 3, 4)
_PAD, _COUNT = (-1, -2), 1 << 12


def extend(pairs: list[tuple[np.ndarray, np.ndarray]], loss: int, band: int, drop: int = 24) -> np.ndarray:
    """How far the two texts of each pair go on together from their starts: (words, words there, equal words).

    The prefixes of the best alignment within the band, all pairs side by side, a word of the first text a step.
    A pair whose score falls ``drop`` below its best is done.
    """
    n, width = max((len(a) for a, _ in pairs), default=0), 2 * band + 1
    here = np.full((len(pairs), n), _PAD[0], np.int64)
    there = np.full((len(pairs), n + width), _PAD[1], np.int64)
    for i, (a, b) in enumerate(pairs):
        here[i, :len(a)] = a
        b = b[:n + band]
        there[i, band:band + len(b)] = b
    # a cell is score * _COUNT + equal words, the column is the place there less the place here
    slope = loss * _COUNT * np.arange(width)
    cell = np.where(np.arange(width) >= band, -loss * _COUNT * (np.arange(width) - band), -(1 << 40))
    cells = np.repeat(cell[None, :], len(pairs), axis=0)
    made = np.zeros((len(pairs), 3), np.int64)
    best, left = np.zeros(len(pairs), np.int64), np.arange(len(pairs))
    for i in range(1, n + 1):
        same = here[left, i - 1, None] == there[left, i - 1:i - 1 + width]
        step = cells + np.where(same, _COUNT + 1, -loss * _COUNT)
        step[:, :-1] = np.maximum(step[:, :-1], cells[:, 1:] - loss * _COUNT)
        cells = np.maximum.accumulate(step + slope, axis=1) - slope
        at = cells.argmax(axis=1)
        top = cells[np.arange(len(left)), at]
        better = top > best[left]
        rows = left[better]
        best[rows] = top[better]
        made[rows, 0], made[rows, 1], made[rows, 2] = i, i + at[better] - band, top[better] % _COUNT
        if i % 8 == 0:
            going = top > best[left] - drop * _COUNT
            left, cells = left[going], cells[going]
            if not len(left):
                break
    return made


@dataclass
class _Chain:
    """Equal runs (start here, start there, length) of a chain, and (words here, words there, equal) between them."""
    here: np.ndarray
    there: np.ndarray
    blocks: list[list[int]]
    gaps: list[tuple[int, int, int]]


def _blocks(chain: list[tuple[int, int]], here: np.ndarray, there: np.ndarray, k: int) -> _Chain:
    blocks: list[list[int]] = []
    for a, b in chain:
        if blocks and a - b == blocks[-1][0] - blocks[-1][1] and a <= blocks[-1][0] + blocks[-1][2]:
            blocks[-1][2] = max(blocks[-1][2], a + k - blocks[-1][0])
        elif blocks and (a < blocks[-1][0] + blocks[-1][2] or b < blocks[-1][1] + blocks[-1][2]):
            cut = max(blocks[-1][0] + blocks[-1][2] - a, blocks[-1][1] + blocks[-1][2] - b)
            if cut < k:
                blocks.append([a + cut, b + cut, k - cut])
        else:
            blocks.append([a, b, k])
    gaps = []
    for x, y in zip(blocks, blocks[1:]):
        p, q = here[x[0] + x[2]:y[0]], there[x[1] + x[2]:y[1]]
        same = len(p) if len(p) == len(q) and (p == q).all() else equal_words(p, q)
        gaps.append((len(p), len(q), same))
    return _Chain(here, there, blocks, gaps)


def align_all(chains_: list[_Chain], settings: Settings) -> list[list[tuple[int, int, int, int, int]]]:
    """Passages (first and end here, first and end there, equal words) of every chain; ends are exclusive.

    Seeds are equal runs; gaps between them are aligned; both ends run on. Where too few words are equal, the ends
    run on less far; if that does not do, the chain is cut at its worst gap and both parts are tried.
    """
    found: list[list[tuple[int, int, int, int, int]]] = [[] for _ in chains_]
    todo = [(c, 0, len(chain.blocks)) for c, chain in enumerate(chains_)]
    while todo:
        failed = todo
        for loss in LOSSES:
            ends = []
            for c, first, end in failed:
                chain = chains_[c]
                x, y = chain.blocks[first], chain.blocks[end - 1]
                ends.append((chain.here[:x[0]][::-1], chain.there[:x[1]][::-1]))
                ends.append((chain.here[y[0] + y[2]:], chain.there[y[1] + y[2]:]))
            reach = settings.least + settings.grid
            runs = extend([(a[:reach], b[:reach]) for a, b in ends], loss, settings.band).tolist()
            again = []
            for i, (c, first, end) in enumerate(failed):
                chain = chains_[c]
                x, y, left, right = chain.blocks[first], chain.blocks[end - 1], runs[2 * i], runs[2 * i + 1]
                a, b, p, q = x[0] - left[0], y[0] + y[2] + right[0], x[1] - left[1], y[1] + y[2] + right[1]
                same = left[2] + right[2] + sum(z[2] for z in chain.blocks[first:end]) + sum(g[2] for g in chain.gaps[first:end - 1])
                if max(b - a, q - p) < settings.least:
                    continue
                if same < settings.similarity * max(b - a, q - p):
                    again.append((c, first, end))
                elif b - a >= settings.least:
                    found[c].append((a, b, p, q, same))
            failed = again
        todo = []
        for c, first, end in failed:
            if end - first > 1:
                gaps = chains_[c].gaps
                worst = max(range(first, end - 1), key=lambda i: max(gaps[i][0], gaps[i][1]) - gaps[i][2])
                todo += [(c, first, worst + 1), (c, worst + 1, end)]
    return [sorted(f) for f in found]


# -- Spark ---------------------------------------------------------------------------------------------

SEEDS = StructType([StructField("seed", LongType()), StructField("row", LongType()),
                    StructField("at", IntegerType()), StructField("first", IntegerType())])
CHAINS = StructType([StructField(c, LongType()) for c in ("row", "other")]
                    + [StructField(c, IntegerType()) for c in ("lo", "hi", "other_lo", "other_hi")]
                    + [StructField("here", ArrayType(IntegerType())), StructField("there", ArrayType(IntegerType()))])
SLICES = StructType([StructField("row", LongType()), StructField("lo", IntegerType()), StructField("hi", IntegerType()),
                     StructField("words", BinaryType())])
PASSAGES = StructType([StructField("row", LongType()), StructField("other", LongType())]
                      + [StructField(c, IntegerType()) for c in ("first", "end", "other_first", "other_end", "equal")])


def _seed_rows(texts: DataFrame, s: Settings) -> DataFrame:
    def run(batches):
        for batch in (p for whole in batches for p in pieces(whole, 1)):
            made = [[], [], [], []]
            for row, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = word_hashes(text)
                found, at = seeds(words if len(words) >= s.least else words[:0], s.k, s.window)
                first = np.zeros(len(found), np.int32)
                first[np.unique(found, return_index=True)[1]] = 1
                for column, x in zip(made, (found.view(np.int64), np.full(len(found), row, np.int64), at.astype(np.int32), first)):
                    column.append(x)
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in made], names=SEEDS.names)

    return texts.mapInArrow(run, SEEDS)


def _chain_rows(pairs: DataFrame, s: Settings) -> DataFrame:
    """Chains of each pair's matches, with the slices of both texts they are to be aligned on."""
    def run(batches):
        for batch in batches:
            rows = []
            for row, other, here, there in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for chain in chains(list(zip(here, there)), s.k, s.gap, s.cost):
                    if len(chain) < s.matches:
                        continue
                    a, b = [x for x, _ in chain], [y for _, y in chain]
                    spans = [v for p in (a, b) for v in (
                        max(0, p[0] - s.least) // s.grid * s.grid, -(-(p[-1] + s.k + s.least) // s.grid) * s.grid)]
                    rows.append((row, other, *spans, a, b))
            types = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.list_(pa.int32())] * 2
            columns = zip(*rows) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=CHAINS.names)

    return pairs.mapInArrow(run, CHAINS)


def _slice_rows(asked: DataFrame) -> DataFrame:
    """The hashes of the asked word ranges of each text."""
    def run(batches):
        for batch in batches:
            for row, text, spans in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                words = word_hashes(text).astype(np.uint32)
                for at in range(0, len(spans), 1000):
                    part = spans[at:at + 1000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * len(part), pa.int64()), pa.array([x["lo"] for x in part], pa.int32()),
                        pa.array([x["hi"] for x in part], pa.int32()),
                        pa.array([words[x["lo"]:x["hi"]].tobytes() for x in part], pa.binary())], names=SLICES.names)

    return asked.mapInArrow(run, SLICES)


def _passage_rows(ready: DataFrame, s: Settings) -> DataFrame:
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, 6):
                columns = [batch.column(i).to_pylist() for i in range(8)]
                made = []
                for _, _, lo, other_lo, here, there, words, others in zip(*columns):
                    chain = [(a - lo, b - other_lo) for a, b in zip(here, there)]
                    made.append(_blocks(chain, np.frombuffer(words, np.uint32), np.frombuffer(others, np.uint32), s.k))
                rows = [
                    (row, other, p[0] + lo, p[1] + lo, p[2] + other_lo, p[3] + other_lo, p[4])
                    for row, other, lo, other_lo, found in zip(*columns[:4], align_all(made, s)) for p in found]
                types = [pa.int64()] * 2 + [pa.int32()] * 5
                columns = zip(*rows) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=PASSAGES.names)

    return ready.mapInArrow(run, PASSAGES)


def find_passages(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Passages between rows of ``texts`` (``row`` long, unique; ``text``): ``row`` repeats what ``other`` has.

    ``other`` is the first row in order of ``row`` that has the seeds, so that it is always the smaller one.
    ``first``/``end`` and ``other_first``/``other_end`` are word positions (ends exclusive), ``equal`` counts
    equal words. ``texts`` is read more than once and should be a written table.
    """
    s = settings
    texts = texts.select("row", "text")
    rows = _seed_rows(texts, s)
    # a seed has one first place in a text, so that of its first text needs no look-up later
    firsts = rows.where("first = 1").groupBy("seed").agg(
        F.min("row").alias("other"), F.max("row").alias("last"), F.min_by("at", "row").alias("there"))
    firsts = written(firsts.where("other < last").drop("last"), "passage-seeds")
    held = written(rows.drop("first").join(firsts.hint("merge"), "seed"), "passage-matches")
    pairs = held.where("row <> other").groupBy("row", "other").agg(F.collect_list(F.struct("at", "there")).alias("m"))
    passages = _aligned(pairs.where(F.size("m") >= s.matches), texts, s)
    places = held.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "seed"))).alias("held"))
    places = written(places.join(_known(passages), "row", "left"), "passage-places")
    exact = written(_second_look(places, texts, s), "passages")
    fuzzy = _third_look(places.drop("known").join(_known(passages.unionByName(exact)), "row", "left"), texts, s)
    return passages.unionByName(exact).unionByName(fuzzy)


def _aligned(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The passages that chains of the pairs' matches ``m`` give."""
    pairs = pairs.select("row", "other", F.col("m.at").alias("here"), F.col("m.there").alias("there"))
    found = written(_chain_rows(pairs, s), "passage-chains")
    slices = _slices(found.select("row", "lo", "hi").unionByName(found.select(
        F.col("other").alias("row"), F.col("other_lo").alias("lo"), F.col("other_hi").alias("hi"))), texts)
    there = slices.select(F.col("row").alias("other"), F.col("lo").alias("other_lo"),
                          F.col("hi").alias("other_hi"), F.col("words").alias("others"))
    ready = found.join(slices, ["row", "lo", "hi"]).join(there, ["other", "other_lo", "other_hi"])
    return written(_passage_rows(ready.select(
        "row", "other", "lo", "other_lo", "here", "there", "words", "others"), s), "passages")


#: Word ranges of texts go to the texts in shares of this size (of rows and ranges in memory), never the texts to them.
SENT_BYTES = 32 << 20
#: Neighbouring rows of 1 << _BLOCK_BITS are counted together and stay in one share.
_BLOCK_BITS = 10


def _shares(ranges: DataFrame, column: str) -> list[Column]:
    """Conditions on ``row`` that deal all rows into runs whose lists of ranges are sent together."""
    counted = ranges.groupBy(F.shiftright("row", _BLOCK_BITS).alias("block")).agg(
        F.sum(64 + 32 * F.size(column)).alias("bytes")).orderBy("block").collect()  # a row for each 1,024 texts
    cuts, size = [], 0
    for r in counted:
        if size and size + r["bytes"] > SENT_BYTES:
            cuts.append(r["block"] << _BLOCK_BITS)
            size = 0
        size += r["bytes"]
    if not cuts:
        return [F.lit(True)]
    inner = [(F.col("row") >= a) & (F.col("row") < b) for a, b in zip(cuts, cuts[1:])]
    return [F.col("row") < cuts[0], *inner, F.col("row") >= cuts[-1]]


def _in_shares(texts: DataFrame, ranges: DataFrame, column: str, how: str, use: Callable[[DataFrame], DataFrame],
               label: str, codec: str = "snappy") -> DataFrame:
    """``use`` of the texts joined with their ``ranges`` (lists by ``row``), a share at a time.

    Texts are written in order of ``row``, so a share reads its part of them; they are not shuffled.
    """
    path = scratch(texts.sparkSession, label)
    for share in _shares(ranges, column):
        made = use(texts.where(share).join(F.broadcast(ranges.where(share)), "row", how))
        made.write.mode("append").option("compression", codec).parquet(path)
    return texts.sparkSession.read.schema(made.schema).parquet(path)


def _slices(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """Word hashes of the asked ranges (``row``, ``lo``, ``hi``) of the texts."""
    spans = asked.distinct().groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return _in_shares(texts, written(spans, "passage-spans"), "spans", "inner",
                      lambda rows: _slice_rows(rows.select("row", "text", "spans")), "passage-slices")


def _known(passages: DataFrame) -> DataFrame:
    return passages.groupBy("row").agg(F.collect_set(F.struct("first", "end")).alias("known"))


def _second_look(places: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Exact passages of documents that share more with each other than with their seeds' first documents."""
    runs = written(_open_runs(places.select("row", F.col("held.at").alias("ats"), "known"), s), "passage-runs")
    one = runs.select("row", F.explode("runs").alias("r")).select("row", F.col("r.first").alias("lo"), F.col("r.end").alias("hi"))
    grams = written(_run_rows(_slices(one, texts), s).distinct(), "passage-runs")
    firsts = grams.groupBy("seed").agg(F.min("row").alias("other"), F.max("row").alias("last"), F.min_by("at", "row").alias("there"))
    firsts = written(firsts.where("other < last").drop("last"), "passage-run-seeds")
    matched = grams.join(firsts, "seed").where("row <> other")
    # neighbouring runs of one document on one diagonal are one passage
    order = Window.partitionBy("row", "other", F.col("at") - F.col("there")).orderBy("at")
    island = F.col("at") - F.row_number().over(order)
    islands = matched.select("row", "other", "at", "there", island.alias("island"))
    found = islands.groupBy("row", "other", F.col("at") - F.col("there"), "island").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.min("there").alias("other_first"))
    # a text that goes round in circles is a passage from every word on: of such neighbours one in ``least`` will do
    order = Window.partitionBy("row", "other", F.col("first") == F.col("last")).orderBy("first")
    circle = found.withColumn("circle", F.col("first") - F.row_number().over(order))
    order = Window.partitionBy("row", "other", F.col("first") == F.col("last"), "circle")
    kept = circle.withColumns({"begin": F.min("first").over(order), "close": F.max("first").over(order)}).where(
        (F.col("first") < F.col("last")) | ((F.col("first") - F.col("begin")) % s.least == 0) | (F.col("first") == F.col("close")))
    size = F.col("last") - F.col("first") + s.least
    return kept.select("row", "other", "first", (F.col("first") + size).alias("end"), "other_first",
                       (F.col("other_first") + size).alias("other_end"), size.alias("equal"))


def open_runs(places: list[int], known: list[tuple[int, int]], s: Settings) -> list[tuple[int, int]]:
    """Word ranges all of whose runs of ``least`` words could repeat and are not inside a known passage.

    Within a repeat, seeds are at most ``window`` words apart, and the first and last are that near its ends.
    """
    made = []
    at = 0
    while at < len(places):
        last = at
        while last + 1 < len(places) and places[last + 1] - places[last] <= s.window:
            last += 1
        start, stop = max(0, places[at] - s.window + 1), places[last] + s.k + s.window - 1 - s.least
        for a, b in sorted(known):  # starts of runs between the known passages
            if a <= stop and b - s.least >= start:
                if a > start:
                    made.append((start, a - 1 + s.least))
                start = max(start, b - s.least + 1)
        if start <= stop:
            made.append((start, stop + s.least))
        at = last + 1
    return made


def _open_runs(places: DataFrame, s: Settings) -> DataFrame:
    schema = "row long, runs array<struct<first:int,end:int>>"

    def run(batches):
        for batch in batches:
            rows, runs = [], []
            for row, ats, known in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = open_runs(ats, [(k["first"], k["end"]) for k in known or []], s)
                if found:
                    rows.append(row)
                    runs.append([{"first": a, "end": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))], names=["row", "runs"])

    return places.select("row", "ats", "known").mapInArrow(run, schema)


def _run_rows(slices: DataFrame, s: Settings) -> DataFrame:
    """Hashes of all runs of ``least`` words of the slices."""
    schema = "seed long, row long, at int"

    def run(batches):
        for batch in batches:
            for row, lo, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                words = np.frombuffer(words, np.uint32)
                if len(words) >= s.least:
                    grams = _grams(words.astype(np.uint64), s.least)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(grams.view(np.int64)), pa.array(np.full(len(grams), row, np.int64)),
                        pa.array(np.arange(lo, lo + len(grams), dtype=np.int32))], names=["seed", "row", "at"])

    return slices.mapInArrow(run, schema)


def stretches(ats: np.ndarray, keys: np.ndarray, known: list[tuple[int, int]],
              s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, words from first to last seed) of a document's pairs of seeds that known passages do not
    cover, each key once; ``ats`` are their positions in order."""
    first = np.searchsorted(ats, ats + s.apart)
    n = np.searchsorted(ats, ats + s.apart + s.spread, side="right") - first
    left = np.repeat(np.arange(len(ats)), n)
    right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    at, last = ats[left], ats[right]
    outside = np.ones(len(at), bool)
    for a, b in _merged(known):
        i, j = np.searchsorted(at, a), np.searchsorted(at, b)
        outside[i:j] &= last[i:j] + s.k > b
    made, once = np.unique(_mix(keys[left] * _BASE + keys[right])[outside], return_index=True)
    return made, at[outside][once], (last - at)[outside][once]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    made: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if made and a <= made[-1][1]:
            made[-1] = (made[-1][0], max(b, made[-1][1]))
        else:
            made.append((a, b))
    return made


#: Bits that hold a stretch's length beside its start in one long.
_SPAN_BITS = 12


def _stretch_rows(places: DataFrame, s: Settings) -> DataFrame:
    def run(batches):
        for batch in batches:
            made = [[np.zeros(0, kind)] for kind in (np.uint64, np.int64, np.int64)]
            for row, held, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                held = held.values
                key, at, span = stretches(
                    held.field("at").to_numpy().astype(np.int64), held.field("seed").to_numpy().view(np.uint64),
                    [(k["first"], k["end"]) for k in known.as_py() or []], s)
                for column, x in zip(made, (key, np.full(len(key), row), at << _SPAN_BITS | span)):
                    column.append(x)
            key, row, place = (np.concatenate(c) for c in made)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(row), pa.array(place)], names=["seed", "row", "place"])

    return places.select("row", "held", "known").mapInArrow(run, "seed long, row long, place long")


def _third_look(places: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Fuzzy passages of documents that the first holders of their seeds have in part only.

    Both seeds of a stretch make a match with its first holder; a holder of both has a passage's length between them.
    """
    grams = written(_stretch_rows(places, s), "passage-stretches")
    firsts = grams.groupBy("seed").agg(F.min("row").alias("other"), F.max("row").alias("last"), F.min_by("place", "row").alias("there"))
    firsts = firsts.where("other < last").drop("last")
    linked = grams.join(firsts, "seed").where("other < row")
    start, span = (lambda c: F.shiftright(c, _SPAN_BITS)), (lambda c: F.col(c).bitwiseAND(F.lit((1 << _SPAN_BITS) - 1)))
    ends = F.explode(F.array(
        F.struct(start("place").cast("int").alias("at"), start("there").cast("int").alias("there")),
        F.struct((start("place") + span("place")).cast("int").alias("at"), (start("there") + span("there")).cast("int").alias("there"))))
    pairs = linked.select("row", "other", ends.alias("m")).groupBy("row", "other").agg(F.collect_set("m").alias("m"))
    return _aligned(pairs, texts, replace(s, cost=s.cost / 2)).distinct()  # both ends of a stretch make a chain


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, ``other_`` key, word ranges, ``equal_words``, ``similarity``): what a document repeats of an earlier one.

    "Earlier" is the order of the table. Passages of at least ``settings.least`` words that are equal word for
    word are all found, from their first occurrence on; of those with the asked share of equal words, the ones
    that share two kept seeds (README: measured recall). Documents without a row repeat nothing. NULL and empty texts and those of fewer words have no passages; NULL
    keys come back as NULL; repeated rows repeat the first of them; passages repeated within one text
    only are no rows; other columns are not read; an empty table gives no rows.
    """
    rows = written(docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
                   .withColumn("row", F.monotonically_increasing_id()), "passage-texts", "zstd")
    found = find_passages(rows, settings)
    keys = rows.select("row", "key")
    named = found.join(keys.withColumnRenamed("key", key), "row").join(
        keys.select(F.col("row").alias("other"), F.col("key").alias(f"other_{key}")), "other")
    longest = F.greatest(F.col("end") - F.col("first"), F.col("other_end") - F.col("other_first"))
    return named.select(key, f"other_{key}", "first", "end", "other_first", "other_end",
                        F.col("equal").alias("equal_words"), (F.col("equal") / longest).alias("similarity"))


def without_repeats(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every repeated passage cut out of ``text`` but where it stands first in the table.

    All columns stay. A document that nothing is left of but white space and punctuation goes; one that
    had no word before stays. Repeats within one document stay.
    """
    names = docs.columns
    others = [c for c in names if c != text]
    doc = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.lit(True)
    rows = written(docs.select(doc.alias("doc"), F.col(text).alias("text"))
                   .withColumn("row", F.monotonically_increasing_id()), "passage-texts", "zstd")
    cuts = written(find_passages(rows, settings).groupBy("row").agg(
        F.collect_list(F.struct("first", "end")).alias("cuts")), "passage-cuts")

    def start():
        def apply(texts, spans):
            made = [cut_out(t, [(x["first"], x["end"]) for x in s]) if s else t
                    for t, s in zip(utf8(texts), spans.to_pylist())]
            left = [not s or bool(WORD.search(t)) for t, s in zip(made, spans.to_pylist())]
            return [pa.array(made, pa.binary()).cast(pa.string()), pa.array(left)]

        return apply

    def cut(marked: DataFrame) -> DataFrame:
        made = append_columns(marked.select("text", "doc", "cuts"), ["text", "cuts"], [
            StructField("text", StringType()), StructField("left", BooleanType())], start)
        return made.where("left").select("text", "doc")

    left = _in_shares(rows, cuts, "cuts", "left", cut, "passage-left", "zstd")
    return left.select(*(F.col("text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in names))


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given word ranges (ends exclusive); what separates words around a cut stays once."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for first, end in sorted(spans):
        start, stop = places[first][0], places[end][0] if end < len(places) else len(text)
        if start > at:
            kept.append(text[at:start])
        at = max(at, stop)
    kept.append(text[at:])
    return b"".join(kept)
