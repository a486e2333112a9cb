"""Spelling variants of a vocabulary, found by pivotal grams.

The bigrams of a word are ordered by how many words have them, rare ones first. A word's prefix is its
three first bigrams in that order (with all that tie with the third); its pivots are two of them that
do not overlap, chosen by dynamic programming so that they are the rarest. One edit touches at most one of two
bigrams that do not overlap, so of two words one edit apart, the one whose prefix ends earlier in the
order has a pivot that is in the other's prefix, moved by at most one place. Pivots are joined
with prefixes on bigram, word length and place, so candidates are few; each is then checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import written

RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Edits allowed between variants; a gram has two letters.
EDITS, GRAM = 1, 2
PREFIX = GRAM * EDITS + 1
#: (length, place) of a pivot in the shorter, equal or longer word against the other word's gram.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def words_of(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 199) -> DataFrame:
    """One row (``word``) per letter run of the whole texts, only A-Z lower-cased.

    Where ``every`` divides the unsigned crc32 h of ``<key>:<run>``, the run loses its code point number
    h modulo its length. NULL texts have no runs; a NULL key is the empty text; ``every`` = 0 changes no run.
    """
    lowered = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(1))).alias("run"))
    if not every:
        return runs.select(F.col("run").alias("word"))
    h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(
        F.when(F.pmod(F.col("h"), F.lit(every)) == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(``word``, ``n``) of the words of at least so many code points that occur at least so often."""
    long_enough = words.where(F.char_length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def pivots(grams: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ``EDITS + 1`` grams of (rank, place) that do not overlap and have the least sum of ranks.

    Dynamic programming over the places: the best choice of m grams that ends before a place. Ties go to
    the earlier choice. Three different places hold two that are two apart, so there always is one.
    """
    grams = sorted(grams, key=lambda g: g[1])
    best: list[dict[int, tuple[int, list]]] = []  # by number of grams chosen, among the first i + 1
    for i, (rank, place) in enumerate(grams):
        before = max((j for j in range(i) if grams[j][1] <= place - GRAM), default=None)
        row = dict(best[-1]) if best else {0: (0, [])}
        earlier = best[before] if before is not None else {0: (0, [])}
        for m, (cost, chosen) in earlier.items():
            if m <= EDITS and (m + 1 not in row or cost + rank < row[m + 1][0]):
                row[m + 1] = (cost + rank, [*chosen, (rank, place)])
        best.append(row)
    return best[-1][EDITS + 1][1]


def split(word: str, rank: dict[str, int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(prefix, pivots) of a word of at least four letters: (rank, place) of its bigrams."""
    grams = sorted((rank[word[i:i + GRAM]], i) for i in range(len(word) - GRAM + 1))
    last = grams[PREFIX - 1][0]
    prefix = [g for g in grams if g[0] <= last]
    return prefix, pivots(prefix)


GRAMS = StructType([
    StructField("word", StringType()), StructField("length", IntegerType()), StructField("gram", LongType()),
    StructField("place", IntegerType()), StructField("last", LongType()), StructField("pivot", IntegerType())])


def _gram_ranks(vocabulary: DataFrame) -> dict[str, int]:
    """Every bigram's place in order of rarity; a bigram is two letters of a fixed alphabet, so they are few."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = vocabulary.select(F.explode(F.transform(places, lambda i: F.substr(F.col("word"), i, F.lit(GRAM)))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("words"))
    return {r["gram"]: i for i, r in enumerate(counted.orderBy("words", "gram").collect())}


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(``a``, ``b``), a < b: all pairs of different words one insertion, deletion or replacement apart.

    Words have at least four letters of the run alphabet; the (written) table is read twice.
    """
    ranks = vocabulary.sparkSession.sparkContext.broadcast(_gram_ranks(vocabulary))  # pairs of at most 90 letters

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        for batch in batches:
            rows: list[tuple] = []
            for word in batch.column(0).to_pylist():
                prefix, chosen = split(word, rank)
                last, size = prefix[-1][0], len(word)
                rows += [(word, size, gram, place, last, int((gram, place) in chosen)) for gram, place in prefix]
            yield pa.RecordBatch.from_pylist([dict(zip(GRAMS.names, r)) for r in rows], schema=_ARROW)

    grams = written(vocabulary.select("word").mapInArrow(run, GRAMS), "spelling-grams")
    shift = F.explode(F.array(*(F.struct(F.lit(a).alias("l"), F.lit(b).alias("p")) for a, b in SHIFTS))).alias("s")
    pivot = grams.where("pivot = 1").select("word", "length", "gram", "place", "last", shift).select(
        F.col("word").alias("a"), F.col("last").alias("a_last"), "gram",
        (F.col("length") + F.col("s.l")).alias("length"), (F.col("place") + F.col("s.p")).alias("place"))
    prefix = grams.select(F.col("word").alias("b"), F.col("last").alias("b_last"), "gram", "length", "place")
    met = pivot.join(prefix, ["gram", "length", "place"]).where("a_last <= b_last and a <> b")
    near = met.where(one_edit(F.col("a"), F.col("b")))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_ARROW = pa.schema([("word", pa.string()), ("length", pa.int32()), ("gram", pa.int64()), ("place", pa.int32()),
                    ("last", pa.int64()), ("pivot", pa.int32())])


def one_edit(a: Column, b: Column) -> Column:
    """Whether two different texts are at most one edit apart."""
    return F.levenshtein(a, b, EDITS) == EDITS


def variants(vocabulary: DataFrame, dominance: int = 5) -> DataFrame:
    """(``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``) of every (``word``, ``n``).

    A word's form is its near word of the largest n (ties: the smallest in code-point order) if that is at
    least ``dominance`` (2 or more) times its own, else NULL. The root follows forms to the last; counts
    grow with every step, so there is no cycle and few steps. Words with no near word have ``n_near`` 0; an
    empty vocabulary gives no rows.
    """
    vocabulary = written(vocabulary.select("word", "n"), "spelling-words")
    pairs = written(near_pairs(vocabulary), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("rank"), "b")).alias("best"))
    named = vocabulary.join(best, "word", "left").withColumn("form_n", -F.col("best.rank"))
    taken = F.col("form_n") >= dominance * F.col("n")
    named = named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.b")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n"))
    named = written(named, "spelling-forms")
    return named.join(_roots(named), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(named: DataFrame) -> DataFrame:
    """(``word``, ``root``) of the words with a form; every round doubles the steps taken."""
    steps = written(named.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = steps.join(further, "root", "left")
        moved = written(on.select("word", F.coalesce("further", "root").alias("root"),
                                  F.col("further").isNotNull().alias("moved")), "spelling-roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def group_spellings(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6,
                    least_count: int = 5, dominance: int = 5, every: int = 199) -> DataFrame:
    """Spelling variants among the words of whole texts: ``words_of``, ``vocabulary`` and ``variants`` in turn.

    NULL, empty and letterless texts add nothing; repeated rows count each time; other columns are not
    read; an empty table gives no rows. ``least_length`` is four at least.
    """
    if least_length < 2 * GRAM:
        raise ValueError("two bigrams that do not overlap need four letters")
    return variants(vocabulary(words_of(docs, key, text, every), least_length, least_count), dominance)
