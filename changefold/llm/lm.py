"""Scoring documents with a log-bilinear language model trained by noise-contrastive estimation.

Two words back predict the next: the sum of their vectors, weighted by place, times the vector of the next
word plus its bias. The model's outcomes are the most frequent tokens and, for all others, classes by
their last bytes; within a class a token has its smoothed share of the class. Training contrasts each
token with shared noise drawn from the unigram distribution, first on a small sample, then in one pass
over all training tokens in which every task trains its own copy; the copies are averaged by tokens.
Normalising needs no pass over the outcomes per token: over two additive contexts the sum of
exponentials is itself a matrix product, done once in blocks for all pairs of contexts.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DoubleType, LongType, StructField, StructType,
)

from .common import append_columns, held, pieces, remainder, utf8, written

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
END = b""  # no word is empty
SMOOTH = 0.1


def tokens_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space, then the end."""
    words = text.translate(LOWER).split() if text else []
    words.append(END)
    return words


def held_out(key: str, part: int = 0, modulus: int = 10):
    """Whether a document's key keeps it from training; a NULL key does."""
    return F.coalesce(remainder(key, modulus) == part, F.lit(True))


def count_tokens(docs: DataFrame, text: str = "text", room: int = 200_000) -> DataFrame:
    """(``token``, ``n``) over all of ``docs``; tasks count up to ``room`` different tokens before they hand them on."""
    def run(batches):
        found: Counter = Counter()

        def counted():
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["token", "n"])
            found.clear()
            return made

        for batch in batches:
            for piece in pieces(batch, 0):
                found.update(chain.from_iterable(map(tokens_of, utf8(piece.column(0)))))
                if len(found) >= room:
                    yield counted()
        yield counted()

    schema = StructType([StructField("token", BinaryType()), StructField("n", LongType())])
    return docs.select(text).mapInArrow(run, schema).groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What tasks know of the token counts: the most frequent tokens, and totals of all and of each class."""
    head: list[bytes]       # most frequent first; the first ``outcomes`` are outcomes of their own
    counts: np.ndarray
    cut: int                # greatest size class that is not whole in the head
    outcomes: int
    classes: int
    total: int              # tokens
    distinct: int
    class_mass: np.ndarray  # smoothed count of each class, one unseen token included

    def prepare(self) -> None:
        self.index = {t: i for i, t in enumerate(self.head)}
        self.outcome = np.array(
            [i if i < self.outcomes else self.class_of(t) for i, t in enumerate(self.head)], np.int32)
        self.unigram = np.concatenate([self.counts[:self.outcomes], self.class_mass]).astype(np.float64)
        self.unigram /= self.unigram.sum()

    def class_of(self, token: bytes) -> int:
        return self.outcomes + zlib.crc32(token[-2:]) % self.classes

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Outcomes and head ranks (-1 beyond it) of all tokens, the texts' first places, rare tokens by text."""
        lists = [tokens_of(t) for t in texts]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        ranks = np.fromiter(map(self.index.get, chain.from_iterable(lists), _MINUS), np.int64, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        out = np.where(ranks >= 0, self.outcome[ranks] if len(self.outcome) else 0, 0).astype(np.int32)
        rare: list[list[bytes]] = [[] for _ in lists]
        places = np.flatnonzero(ranks < 0)
        owners = np.searchsorted(starts, places, side="right") - 1
        for place, owner in zip(places.tolist(), owners.tolist()):
            token = lists[owner][place - int(starts[owner])]
            rare[owner].append(token)
            out[place] = self.class_of(token)
        return out, ranks, starts, rare


class _Endless:
    """-1 for ever, as the default of ``dict.get`` in ``map``."""
    def __iter__(self):
        return self

    def __next__(self):
        return -1


_MINUS = _Endless()


#: Least and most outcomes of a model. The table of normalisers has a float for every pair of contexts, so 4,096
#: outcomes with 256 classes take 76 MB in a Python worker.
OUTCOMES = (256, 4096)


def sizes_for(distinct: int) -> tuple[int, int]:
    """Outcomes and classes of a model: twice the root of the number of different training tokens, and a sixteenth of that."""
    outcomes = min(max(2 * math.isqrt(distinct), OUTCOMES[0]), OUTCOMES[1])
    return outcomes, outcomes // 16


def size_class():
    """64 classes to each power of e."""
    return F.floor(F.log("n") * 64).alias("size")


_BINS = 1 << 16


def lexicon(counts: DataFrame, outcomes: int | None = None, classes: int | None = None, head: int = 250_000) -> Lexicon:
    """The bounded part of the counts that is sent to tasks: at most ``head`` tokens, the most frequent ones.

    They are found by a histogram of the counts' logarithms, so tasks send the driver no more than these. Of the
    last class of sizes, which may hold more tokens than there is room for, those with the least hashes are
    taken. Outcomes and classes follow the number of different tokens unless given.
    """
    sizes = {r.size: r.types for r in counts.groupBy(size_class()).agg(F.count(F.lit(1)).alias("types")).collect()}
    distinct = sum(sizes.values())
    outcomes = sizes_for(distinct)[0] if outcomes is None else outcomes
    classes = max(1, sizes_for(distinct)[1]) if classes is None else classes
    cut, held = -1, 0  # all of greater size are in the head
    for size in sorted(sizes, reverse=True):
        if held + sizes[size] > head:
            cut = size
            break
        held += sizes[size]
    taken = size_class() > cut
    if cut >= 0:
        place = F.pmod(F.xxhash64("token"), F.lit(_BINS))
        bins = {r.bin: r.types for r in counts.where(size_class() == cut).groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("types")).collect()}
        below = 0
        for below in range(_BINS):
            held += bins.get(below, 0)
            if held > head:
                break
        taken |= (size_class() == cut) & (place < below)
    top = counts.where(taken).toArrow()
    share = F.pmod(F.crc32(F.expr("substring(token, -2, 2)")), F.lit(classes))
    sums = {r["class"]: (r["n"], r.types) for r in
            counts.groupBy(share.alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()}
    pairs = sorted(zip(top.column("n").to_pylist(), top.column("token").to_pylist()), key=lambda x: (-x[0], x[1]))
    tokens, n = [t for _, t in pairs], np.array([n for n, _ in pairs], np.int64)
    outcomes = min(outcomes, len(tokens))
    within = np.zeros((classes, 2))
    for c, (total, types) in sums.items():
        within[c] = total, types
    for token, count in zip(tokens[:outcomes], n[:outcomes].tolist()):
        within[zlib.crc32(token[-2:]) % classes] -= count, 1
    return Lexicon(tokens, n, cut, outcomes, classes, int(sum(t for t, _ in sums.values())),
                   int(sum(t for _, t in sums.values())), within[:, 0] + SMOOTH * (within[:, 1] + 1))


class Model:
    """Parameters and training. Contexts are outcomes, plus one for the places before a text."""

    def __init__(self, unigram: np.ndarray, size: int = 32, seed: int = 7):
        random = np.random.default_rng(seed)
        n = len(unigram)
        self.unigram = unigram
        self.R = random.normal(0, 0.1, (n + 1, size)).astype(np.float32)
        self.Q = random.normal(0, 0.1, (n, size)).astype(np.float32)
        self.C = np.ones((2, size), np.float32)
        self.b = np.log(unigram).astype(np.float32)
        self.speed = [np.full(x.shape[:1], 1e-2, np.float32) for x in (self.R, self.Q, self.C, self.b)]

    def vector(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.R, self.Q, self.C, self.b)])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for x in (self.R, self.Q, self.C, self.b):
            x[...] = vector[at:at + x.size].reshape(x.shape)
            at += x.size

    def contexts(self, out: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The outcomes one and two places before each token of each text."""
        before = np.int32(len(self.unigram))
        one, two = np.empty_like(out), np.empty_like(out)
        one[1:], two[2:] = out[:-1], out[:-2]
        one[starts] = before
        two[starts] = before
        second = starts + 1
        two[second[second < len(out)]] = before
        return one, two

    def train(self, out: np.ndarray, starts: np.ndarray, rate: float, random: np.random.Generator,
              batch: int = 2048, noise: int = 32) -> None:
        """One pass in random order: each token against ``noise`` draws that its batch shares."""
        one, two = self.contexts(out, starts)
        ladder = np.cumsum(self.unigram)
        offset = (np.log(self.unigram) + np.log(noise)).astype(np.float32)
        order = random.permutation(len(out))
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            a, b, w = one[own], two[own], out[own]
            drawn = np.minimum(np.searchsorted(ladder, random.random(noise)), len(ladder) - 1)
            ra, rb = self.R[a], self.R[b]
            context = ra * self.C[0] + rb * self.C[1]
            target, others = self.Q[w], self.Q[drawn]
            up = _sigmoid(offset[w] - np.einsum("ij,ij->i", context, target) - self.b[w])
            down = -_sigmoid(context @ others.T + self.b[drawn] - offset[drawn])
            back = up[:, None] * target + down @ others
            scale = np.float32(1.0 / len(own))
            self._step(1, self.Q, np.concatenate([w, drawn]), np.concatenate([up[:, None] * context, down.T @ context]), rate)
            self._step(3, self.b, np.concatenate([w, drawn]), np.concatenate([up, down.sum(axis=0)]), rate)
            self._step(0, self.R, np.concatenate([a, b]), np.concatenate([back * self.C[0], back * self.C[1]]), rate)
            self._step(2, self.C, np.array([0, 1]), np.stack([(back * ra).sum(axis=0), (back * rb).sum(axis=0)]) * scale, rate * 0.1)

    def _step(self, which: int, x: np.ndarray, rows: np.ndarray, up: np.ndarray, rate: float) -> None:
        """Add gradients to the rows they belong to, each row at its own falling speed."""
        order = np.argsort(rows, kind="stable")
        own, first = np.unique(rows[order], return_index=True)
        total = np.add.reduceat(up[order], first, axis=0)
        speed = self.speed[which]
        speed[own] += (total * total).mean(axis=1) if total.ndim > 1 else total * total
        step = np.float32(rate) / np.sqrt(speed[own])
        x[own] += total * (step[:, None] if total.ndim > 1 else step)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Scorer:
    """Normalised log-probabilities of a trained model."""

    def __init__(self, R: np.ndarray, Q: np.ndarray, C: np.ndarray, b: np.ndarray, log_z: np.ndarray | None = None, block: int = 256):
        self.one, self.two, self.Q, self.b = R * C[0], R * C[1], Q, b
        if log_z is None:
            right = self.two @ Q.T  # one row per second context
            right += b
            top_two = right.max(axis=1)
            right -= top_two[:, None]
            np.exp(right, out=right)
            log_z = np.empty((len(R), len(R)), np.float32)
            for at in range(0, len(R), block):
                left = self.one[at:at + block] @ Q.T
                top_one = left.max(axis=1, keepdims=True)
                sums = np.maximum(np.exp(left - top_one) @ right.T, np.float32(1e-37))
                log_z[at:at + block] = np.log(sums) + top_one + top_two
        self.log_z = log_z

    def log_probability(self, one: np.ndarray, two: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Natural logarithms of the outcomes' probabilities after their two contexts."""
        fit = np.empty(len(out), np.float32)
        for at in range(0, len(out), 1 << 15):
            own = slice(at, at + (1 << 15))
            fit[own] = np.einsum("ij,ij->i", self.one[one[own]] + self.two[two[own]], self.Q[out[own]])
        return (fit + self.b[out] - self.log_z[one, two]).astype(np.float64)


def draw_texts(docs: DataFrame, text: str, total: int, wanted: int, longest: int = 4 << 20) -> list[bytes]:
    """Different texts of about ``wanted`` tokens, at most 100 bytes for each of these, in an order of their own.

    Texts are drawn by their hash and made distinct, so copies count once; where that gives too little (most
    rows are copies) or too much (few long texts), they are drawn again at another rate. Texts of more than
    ``longest`` bytes are left to the training on all rows.
    """
    draw = F.shiftrightunsigned(F.xxhash64(text), 11) / F.lit(2.0 ** 53)
    some = docs.select(text).where(F.octet_length(text).between(1, longest))
    share, best = min(1.0, wanted / total), None
    for _ in range(8):
        drawn = some.where(draw < share).distinct()
        size = drawn.agg(F.sum(F.octet_length(text))).first()[0] or 0
        if size > 100 * wanted:
            share *= 8 * wanted / size
            if best is not None:
                break
            continue
        best = drawn
        if size >= 2 * wanted or share >= 1:
            break
        share = min(1.0, share * 8)
    return [] if best is None else sorted(r[0].encode() for r in best.toLocalIterator())


def train_model(docs: DataFrame, words: Lexicon, text: str = "text", size: int = 32, sample_tokens: int = 300_000,
                epochs: int = 3, rate: float = 0.1) -> tuple[np.ndarray, ...]:
    """Parameters (R, Q, C, b) trained on all of ``docs``.

    A sample of about ``sample_tokens`` starts the vectors, so that the copies which tasks then train on
    their own share of all tokens can be averaged. Copies are added up in rounds of sixteen.
    """
    spark = docs.sparkSession
    words.prepare()
    model = Model(words.unigram, size)
    random = np.random.default_rng(11)
    if words.total:
        sample = draw_texts(docs, text, words.total, sample_tokens)
        if sample:
            out, _, starts, _ = words.encode(sample)
            for _ in range(epochs):
                model.train(out, starts, rate, random)
    sent = spark.sparkContext.broadcast((words, model))

    def run(batches):
        own_words, own = sent.value
        own_words.prepare()
        draws, seen = np.random.default_rng(13), 0
        for batch in batches:
            for piece in pieces(batch, 0):
                out, _, starts, _ = own_words.encode(utf8(piece.column(0)))
                own.train(out, starts, rate * 0.5, draws)
                seen += len(out)
        if seen:
            yield pa.RecordBatch.from_pydict({
                "tokens": [seen], "vector": [(own.vector().astype(np.float64) * seen).tobytes()]})

    def add(batches):
        total, seen = None, 0
        for batch in batches:
            for n, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                vector = np.frombuffer(vector)
                total, seen = vector if total is None else total + vector, seen + n
        if seen:
            yield pa.RecordBatch.from_pydict({"tokens": [seen], "vector": [total.tobytes()]})

    schema = StructType([StructField("tokens", LongType()), StructField("vector", BinaryType())])
    copies = written(docs.select(text).mapInArrow(run, schema), "lm-copies")
    while (n := copies.count()) > 16:
        copies = written(copies.repartition(-(-n // 16)).mapInArrow(add, schema), "lm-copies")
    total, seen = 0.0, 0
    for r in copies.toLocalIterator():
        total, seen = total + np.frombuffer(r.vector), seen + r.tokens
    if seen:
        model.load((total / seen).astype(np.float32))
    return model.R, model.Q, model.C, model.b


PARTS = [
    StructField("n_tokens", LongType()), StructField("known_head", LongType()), StructField("base_head", DoubleType()),
    StructField("score_head", DoubleType()), StructField("rare", ArrayType(StructType([
        StructField("token", BinaryType()), StructField("times", LongType())]))),
]


def score_documents(docs: DataFrame, train: DataFrame, key: str = "doc_id", text: str = "text", head: int = 250_000,
                    outcomes: int | None = None, classes: int | None = None, size: int = 32) -> DataFrame:
    """(key, other columns of ``docs`` but the text) with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Counts and model come from all of ``train``; both scores are log10 of whole texts, the end included.
    The ``head`` most frequent tokens are known to every task; counts of rarer ones are joined, one row per
    text and token. Outcomes and classes grow with the training tokens (``sizes_for``). NULL and empty texts are an end only; rows are scored one by one, whatever their
    key; columns named like the results are replaced; without training text every token has the base
    probability 1 of the one unseen token.
    """
    spark = docs.sparkSession
    counts = written(count_tokens(train, text), "lm-counts")
    words = lexicon(counts, outcomes, classes, head)
    R, Q, C, b = train_model(train, words, text, size)
    scorer = Scorer(R, Q, C, b)
    sent = spark.sparkContext.broadcast((words, (R, Q, C, b), scorer.log_z))
    number = uuid.uuid4().hex  # another model for every call, also within one session

    def start():
        def build():
            words_, (r, q, c, bias), log_z = sent.value
            words_.prepare()
            return words_, Model(words_.unigram, 1), Scorer(r, q, c, bias, log_z)

        own, model, scores = held(("lm", number), build)
        nothing = np.log10(own.total + SMOOTH * (own.distinct + 1))
        log_counts = np.log10(own.counts + SMOOTH)
        # a class token's share, its own count aside
        share = np.concatenate([np.zeros(own.outcomes), -np.log10(own.class_mass)])

        def apply(texts):
            out, ranks, starts, rare = own.encode(utf8(texts))
            if not len(out):
                return [pa.array([], f) for f in PART_TYPES]
            known = ranks >= 0
            log_count = np.where(known, log_counts[ranks] if len(log_counts) else 0.0, 0.0)
            one, two = model.contexts(out, starts)
            p = scores.log_probability(one, two, out) / np.log(10) + share[out]
            p += np.where(out >= own.outcomes, log_count, 0.0)
            lengths = np.diff(np.append(starts, len(out)))
            tails = [[{"token": t, "times": n} for t, n in Counter(r).items()] for r in rare]
            return [pa.array(lengths), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(log_count - nothing, starts)), pa.array(np.add.reduceat(p, starts)),
                    pa.array(tails, PART_TYPES[4])]

        return apply

    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    others = [c for c in docs.columns if c != text and c.lower() not in results]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), F.col(text).alias("text"))
    parts = append_columns(rows, ["text"], PARTS, start).drop("text").withColumn("id", F.monotonically_increasing_id())
    parts = written(parts, "lm-parts")
    rare = parts.select("id", F.explode("rare").alias("r")).select("id", "r.token", "r.times")
    found = rare.join(counts.where(size_class() <= words.cut), "token", "left")
    n = F.coalesce("n", F.lit(0))
    sums = found.groupBy("id").agg(
        F.sum(F.col("times") * F.log10(n + F.lit(SMOOTH))).alias("log_counts"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"))
    joined = parts.drop("rare").join(sums, "id", "left")
    more, known = F.coalesce("log_counts", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return joined.select(
        "row.*", "n_tokens", (F.col("known_head") + known).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base_head") + more).alias("base_score"), (F.col("score_head") + more).alias("score"))


PART_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.float64(),
              pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int64())]))]
