"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of variable order: for every run of up to ``order`` bytes inside a word,
how often which byte followed. A byte's code length is taken at the longest context that has seen it, with
an escape probability d / (n + d) for each longer one (d distinct followers out of n), and 1/256 below
the empty context. Contexts start at the blank before a word, so that a word's code length depends on
the word alone, and a text's is the sum over its words. The statistics are frozen after training.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from .common import append_columns, held, remainder

#: ASCII other than letters separates words; A-Z cannot occur after lowering.
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
UNDETERMINED = "und"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text; none if it has no letter."""
    words = (text or "").lower().encode().translate(LETTERS).split()
    if any(w[0] < 0x80 or w[-1] < 0x80 for w in words) or any(c.isalpha() for c in text or ""):
        return words
    return []


class ContextTree:
    """Byte followers of every context of up to ``order`` bytes within the words of one language."""

    def __init__(self, texts: list[str], order: int):
        self.order = order
        followers: dict[bytes, Counter] = {}
        for word, n in Counter(chain.from_iterable(map(words_of, texts))).items():
            line = b" " + word + b" "
            for i in range(1, len(line)):
                for k in range(min(order, i) + 1):
                    followers.setdefault(line[i - k:i], Counter())[line[i]] += n
        self.counts = {c: (dict(f), sum(f.values()), len(f)) for c, f in followers.items()}

    def code_length(self, context: bytes, byte: int) -> float:
        """Bits for ``byte`` after ``context``, escaping to shorter contexts until one has seen it."""
        bits = 0.0
        for k in range(len(context) + 1):
            found = self.counts.get(context[k:])
            if found is None:
                continue  # a context never seen escapes at no cost
            seen, total, distinct = found
            n = seen.get(byte)
            if n is not None:
                return bits - log2(n / (total + distinct))
            bits -= log2(distinct / (total + distinct))
        return bits + 8.0


class Classifier:
    """Code lengths of whole texts under every language's frozen tree."""

    def __init__(self, samples: dict[str, list[str]], order: int = 4, room: int = 500_000):
        self.order, self.room = order, room
        self.languages = sorted(samples)
        self.trees = [ContextTree(samples[x], order) for x in self.languages]
        self._grams: dict[bytes, int] = {}
        self._gram_bits = np.zeros((1024, len(self.trees)))
        self._words: dict[bytes, int] = {}
        self._word_bits = np.zeros((1024, len(self.trees)))

    def _gram(self, gram: bytes) -> int:
        """Row of the code lengths of a gram's last byte after the bytes before it."""
        at = self._grams.get(gram)
        if at is None:
            at = self._grams[gram] = len(self._grams)
            if at == len(self._gram_bits):
                self._gram_bits = np.vstack([self._gram_bits, np.zeros_like(self._gram_bits)])
            self._gram_bits[at] = [t.code_length(gram[:-1], gram[-1]) for t in self.trees]
        return at

    def _learn(self, words: list[bytes]) -> None:
        """Code lengths of new words: the sum over their bytes, each after its context."""
        span = self.order + 1
        rows, ends = [], [0]
        grams = self._grams
        for word in words:
            line = b" " + word + b" "
            for i in range(2, len(line) + 1):
                gram = line[max(0, i - span):i]
                at = grams.get(gram)
                rows.append(self._gram(gram) if at is None else at)
            ends.append(len(rows))
        bits = np.add.reduceat(self._gram_bits[rows], ends[:-1], axis=0)
        start = len(self._words)
        need = start + len(words)
        while need > len(self._word_bits):
            self._word_bits = np.vstack([self._word_bits, np.zeros_like(self._word_bits)])
        self._word_bits[start:need] = bits
        self._words.update(zip(words, range(start, need)))

    def code_lengths(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under each language, and each text's number of words."""
        if len(self._words) > self.room or len(self._grams) > self.room:
            self._words.clear()
            self._grams.clear()
        lists = [words_of(t) for t in texts]
        new = set().union(*lists).difference(self._words.keys()) if lists else set()
        if new:
            self._learn(list(new))
        lengths = np.array([len(x) for x in lists], np.int64)
        rows = np.fromiter(map(self._words.__getitem__, chain.from_iterable(lists)), np.int64, int(lengths.sum()))
        bits = np.zeros((len(lists), len(self.trees)))
        some = np.flatnonzero(lengths)
        if len(some):
            starts = np.concatenate([[0], np.cumsum(lengths[some])[:-1]])
            for i in range(len(self.trees)):
                bits[some, i] = np.add.reduceat(self._word_bits[rows, i], starts)
        return bits, lengths

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of the shortest code (ties: first by name) and its share 2^-bits of all languages'."""
        bits, lengths = self.code_lengths(texts)
        made = []
        for row, n in zip(bits, lengths):
            if not n or not self.trees:
                made.append((UNDETERMINED, 0.0))
                continue
            best = int(np.argmin(row))
            made.append((self.languages[best], float(1.0 / np.sum(np.exp2(row[best] - row)))))
        return made


def training_sample(docs: DataFrame, text: str = "text", lang: str = "lang",
                    sample_bytes: int = 1 << 20, languages: int = 200) -> dict[str, list[str]]:
    """Texts by language, near ``sample_bytes`` of UTF-8 for each, drawn evenly by a hash from the different texts.

    The trees are fitted on this bounded sample. Copies of a text count once; of a text longer than
    ``sample_bytes`` its first characters are drawn. A language whose draw falls short of half of what it could
    be is drawn again at a higher rate. At most ``languages`` languages may be learned; more raise an error
    rather than being dropped.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    hashed = rows.select("lang", F.xxhash64("text").alias("hash"), F.octet_length("text").cast("long").alias("size")).distinct()
    found = {r.lang: r.size for r in hashed.groupBy("lang").agg(F.sum("size").alias("size")).limit(languages + 1).collect()}
    if len(found) > languages:
        raise ValueError(f"more than {languages} languages")
    draw = F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(2.0 ** 53)
    rates = {name: min(1.0, sample_bytes / max(1, size)) for name, size in found.items()}
    samples: dict[str, list[str]] = {}
    short = rates
    while short:
        rate = F.lit(-1.0)
        for name in short:
            rate = F.when(F.col("lang") == name, rates[name]).otherwise(rate)
        samples |= {name: [] for name in short}
        drawn = rows.where(draw < rate).select("lang", F.substring("text", 1, sample_bytes).alias("text"))
        for r in drawn.distinct().toLocalIterator():
            samples[r.lang].append(r.text)
        short = {name: rates[name] for name in short if rates[name] < 1.0
                 and 2 * sum(len(t.encode()) for t in samples[name]) < min(sample_bytes, found[name])}
        rates |= {name: min(1.0, 4 * rate) for name, rate in short.items()}
    return {name: sorted(texts) for name, texts in samples.items() if texts}


def identify(docs: DataFrame, samples: dict[str, list[str]], text: str = "text", order: int = 4) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the language whose frozen model codes the whole text shortest.

    A text without a letter (also NULL or empty) is ``und`` with score 0, and so is every text if nothing
    was learned. Repeated rows get equal results; columns named like the results are replaced; other
    columns, also a language label, are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(samples)

    def start():
        key = ("languages", order, hash(tuple((k, tuple(v)) for k, v in sorted(sent.value.items()))))
        model = held(key, lambda: Classifier(sent.value, order))

        def apply(texts):
            made = model.predict(texts.to_pylist())
            return [pa.array([x for x, _ in made], pa.string()), pa.array([s for _, s in made], pa.float64())]

        return apply

    return append_columns(docs, [text], [StructField("lang_pred", StringType()), StructField("score", DoubleType())], start)


def held_out(key: str, part: int = 2, modulus: int = 4):
    """Whether a document's key keeps it from training; a NULL key does."""
    return F.coalesce(remainder(key, modulus) == part, F.lit(True))
