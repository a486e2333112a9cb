"""Personal data by a skip-chain conditional random field.

Patterns find the certain spans. They are observed labels of a random field over the tokens of a text that hold
a digit or an ``@``; a token without either is no personal data, so chains break there. Neighbouring tokens share
transition potentials. Repeated or similar tokens anywhere in the document (equal numbers, numbers that
end alike, long ones one digit apart, mail addresses of one name, addresses of one network) share a potential
for having one kind. Loopy message passing over both then decides the tokens the patterns left open, as a
second card written right after the first, a phone number without its ``+``, or a card with a slip in it.

The weights are fitted piecewise to the patterns' own labels: what a token's shape says of its kind, what follows
a label, how often linked tokens agree. Each piece is an observation that Spark counts over all texts.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import append_columns, pieces

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# A match starts at the start of a run of digits or not at all, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HIT = re.compile(r"[0-9@][0-9A-Za-z@._%+()-]*")
_BEFORE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz._%+()-"
_NO_DIGIT = re.compile(r"[^0-9]+")
_LETTER = re.compile(r"[A-Za-z]")
_GAP = re.compile(r"[ ()./-]{1,2}\Z")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\Z")


def digits_of(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _is_card(text: str) -> bool:
    digits = digits_of(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _is_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def _emails(text: str) -> list[tuple[int, int]]:
    """Addresses from their ``@`` outwards, which gives the leftmost matches in linear time."""
    found, last, before = [], 0, 0
    for at in _DOMAIN.finditer(text):
        lower = max(last, before)
        before = at.start() + 1
        # an earlier @ ends the name; where there is none it starts after what was matched last
        name = text[lower:at.start()]
        name = name[name.rfind("@") + 1:]
        size = len(name) - len(name.rstrip(_LOCAL))
        if size:
            found.append((at.start() - size, at.end()))
            last = at.end()
    return found


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) the patterns give, by kind and start, and the places of matches their checks drop."""
    made = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    dropped = []
    for kind, pattern, check in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        for m in pattern.finditer(text):
            if check(m.group()):
                made.append((kind, *m.span()))
            elif kind > 1:
                dropped.append(m.span())
    return made, dropped


# -- tokens and links ----------------------------------------------------------------------------------

@dataclass
class Tokens:
    """The tokens of one text that hold a digit or an ``@``, in order.

    ``label`` is 0 for none, 1 + kind at a span's first token and 5 + kind at its further ones; ``base`` says
    whether a pattern gave it; ``vague`` whether it is no example of anything; ``beside`` whether the token
    follows its predecessor directly; ``links`` are pairs of linked tokens, the hub of their group first.
    """
    spans: list[tuple[int, int]]
    texts: list[str]
    shape: list[tuple[int, ...]]
    label: list[int]
    base: list[bool]
    vague: list[bool]
    beside: list[bool]
    links: list[tuple[int, int]]


#: Number of values of each part of a shape.
SIZES = (21, 3, 3, 5, 3, 3, 3, 3, 63)


def shape_of(token: str) -> tuple[int, ...]:
    """What the field sees of a token: digits, letters, ``@``, dots, first sign, hyphens, check digit, quad, and
    digits with letters together."""
    digits = digits_of(token)
    n, letters = min(len(digits), 20), min(len(_LETTER.findall(token[:64])), 3)
    letters = 0 if not letters else 1 if letters < 3 else 2
    at = 0 if "@" not in token else 1 if "." in token[token.rfind("@"):] else 2
    first = 1 if token[0] == "+" else 2 if token[0] == "(" else 0
    check = 0 if letters or not 13 <= len(digits) <= 19 else 1 if luhn(digits) else 2
    quad = 0 if not _QUAD.match(token) else 1 if _is_ip(token) else 2
    return (n, letters, at, min(token.count("."), 4), first, min(token.count("-"), 2), check, quad, 3 * n + letters)


def keys_of(token: str) -> Iterator[tuple]:
    """What a token has in common with similar ones."""
    if "@" in token:
        name = token[:token.find("@")].lower()
        if len(name) > 2:
            yield "name", name
        return
    if _LETTER.search(token):
        if len(token) > 7:
            yield "text", token
        return
    if token.count(".") == 3:
        yield "network", token[:token.rfind(".")]
        return
    digits = digits_of(token)
    if 3 <= len(digits) < 12:
        yield "digits", digits
    if 7 <= len(digits) < 16:
        yield "end", digits[-7:]
    if len(digits) > 11:
        yield "head", digits[:8]
        yield "tail", digits[-8:]


def one_digit_apart(a: str, b: str) -> bool:
    """Whether two numbers are equal or one replaced, missing or added digit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    return longer[same + 1:] == (shorter[same + 1:] if len(a) == len(b) else shorter[same:])


def tokens_of(text: str, spans: list[tuple[int, int, int]], dropped: list[tuple[int, int]]) -> Tokens:
    places, last = [], 0
    for m in _HIT.finditer(text):
        before = text[last:m.start()]
        start, end = m.start() - (len(before) - len(before.rstrip(_BEFORE))), m.end()
        last = end
        token = text[start:end]
        start += len(token) - len(token.lstrip(".%_-)"))
        end -= len(token) - len(token.rstrip(".%_-+("))
        places.append((start, end))
    texts = [text[a:b] for a, b in places]
    n = len(places)
    label, base, vague = [0] * n, [False] * n, [False] * n
    for kind, a, b in spans:
        for i in _inside(places, a, b):
            if not base[i]:
                open_span = i and base[i - 1] and places[i - 1][1] > a and label[i - 1] in (1 + kind, 5 + kind)
                label[i], base[i] = (5 if open_span else 1) + kind, True
    for a, b in dropped:  # a match of several tokens may hold what a pattern would find in one of them
        held = _inside(places, a, b)
        if len(held) > 1:
            for i in held:
                vague[i] = not base[i]
    beside = [i > 0 and bool(_GAP.match(text, places[i - 1][1], places[i][0])) for i in range(n)]
    links = _links(texts, base)
    for hub, i in links:
        if base[hub] and not base[i]:
            vague[i] = True
    return Tokens(places, texts, [shape_of(t) for t in texts], label, base, vague, beside, links)


def _inside(places: list[tuple[int, int]], a: int, b: int) -> range:
    """Numbers of the tokens that share a character with [a, b)."""
    first, end = 0, len(places)
    while first < end:
        middle = (first + end) // 2
        if places[middle][1] <= a:
            first = middle + 1
        else:
            end = middle
    end = first
    while end < len(places) and places[end][0] < b:
        end += 1
    return range(first, end)


def _links(texts: list[str], base: list[bool]) -> list[tuple[int, int]]:
    """Every token of a group of similar ones is linked with the group's first observed one, else its first."""
    groups = defaultdict(list)
    for i, token in enumerate(texts):
        for key in keys_of(token):
            groups[key].append(i)
    links = set()
    for key, members in groups.items():
        if len(members) > 1:
            hub = next((i for i in members if base[i]), members[0])
            near = digits_of(texts[hub])
            links.update((hub, i) for i in members if i != hub and (
                key[0] not in ("head", "tail") or one_digit_apart(near, digits_of(texts[i]))))
    return sorted(links)


# -- the field -----------------------------------------------------------------------------------------

LABELS = 1 + 2 * len(KINDS)
KIND_OF = np.array([0, 1, 2, 3, 4, 1, 2, 3, 4])  # 0: none
INNER = np.arange(LABELS) > len(KINDS)
#: An inner label follows a label of its kind only.
FOLLOWS = ~INNER[None, :] | (KIND_OF[:, None] == KIND_OF[None, :])
NEVER = -40.0
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])


@dataclass
class Field:
    """Weights: ``shape`` by shape value and kind, ``step`` between neighbouring labels, ``agree`` by kind."""
    shape: np.ndarray
    step: np.ndarray
    agree: np.ndarray

    def steps(self) -> np.ndarray:
        return np.where(FOLLOWS, self.step, NEVER)


SHAPE, STEP, LINK = range(3)


def observations(t: Tokens) -> Iterator[tuple[int, ...]]:
    """What the pieces of the field see of a text, tokens that are no example aside: shapes with their kind, labels
    with the next one, and whether linked tokens are of one kind."""
    for i in range(len(t.label)):
        if not t.vague[i]:
            yield (SHAPE, *t.shape[i], int(KIND_OF[t.label[i]]))
            if t.beside[i] and not t.vague[i - 1]:
                yield STEP, t.label[i - 1], t.label[i]
    for hub, i in t.links:
        if not t.vague[hub] and not t.vague[i]:
            yield LINK, int(KIND_OF[t.label[hub]] == KIND_OF[t.label[i]])


def fit(counts: dict[tuple[int, ...], float], rounds: int = 400, decay: float = 1e-3, rate: float = 0.1,
        most: float = 4.0) -> Field:
    """Weights from counted observations, each piece by itself.

    Shapes: log-linear in their parts, by Adam steps on the penalised likelihood. Steps: how much likelier a label
    is after another than at all. Links: the log odds of one kind against any other. Both smoothed by one more
    observation and at most ``most``, so that no piece alone decides.
    """
    field = Field(np.zeros((int(sum(SIZES)), len(KINDS) + 1)), np.zeros((LABELS, LABELS)), np.zeros(len(KINDS) + 1))
    rows = [(o[1:], n) for o, n in sorted(counts.items()) if o[0] == SHAPE]
    if rows:
        at = np.array([o[:-1] for o, _ in rows], np.int64) + OFFSETS
        truth = np.eye(len(KINDS) + 1)[[o[-1] for o, _ in rows]]
        share = np.array([n for _, n in rows], np.float64)[:, None]
        share /= share.sum()
        first, second = np.zeros_like(field.shape), np.zeros_like(field.shape)
        for step in range(1, rounds + 1):
            score = field.shape[at].sum(axis=1)
            chance = np.exp(score - score.max(axis=1, keepdims=True))
            error = (chance / chance.sum(axis=1, keepdims=True) - truth) * share
            slope = np.stack([np.bincount(at.ravel(), np.repeat(error[:, k], len(SIZES)), minlength=len(field.shape))
                              for k in range(len(KINDS) + 1)], axis=1) + decay * share.min() * field.shape
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            field.shape -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-12)
    pairs = np.zeros((LABELS, LABELS))
    for o, n in counts.items():
        if o[0] == STEP:
            pairs[o[1], o[2]] += n
    usual = (pairs.sum(axis=0) + 1.0) / (pairs.sum() + LABELS)
    after = (pairs + usual) / (pairs.sum(axis=1, keepdims=True) + 1.0)
    field.step[:] = np.clip(np.log(after / usual), -most, most)
    apart, same = counts.get((LINK, 0), 0.0) + 1.0, counts.get((LINK, 1), 0.0) + 1.0
    field.agree[:] = min(max(np.log(len(KINDS) * same / apart), 0.0), most)
    return field


def _soft_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def marginals(node: np.ndarray, chain: np.ndarray, links: np.ndarray, field: Field, rounds: int = 200,
              damping: float = 0.3, close: float = 1e-4) -> np.ndarray:
    """Label chances of every token by loopy message passing until messages stand still.

    ``node`` are log potentials, ``chain`` the numbers of tokens directly after their predecessor, ``links`` pairs.
    Exact where chain and links make no loop. All texts of a batch are one graph without links between them.
    """
    ends = np.concatenate([np.stack([chain - 1, chain], axis=1), links]).astype(np.int64).reshape(-1, 2)
    split = len(chain)
    source, target = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
    back = np.concatenate([np.arange(len(ends), 2 * len(ends)), np.arange(len(ends))])
    number = np.concatenate([np.arange(len(ends))] * 2)
    ahead = np.flatnonzero((number < split) & (np.arange(len(number)) < len(ends)))
    behind = np.flatnonzero((number < split) & (np.arange(len(number)) >= len(ends)))
    far = np.flatnonzero(number >= split)
    steps, bonus = field.steps(), np.expm1(field.agree)
    members = np.eye(len(KINDS) + 1)[KIND_OF]
    message = np.zeros((len(source), LABELS))
    belief = node.copy()
    for _ in range(rounds if len(source) else 0):
        cavity = belief[source] - message[back]
        fresh = np.empty_like(message)
        fresh[ahead] = _soft_sum(cavity[ahead][:, :, None] + steps[None], 1)
        fresh[behind] = _soft_sum(cavity[behind][:, :, None] + steps.T[None], 1)
        mass = np.exp(cavity[far] - cavity[far].max(axis=1, keepdims=True))
        mass /= mass.sum(axis=1, keepdims=True)
        fresh[far] = np.log(1 + ((mass @ members) * bonus) @ members.T)
        fresh -= fresh.max(axis=1, keepdims=True)
        np.maximum(fresh, NEVER, out=fresh)
        moved = np.abs(fresh - message).max()
        message += (1 - damping) * (fresh - message)
        belief = node.copy()
        np.add.at(belief, target, message)
        if moved < close:
            break
    chance = np.exp(belief - belief.max(axis=1, keepdims=True))
    return chance / chance.sum(axis=1, keepdims=True)


def potentials(t: Tokens, field: Field) -> np.ndarray:
    """Log potentials of the tokens' labels; observed ones have one label left."""
    shape = np.array(t.shape, np.int64).reshape(-1, len(SIZES)) + OFFSETS
    node = field.shape[shape].sum(axis=1)[:, KIND_OF]
    for i, beside in enumerate(t.beside):
        if t.base[i]:
            node[i, np.arange(LABELS) != t.label[i]] = NEVER
            node[i, t.label[i]] = 0.0
        elif not beside:
            node[i, INNER] = NEVER
    return node


# -- spans ---------------------------------------------------------------------------------------------

def _plausible(kind: int, text: str) -> bool:
    """Whether a text can be of the kind at all."""
    if kind == 0:
        return 0 < text.find("@") < len(text) - 1
    if _LETTER.search(text) or "@" in text:
        return False
    n = len(digits_of(text))
    return bool(_QUAD.match(text)) if kind == 1 else 13 <= n <= 19 if kind == 2 else 7 <= n <= 15


def _certain(kind: int, text: str) -> bool:
    """Whether the text alone passes its kind's pattern and check."""
    if kind == 0:
        return _emails(text) == [(0, len(text))]
    pattern, check = ((_IP, _is_ip), (_CARD, _is_card), (_PHONE, _is_phone))[kind - 1]
    return bool(pattern.fullmatch(text)) and check(text)


def added_spans(text: str, t: Tokens, chance: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans the field adds.

    Runs of neighbouring tokens that more likely than ``least`` are of one kind, or where those are of no
    plausible length the single tokens. A span must pass its kind's own check or have a link to a span that
    a pattern found.
    """
    by_kind = chance @ np.eye(len(KINDS) + 1)[KIND_OF]
    known = [set() for _ in t.spans]
    for hub, i in t.links:
        if t.base[hub]:
            known[i].add(int(KIND_OF[t.label[hub]]) - 1)
    runs: list[tuple[int, list[int]]] = []
    for i in range(len(t.spans)):
        kind = int(by_kind[i].argmax()) - 1
        if t.base[i] or kind < 0 or by_kind[i, kind + 1] < least:
            continue
        inner = INNER[chance[i].argmax()]
        if runs and inner and t.beside[i] and runs[-1][1][-1] == i - 1 and runs[-1][0] == kind:
            runs[-1][1].append(i)
        else:
            runs.append((kind, [i]))

    def span(run: list[int]) -> tuple[int, int]:
        a, b = t.spans[run[0]][0], t.spans[run[-1]][1]
        while a < b and text[a] == "(" and ")" not in text[a:b]:
            a += 1
        while a < b and text[b - 1] == ")" and "(" not in text[a:b]:
            b -= 1
        return a, b

    made = []
    for kind, run in runs:
        parts = [run] if _plausible(kind, text[slice(*span(run))]) else [[i] for i in run]
        for part in parts:
            a, b = span(part)
            if _plausible(kind, text[a:b]) and (_certain(kind, text[a:b]) or any(kind in known[i] for i in part)):
                made.append((kind, a, b))
    return made


def _named(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# -- Spark ---------------------------------------------------------------------------------------------

def train(docs: DataFrame, text: str = "text", bound: int = 20_000) -> Field:
    """A field fitted to what the patterns find in all texts.

    Tasks count equal observations, Spark adds the counts up; the ``bound`` most frequent different ones come
    to the driver. Texts without tokens, and an empty table, add nothing.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, ...]] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([
                pa.array([",".join(map(str, o)) for o in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64())], names=["seen", "n"])

        for batch in (piece for whole in batches for piece in pieces(whole, 0)):
            for value in batch.column(0).to_pylist():
                if value and _HIT.search(value):
                    counts.update(observations(tokens_of(value, *base_spans(value))))
            if len(counts) > 100_000:
                yield rows()
                counts.clear()
        yield rows()

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "seen string, n long")
    counted = counted.groupBy("seen").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "seen").limit(bound)
    return fit({tuple(map(int, r["seen"].split(","))): float(r["n"]) for r in counted.collect()})


FIELDS = [*(StructField(f"n_{k}", LongType()) for k in KINDS), StructField("base_sha256", StringType()),
          StructField("spans", StringType())]


def find_personal_data(docs: DataFrame, field: Field, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256`` and ``spans``.

    The counts and the digest are of what the patterns find (``kind:start:end`` by kind, then start); ``spans``
    has the same with those the field adds. Places are code points, ends exclusive. NULL and empty texts
    have none; repeated rows give the same; other columns pass through, one with the name of a result is
    replaced; an empty table gives no rows.
    """
    def start():
        def apply(texts):
            found = [_one(value) for value in texts.to_pylist()]
            graphs = [(i, t) for i, (_, t) in enumerate(found) if t is not None]
            added: dict[int, list] = {}
            if graphs:
                base = np.cumsum([0, *(len(t.spans) for _, t in graphs)])
                chain = np.concatenate([np.flatnonzero(t.beside) + b for (_, t), b in zip(graphs, base)])
                links = np.concatenate([np.array(t.links, np.int64).reshape(-1, 2) + b for (_, t), b in zip(graphs, base)])
                chance = marginals(np.concatenate([potentials(t, field) for _, t in graphs]), chain, links, field)
                for (i, t), a, b in zip(graphs, base, base[1:]):
                    added[i] = added_spans(texts[i].as_py(), t, chance[a:b], least)
            columns: list[list] = [[] for _ in FIELDS]
            for i, (spans, _) in enumerate(found):
                kinds = [k for k, _, _ in spans]
                named = _named(spans)
                row = [kinds.count(k) for k in range(len(KINDS))]
                row += [hashlib.sha256(named.encode()).hexdigest(), _named([*spans, *added.get(i, [])])]
                for column, value in zip(columns, row):
                    column.append(value)
            return [pa.array(c, pa.int64()) for c in columns[:len(KINDS)]] + [pa.array(c, pa.string()) for c in columns[len(KINDS):]]

        return apply

    return append_columns(docs, [text], FIELDS, start)


def _one(value: str | None) -> tuple[list[tuple[int, int, int]], Tokens | None]:
    """A text's certain spans, and its tokens where any of them is still open."""
    if not value or not _HIT.search(value):
        return [], None
    spans, dropped = base_spans(value)
    t = tokens_of(value, spans, dropped)
    return spans, None if all(t.base) else t
