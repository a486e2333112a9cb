"""Byte-level BPE by a deterministic tokenisation automaton.

The automaton reads tokens and accepts exactly the token sequences the merge rules produce. It starts as
one state that accepts every byte sequence. Each rule (u, v) -> uv is added by a merge gadget: all arcs u
are led to a copy of their target without the arc v, and every state with an arc u gets an arc uv to where
v led. All arcs of one token then share one target, so a rule adds one state. The copies would repeat
nearly all arcs of all tokens; a state is kept as the gadgets it went through, and a token as the tokens
whose arcs its own stem from: an arc is missing only if one of these gadgets dropped one of these stems
while it stood. Arcs that were read are kept as an explicit transition table.

A text has one accepted sequence: encoding follows it through the table over a pre-split word. Decoding
joins the byte labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from .chunks import Memo, chunks
from .common import append_columns, held

#: How the published byte-level vocabularies split text before merging (a fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of a word whose tokens are looked up together.
HEAD = 4


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The tokenisation automaton of a vocabulary (token id -> bytes) and its ordered merge rules."""

    def __init__(self, labels: list[bytes], rules: list[tuple[int, int, int]]):
        """``rules``: (left, right, merged) token ids in order of priority."""
        self.labels = labels
        self.target = array("i", [0]) * len(labels)  # state after a token
        #: For each state, the tokens whose gadgets it went through, and the last rule of each.
        self.gadgets: list[tuple[tuple[int, int], ...]] = [()]
        #: Rule of a gadget: after its left token the right one has no arc.
        self.drops: dict[int, int] = {}
        #: For each token, the tokens its arcs stem from and the rule up to which each stood for it.
        self.stems: dict[int, tuple[tuple[int, float], ...]] = {
            t: ((t, float("inf")),) for t, label in enumerate(labels) if len(label) == 1}
        for k, (u, v, merged) in enumerate(rules):
            if merged in self.stems or u not in self.stems or v not in self.stems or not self.arc(self.target[u], v):
                continue  # the pair never stands side by side, or the token has been made before
            led = self.target[v]
            passed = self.gadgets[self.target[u]]
            self.gadgets.append(((u, k), *(passed[1:] if passed and passed[0][0] == u else passed)))
            self.drops[u << 20 | v] = k
            self.target[u] = len(self.gadgets) - 1
            self.target[merged] = led
            self.stems[merged] = ((merged, float("inf")), *((t, min(limit, k)) for t, limit in self.stems[u]))
        self.tokens: dict[bytes, int] = {}
        for t in sorted(self.stems):
            self.tokens.setdefault(labels[t], t)
        #: Token of a byte string; -1 if it only begins tokens.
        self.trie = {label[:i]: -1 for label in self.tokens for i in range(1, len(label))} | self.tokens
        if any(bytes([b]) not in self.tokens for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        #: The transition table as far as it was read: per state, the state a token leads to, -1 without an arc.
        self.table: list[dict[int, int]] = [{} for _ in self.gadgets]
        self.read = 0
        self.heads: dict[bytes, tuple[tuple[tuple[int, int], ...], bool]] = {}

    def arc(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc ``token``: none of its gadgets dropped what that arc stems from."""
        drops = self.drops
        for left, last in self.gadgets[state]:
            for stem, limit in self.stems[token]:
                rule = drops.get(left << 20 | stem)
                if rule is not None and rule <= last and rule <= limit:
                    return False
        return True

    def _head(self, head: bytes) -> tuple[tuple[tuple[int, int], ...], bool]:
        """(length, token) of the tokens ``head`` begins with, shortest first, and whether it begins longer ones."""
        fitting, deeper = [], False
        for size in range(1, len(head) + 1):
            token = self.trie.get(head[:size])
            if token is None:
                break
            if token >= 0:
                fitting.append((size, token))
        else:
            deeper = len(head) == HEAD
        if len(self.heads) >= 100_000:
            self.heads.clear()
        found = self.heads[head] = tuple(fitting), deeper
        return found

    def _lead(self, state: int, token: int) -> int:
        """Read an arc into the table; at most 250,000 are kept."""
        if self.read >= 250_000:
            for row in self.table:
                row.clear()
            self.read = 0
        self.read += 1
        led = self.table[state][token] = self.target[token] if self.arc(state, token) else -1
        return led

    def encode(self, word: bytes) -> list[int]:
        """The one accepted token sequence that spells ``word``: long arcs first, back where none goes on.

        Each prefix has one accepted sequence, so a position is never reached twice.
        """
        trie, table, heads = self.trie, self.table, self.heads
        size = len(word)
        ids: list[int] = []
        open_arcs: list[tuple[int, int, tuple, int]] = []
        at = state = 0
        while at < size:
            head = word[at:at + HEAD]
            fitting, deeper = heads.get(head) or self._head(head)
            if deeper:
                longer = []
                for end in range(at + HEAD + 1, size + 1):
                    token = trie.get(word[at:end])
                    if token is None:
                        break
                    if token >= 0:
                        longer.append((end - at, token))
                if longer:
                    fitting = (*fitting, *longer)
            left = len(fitting)
            while True:
                while not left:
                    ids.pop()
                    at, state, fitting, left = open_arcs.pop()
                left -= 1
                length, token = fitting[left]
                led = table[state].get(token)
                if led is None:
                    led = self._lead(state, token)
                if led >= 0:
                    break
            open_arcs.append((at, state, fitting, left))
            ids.append(token)
            at += length
            state = led
        return ids

    def decode(self, ids) -> bytes:
        return b"".join([self.labels[t] for t in ids])


#: Token ids of a piece of text, the same as decimals joined by commas, and the bytes their arcs spell.
Encoded = tuple[array, str, bytes]


class Tokenizer:
    """Whole texts to token ids and back by the automaton, after a vocabulary file's text."""

    def __init__(self, content: str):
        file = json.loads(content)
        model, added = file["model"], file.get("added_tokens", [])
        if (file.get("normalizer") or (file.get("pre_tokenizer") or {}).get("type") != "ByteLevel"
                or file["pre_tokenizer"].get("add_prefix_space") or not file["pre_tokenizer"].get("use_regex", True)
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                              "end_of_word_suffix", "ignore_merges"))
                or any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip"))):
            raise ValueError("only plain byte-level BPE files are supported")
        letters = byte_letters()
        n = max([*model["vocab"].values(), *(t["id"] for t in added)]) + 1
        labels = [b""] * n
        for token, i in model["vocab"].items():
            labels[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for t in added:
            labels[t["id"]] = t["content"].encode()
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.added = {t["content"]: t["id"] for t in added}
        self.automaton = Automaton(labels, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.small = n <= 1 << 16
        self.words = regex.compile(SPLIT)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        self.memo = Memo(self._chunks)
        self.names = [str(i) for i in range(n)]
        self.known: dict[str, Encoded] = {}  # pre-split words, whatever stands beside them

    def _encoded(self, ids) -> Encoded:
        return array("H" if self.small else "I", ids), ",".join([self.names[i] for i in ids]), self.automaton.decode(ids)

    def _chunks(self, texts: list[str]) -> list[Encoded]:
        encode, known, find = self.automaton.encode, self.known, self.words.findall
        if len(known) > 150_000:
            known.clear()
        made = []
        for text in texts:
            own = []
            for word in find(text):
                one = known.get(word)
                if one is None:
                    one = self._encoded(encode(word.encode()))
                    if len(word) <= 100:
                        known[word] = one
                own.append(one)
            made.append(own[0] if len(own) == 1 else (
                array("H" if self.small else "I", list(chain.from_iterable([ids for ids, _, _ in own]))),
                ",".join([s for _, s, _ in own]), b"".join([label for _, _, label in own])))
        return made

    def _parts(self, text: str) -> list[str | int]:
        """Ordinary stretches of a text, and the ids of added tokens between them."""
        if not self.cut or not any(a in text for a in self.added):
            return [text] if text else []
        parts: list[str | int] = []
        at = 0
        for m in self.cut.finditer(text):
            parts += [text[at:m.start()], self.added[m.group()]]
            at = m.end()
        return [p for p in [*parts, text[at:]] if p != ""]

    def encode_batch(self, texts: list[str | None]) -> list[list[Encoded]]:
        """The encoded pieces of each whole text, in order."""
        parts = [self._parts(t or "") for t in texts]
        found = iter(self.memo.lookup([chunks(p) for ps in parts for p in ps if isinstance(p, str)]))
        return [
            list(chain.from_iterable([next(found) if isinstance(p, str) else [self._encoded((p,))] for p in ps])) for ps in parts]

    def decode(self, ids) -> str:
        return self.automaton.decode(ids).decode("utf-8", "replace")


def tokenizer(content: str) -> Tokenizer:
    """The tokenizer of a file's text, compiled once per Python worker."""
    return held(("bpe", content), lambda: Tokenizer(content))


def vocabulary(df: DataFrame, path: str, limit: int = 64 << 20):
    """The vocabulary file sent to the executors, which may lack it; its size is checked."""
    with open(path, encoding="utf-8") as file:
        content = file.read(limit + 1)
    if len(content) > limit:
        raise ValueError(f"{path} is larger than {limit} characters")
    return df.sparkSession.sparkContext.broadcast(content)


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if kept, ``token_ids``, ``decoded``.

    Every whole text is encoded by the automaton of the vocabulary file at ``path`` and decoded again from
    its ids. NULL is taken as empty, and has no tokens; each row is encoded by itself, so repeated rows
    give equal results; columns named like the results are replaced; an empty table gives no rows.
    """
    sent = vocabulary(docs, path)
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
              StructField("decoded_sha256", StringType())]
    if keep_ids:
        fields += [StructField("token_ids", ArrayType(IntegerType())), StructField("decoded", StringType())]

    def start():
        own = tokenizer(sent.value)

        def apply(texts):
            encoded = own.encode_batch(texts.to_pylist())
            decoded = [b"".join([label for _, _, label in text]).decode("utf-8", "replace") for text in encoded]
            named = [",".join([s for _, s, _ in text if s]) for text in encoded]
            made = [
                pa.array([sum([len(ids) for ids, _, _ in text]) for text in encoded], pa.int64()),
                pa.array([hashlib.sha256(s.encode()).hexdigest() for s in named], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            ]
            if keep_ids:
                made += [pa.array([list(chain.from_iterable([ids for ids, _, _ in text])) for text in encoded], pa.list_(pa.int32())),
                         pa.array(decoded, pa.string())]
            return made

        return apply

    return append_columns(docs, [text], fields, start)


def decode_documents(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text its token ids spell. NULL ids give NULL, no ids the empty text."""
    sent = vocabulary(encoded, path)

    def start():
        own = tokenizer(sent.value)

        def apply(_, column):
            return [pa.array([None if x is None else own.decode(x) for x in column.to_pylist()], pa.string())]

        return apply

    sized = encoded.withColumn("__none", F.lit(""))
    return append_columns(sized, ["__none", ids], [StructField("decoded", StringType())], start).drop("__none")
