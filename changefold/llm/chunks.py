"""Cutting text where byte-level BPE never joins, so that pieces can be encoded once and looked up after."""

from __future__ import annotations

import gc
import re
import sys

#: Every white space a text may hold directly before a blank; without any of them a plain split is exact.
_BEFORE_BLANK = tuple(c + " " for c in map(chr, range(0x3001)) if c.isspace())
#: The same as a pattern for Arrow.
BEFORE_BLANK = "[" + "".join(f"\\x{{{ord(pair[0]):x}}}" for pair in _BEFORE_BLANK) + "] "
_CUT = re.compile(r"(?<=\S) ")
assert not any(c.isspace() for c in map(chr, range(0x3001, sys.maxunicode + 1)))


def chunks(text: str) -> list[str]:
    """Pieces of ``text`` between blanks that follow a non-space.

    The pre-splitter never has a piece that runs over such a blank (a piece takes one blank in front at
    most, and runs of white space start where a non-space ends), nor looks back over it. All chunks but
    the first stand for themselves with a blank in front.
    """
    if any(pair in text for pair in _BEFORE_BLANK):
        return _CUT.split(text)
    return text.split(" ")


class Memo:
    """Encoded chunks by text. ``room`` bounds the entries kept; once full, new ones serve their batch only.

    ``encode(list of texts)`` gives one value per text. Chunks with a blank in front and the first ones
    are kept apart, so no chunk is copied to be looked up.
    """

    def __init__(self, encode, room: int = 250_000, longest: int = 100):
        self.encode, self.room, self.longest = encode, room, longest
        gc.disable()  # kept entries are many and make no cycles; searching them for cycles took a third of the time
        self.spaced: dict[str, object] = {}
        self.plain: dict[str, object] = {}

    def lookup(self, texts: list[list[str]]) -> list[list]:
        """The values of the chunks of each text, in order."""
        spaced, plain = self.spaced.get, self.plain.get
        found = [[plain(p[0]), *map(spaced, p[1:])] if p else [] for p in texts]
        holes = [i for i, f in enumerate(found) if None in f]
        if holes:
            new_plain = {texts[i][0] for i in holes if found[i][0] is None}
            new_spaced: set[str] = set()
            for i in holes:
                new_spaced.update([c for c, f in zip(texts[i], found[i]) if f is None][found[i][0] is None:])
            values = self.encode([*(" " + c for c in new_spaced), *new_plain])
            extra = dict(zip(new_spaced, values))
            first = dict(zip(new_plain, values[len(new_spaced):]))
            for i in holes:
                own = found[i]
                begin = first[texts[i][0]] if own[0] is None else own[0]
                found[i] = [extra[c] if f is None else f for c, f in zip(texts[i], [begin, *own[1:]])]
            self._keep(self.spaced, extra)
            self._keep(self.plain, first)
        return found

    def _keep(self, store: dict, new: dict) -> None:
        """Keep new values while there is room, very long chunks aside."""
        free = self.room - len(store)
        if free > 0:
            store.update([x for x in new.items() if len(x[0]) <= self.longest][:free])
