"""Texts cut at boundaries where no token can cross, with remembered encodings.

The split pattern of the byte-level vocabularies never lets a match run from
a non-blank character into the blank behind it, so a text may be cut before
any single space that follows a non-blank. The chunks (a word with its
leading space) repeat a lot; each worker remembers their encodings."""

from __future__ import annotations

import re
from collections.abc import Callable

# A space behind a blank is no boundary: texts with one are cut the slow way.
_blank_then_space = re.compile(r"\s ")
_boundary = re.compile(r"(?<=\S)(?= )")


def chunks(text: str) -> tuple[str, list[str]]:
    """The text before its first boundary, and then the chunks, each without
    the one space that leads it: ``first + "".join(" " + c for c in rest)`` is the text."""
    if _blank_then_space.search(text):
        first, *rest = _boundary.split(text)
        return first, [c[1:] for c in rest]
    first, *rest = text.split(" ")
    return first, rest


class Remembered:
    """Encodings of chunks in two generations of up to ``size`` chunks each
    (and those of one slice): when the younger is full it becomes the older,
    and what is met again moves back, so frequent chunks stay known.
    ``encode_many`` is called once for all unknown chunks of a slice; chunks
    beyond ``longest`` characters are not kept, which bounds the bytes."""

    def __init__(self, encode_many: Callable[[list[str]], list], size: int = 250_000, longest: int = 64):
        self.encode_many, self.size, self.longest = encode_many, size, longest
        self.memo: dict = {}
        self.older: dict = {}

    def look_up(self, texts: list[str]) -> list[list]:
        """For each text, the encodings of its chunks."""
        if len(self.memo) > self.size:
            self.memo, self.older = {}, self.memo
        memo, get, older = self.memo, self.memo.get, self.older.get
        cut = [chunks(t) for t in texts]
        firsts = self.encode_many([first for first, _ in cut])
        found = [list(map(get, rest)) for _, rest in cut]
        missing = {c for (_, rest), got in zip(cut, found, strict=True) if None in got
                   for c, e in zip(rest, got, strict=True) if e is None}
        memo.update((c, e) for c in missing if (e := older(c)) is not None)
        unknown = [c for c in missing if c not in memo]
        memo.update(zip(unknown, self.encode_many([" " + c for c in unknown]), strict=True))
        out = [[first, *(map(memo.__getitem__, rest) if None in got else got)]
               for first, (_, rest), got in zip(firsts, cut, found, strict=True)]
        for c in unknown:
            if len(c) > self.longest:
                del memo[c]
        return out
