"""Cutting texts where byte-level BPE cannot look across, and caching what lies between.

The splitting pattern of byte-level BPE lets a space begin a match only if the
space stands before a character that is none; so between a character that is
no white space and a space followed by one, every match ends. Texts are cut
there. The ids of such a part depend on the part alone, so they are looked up
in a bounded cache, and only parts not seen lately are encoded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

CUT = re.compile(r"(?<=\S) (?=\S)")
#: Letters that every Unicode version in use knows as letters.
FAMILIAR = "\u0370"
_LETTERS = "".join(c for c in map(chr, range(0x370)) if c.isalpha())
_MARKS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
#: A run of familiar letters, of ASCII marks (no apostrophe) or a single line feed is one match of the pattern, wherever it is.
RUNS = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+|\n")
FAMILIAR_RUNS = re.compile(f"(?:[{_LETTERS}{_MARKS}]+\n)*[{_LETTERS}{_MARKS}]+")


def blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut at the same places."""
    at = 0
    while len(text) - at > size:
        m = CUT.search(text, at + size)
        to = m.start() if m else len(text)
        yield text[at:to]
        at = to
    if at < len(text) or not at:
        yield text[at:]


class PartCache:
    """Part → encoded bytes, at most ``limit`` parts of at most ``longest`` characters.

    At half the limit the parts become the old generation; those seen again
    move to the new one, the rest go with the next change.

    ``marks`` are single characters, neither letter, digit nor white space: a
    part of letters and one mark behind them splits between the two, so it is
    put together from the encodings of both. ``encode_parts`` may encode many
    parts without a space in them or white space at their ends, each with one
    space before it, faster, and ``encode_words`` parts of familiar runs.

    ``added`` are strings that stand for themselves wherever they are, with
    their encodings: texts are cut there first. Texts with a string in
    ``whole`` are encoded in one go.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 500_000, longest: int = 48, marks: str = "",
                 encode_parts: Callable[[list[str]], list[bytes]] | None = None,
                 encode_words: Callable[[list[str]], list[bytes]] | None = None,
                 added: dict[str, bytes] | None = None, whole: Sequence[str] = ()):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.encode_parts = encode_parts or (lambda parts: encode([" " + p for p in parts]))
        self.encode_words = encode_words
        self.added, self.whole = added or {}, tuple(whole)
        # of strings that begin alike the longest is found
        self.cut_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.marks = dict(zip(marks, encode(list(marks)), strict=True))
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def joined(self, texts: list[str]) -> list[bytes]:
        """The encoded bytes of each text."""
        if self.whole and any(w in t for w in self.whole for t in texts):
            return [self.encode([t])[0] if any(w in t for w in self.whole) else self.joined([t])[0] for t in texts]
        if any(a in t for a in self.added for t in texts):
            return [self._around(t) if any(a in t for a in self.added) else self.joined([t])[0] for t in texts]
        if all(len(t) <= 1 << 21 for t in texts):
            return self._joined(texts)
        return [b"".join(self._joined([b])[0] for b in blocks(t)) for t in texts]

    def _around(self, text: str) -> bytes:
        """A text with strings of ``added`` in it: what lies between them is encoded alone."""
        pieces = self.cut_added.split(text)
        rest = iter(self.joined(pieces[::2]))
        return b"".join(self.added[p] if i % 2 else next(rest) for i, p in enumerate(pieces))

    def _parts(self, texts: list[str]) -> tuple[list[str], list[list[str]], set[str]]:
        """First part and other parts of each text, and the parts that are not known."""
        lists = [t.split(" ") for t in texts]
        new = set().union(*lists).difference(self.known)
        # where a space stands beside other white space or at an edge, only some spaces are cuts
        odd = {p for p in new if not p or p.strip() != p}
        if odd:
            lists = [p if odd.isdisjoint(p) else CUT.split(t) for p, t in zip(lists, texts, strict=True)]
            new = set().union(*lists).difference(self.known)
            new.discard("")  # an empty text
        return [p.pop(0) for p in lists], lists, new

    def _joined(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit // 2:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        heads, lists, new = self._parts(texts)
        again = old.keys() & new
        known.update(zip(again, map(old.__getitem__, again), strict=True))
        new -= again
        marked = {p for p in new if p[-1] in self.marks and p[:-1].isalpha() and max(p) < FAMILIAR}
        plain = list((new - marked).union(p[:-1] for p in marked).difference(known))
        known.update(self._fresh(plain))
        for p in marked:
            known[p] = known[p[:-1]] + self.marks[p[-1]]
        get = known.__getitem__
        out = [head + b"".join(map(get, p)) for head, p in zip(self.encode(heads), lists, strict=True)]
        # parts that end or begin in white space are cut differently elsewhere; long ones are not worth the room
        for p in plain:
            if len(p) > self.longest or p.strip() != p:
                del known[p]
        return out

    def _fresh(self, parts: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        if self.encode_words:
            words = list(filter(FAMILIAR_RUNS.fullmatch, parts))
            out = dict(zip(words, self.encode_words(words), strict=True))
            parts = [p for p in parts if p not in out]
        whole = [p for p in parts if " " not in p and p.strip() == p]
        out.update(zip(whole, self.encode_parts(whole), strict=True))
        rest = [p for p in parts if p not in out]
        if rest:
            out.update(zip(rest, self.encode([" " + p for p in rest]), strict=True))
        return out


def text_batches(texts: list[str], rows: int = 256, chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of about a megabyte at a time."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if i + 1 - at >= rows or size >= chars:
            yield at, texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]
