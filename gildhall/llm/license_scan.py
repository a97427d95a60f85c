"""License notices in texts, with a few edits allowed.

A notice may be found with up to ``edits`` inserted, deleted or replaced
characters. By the pigeonhole principle a notice cut into ``edits + 1`` pieces
keeps one of them untouched in every such place; cut into ``edits + 2`` it
keeps two. One Aho-Corasick pass over a text's words finds the pieces of all
notices; where enough of them stand at about the right distances, the
``regex`` library's bounded-error matching decides, and its spans are reported.
"""

from __future__ import annotations

import dataclasses
from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import id_text, map_arrow


@dataclasses.dataclass(frozen=True)
class Notice:
    """``phrase`` is words of a-z and 0-9 with one space between."""

    label: str
    phrase: str
    edits: int = 0
    base: bool = False


#: Phrases whose places count exactly, and their labels.
BASE = (
    Notice("gpl", "gnu general public license", 3, True),
    Notice("apache", "apache license", 1, True),
    Notice("cc-by", "cc by", 0, True),
    Notice("mit", "mit license", 0, True),
)
#: Further notices, each long enough that so few edits make no other phrase of it.
MORE = (
    Notice("agpl", "gnu affero general public license", 3),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("bsd", "redistribution and use in source and binary forms with or without", 4),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("cc-by", "licensed under cc by", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("isc", "permission to use copy modify and or distribute this software", 4),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 4),
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "the mit license", 1),
    Notice("mpl", "mozilla public license", 2),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 4),
)
NOTICES = BASE + MORE

#: ASCII as it counts here: letters in lower case and digits stay, all else parts words; other bytes stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> str:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of ``text``, A-Z in lower case, with one space between."""
    return b" ".join(text.encode("utf-8", "replace").translate(FOLD).split()).decode()


class Searcher:
    """All places of ``notices`` in a line of words."""

    def __init__(self, notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.notices, self.needed, self.fuzzy = list(notices), [], []
        seeds = defaultdict(list)
        for i, n in enumerate(self.notices):
            size = len(n.phrase)
            # two untouched pieces are asked for where pieces stay long enough to be rare
            need = 2 if n.edits and size >= 5 * (n.edits + 2) else 1
            edges = [size * k // (n.edits + need) for k in range(n.edits + need + 1)]
            for a, b in zip(edges, edges[1:], strict=False):
                seeds[n.phrase[a:b]].append((i, a))
            self.needed.append(need)
            # the library never begins a match with an inserted character, so those are spelled out
            self.fuzzy.append([regex.compile(rf"(?b)(?<![^ ])[^ ]{{{j}}}(?:{n.phrase}){{e<={n.edits - j}}}(?![^ ])")
                               for j in range(n.edits + 1)])
        self.seeds = ahocorasick.Automaton()
        for piece, of in seeds.items():
            self.seeds.add_word(piece, (len(piece), of))
        self.seeds.make_automaton()

    def places(self, line: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits), each from word edge to word edge.

        Every exact place is one; of other places of a notice that share
        characters the one with the fewest edits, then the first, is left, and
        none that shares characters with an exact place.
        """
        hits = defaultdict(list)
        for last, (size, of) in self.seeds.iter(line) if self.notices else ():
            for i, a in of:
                hits[i].append((last + 1 - size - a, a))
        out = []
        for i, begins in sorted(hits.items()):
            begins.sort()
            exact = self._exact(line, i, begins)
            out += exact
            if self.notices[i].edits:
                at = 0
                for p in self._loose(line, i, begins, {p[0] for p in exact}):
                    while at < len(exact) and exact[at][1] <= p[0]:
                        at += 1
                    if at == len(exact) or exact[at][0] >= p[1]:
                        out.append(p)
        return out

    def _exact(self, line: str, i: int, begins: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        phrase, out, seen = self.notices[i].phrase, [], -1
        for b, _ in begins:
            to = b + len(phrase)
            if b > seen and line.startswith(phrase, b) and (not b or line[b - 1] == " ") and (to == len(line) or line[to] == " "):
                out.append((b, to, i, 0))
                seen = b
        return out

    def _loose(self, line: str, i: int, begins: list[tuple[int, int]], exact: set[int]) -> list[tuple[int, int, int, int]]:
        phrase, edits, need = self.notices[i].phrase, self.notices[i].edits, self.needed[i]
        found, low, tried, near = [], 0, None, defaultdict(int)
        for b, piece in begins:
            # the untouched pieces of one place put its start at most ``edits`` characters apart
            near[piece] += 1
            while begins[low][0] < b - edits:
                near[begins[low][1]] -= 1
                if not near[begins[low][1]]:
                    del near[begins[low][1]]
                low += 1
            if len(near) < need or b == tried or any(s in exact for s in range(b - edits, b + edits + 1)):
                continue
            if found and abs(found[-1][0] - b) <= edits:
                continue  # the place found before explains it
            tried = b
            to = line.find(" ", min(len(line), max(0, b) + len(phrase) + 2 * edits))
            window = max(0, b - 2 * edits), to if to >= 0 else len(line)
            matches = [(sum(m.fuzzy_counts) + j, m.start(), m.end())
                       for j, pattern in enumerate(self.fuzzy[i]) if (m := pattern.search(line, *window))]
            if matches:
                n, start, end = min(matches)
                found.append((start, end, i, n))
        out: list[tuple[int, int, int, int]] = []
        for p in sorted(set(found)):
            if not out or p[0] >= out[-1][1]:
                out.append(p)
            elif (p[3], p[0]) < (out[-1][3], out[-1][0]):
                out[-1] = p
        return out


PLACE = "struct<label:string,phrase:string,base:boolean,first_word:bigint,n_words:bigint,edits:int,text:string>"


def scan(docs: DataFrame, notices: Sequence[Notice] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words`` and ``places`` of every row: label, phrase, first word (from 0), words, edits, words found.

    Whole texts, a null text is empty; a text without words has no places. Rows
    that repeat an id, or have none, are scanned like any other. An empty table
    gives an empty result; other columns are ignored.
    """
    notices = tuple(notices)
    if any(words_of(n.phrase) != n.phrase or not n.phrase for n in notices):
        raise ValueError("a notice's phrase is words of a-z and 0-9 with one space between")
    schema = f"doc_id long, n_words long, places array<{PLACE}>"

    def run(batches):
        search = Searcher(notices)
        for b in batches:
            counts, found = [], []
            for text in b.column("text"):
                line = words_of(text.as_py())
                counts.append(line.count(" ") + 1 if line else 0)
                rows, at, words = [], 0, 0
                for start, end, i, edits in sorted(search.places(line)):
                    words += line.count(" ", at, start)
                    at = start
                    n = notices[i]
                    rows.append({"label": n.label, "phrase": n.phrase, "base": n.base, "first_word": words,
                                 "n_words": line.count(" ", start, end) + 1, "edits": edits, "text": line[start:end]})
                found.append(rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, places)],
                                             ["doc_id", "n_words", "places"])

    places = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()),
                                 ("n_words", pa.int64()), ("edits", pa.int32()), ("text", pa.string())]))
    return map_arrow(id_text(docs, id_col, text_col), run, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and labels of :func:`scan`'s rows; ``score`` is the best place's share of untouched characters, 0 without one."""
    base = F.filter("places", lambda p: p["base"] & (p["edits"] == 0))
    starts = F.transform(base, lambda p: p["first_word"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    share = F.transform("places", lambda p: F.lit(1.0) - p["edits"] / F.length(p["phrase"]))
    return scanned.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                          F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
                          labels(F.col("places")).alias("labels"), F.coalesce(F.array_max(share), F.lit(0.0)).alias("score"))
