"""License scans: exact phrases, and a fuzzy search for short notices.

Texts and notices are brought to words of lower-case ASCII letters, digits and non-ASCII characters with one space
between. A notice of m characters may differ in k = m // EDIT_SHARE edits (one at least). It is cut into k + 1
pieces; a place within k edits holds at least one of them unchanged (pigeonhole), so an exact search for the pieces
finds all candidates. Around each, the regex library's bounded-error matching decides, counts the edits and gives the span.
Words that tell licenses apart may have errors too: the span's nearest word to each of them has to lie within TOLD edits (one for
four letters or fewer, and two letters changed about are one), and to no rival closer than to it ("rights", not "nights"). Only the short codes of Creative Commons, which are one edit apart, have to stand unchanged ("by nc", not "by sd"). Of notices that
overlap the one with the highest similarity names the place, so siblings are not taken for each other.

The scan is one map-only pass; nothing is shuffled or broadcast but the notices.

Windows hold one place at most, so the work grows with the text, also where a notice is repeated over a very long one.

Defined cases: null text is empty; overlapping places of a phrase all count; of matches that overlap, the most similar one is
reported, then the longer, then the earlier; repeated rows give repeated results; an empty table gives an empty result; columns
besides doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import KEY, map_batches, row_key, utf8

#: Fixed by the contract: phrases and their labels.
PHRASES = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}
#: Elements of a Creative Commons license beside attribution, in short and in full.
CC = {
    "": "",
    " sa": " sharealike",
    " nd": " noderivatives",
    " nc": " noncommercial",
    " nc sa": " noncommercial sharealike",
    " nc nd": " noncommercial noderivatives",
}
#: Notices searched with errors: label, text, and the words that tell it from others (for cc- labels: that must not differ).
NOTICES = (
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ""),
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("gpl", "licensed under the gnu general public license version 3", "general public"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "lesser general public"),
    ("agpl", "licensed under the gnu affero general public license version 3", "affero general public"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license", "general public"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ""),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla"),
    ("proprietary", "all rights reserved", "rights"),
    *((f"cc-by{short.replace(' ', '-')}", f"licensed under cc by{short} 4 0", f"cc by{short}") for short in CC),
    *(
        (f"cc-by{short.replace(' ', '-')}", f"licensed under a creative commons attribution{full} 4 0 international license", f"attribution{full}")
        for short, full in CC.items()
    ),
)
EDIT_SHARE = 12
#: Edits of a telling word, and words that are something else where they are nearer.
TOLD = 2
RIVALS = {
    "mit": ("bsd", "isc", "ms", "it", "nit", "mint", "fit", "unit", "limit", "eit"),
    "rights": ("nights", "lights", "flights", "sights", "fights", "heights", "tights", "eights", "knights"),
    "lesser": ("affero", "library"),
    "affero": ("lesser", "library"),
}

_KEEP = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_RESULT = (
    f"key {KEY}, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "notices array<struct<label:string,start_word:long,end_word:long,edits:int,similarity:double>>"
)


@lru_cache(1 << 16)
def apart(a: bytes, b: bytes) -> int:
    """Edits between two words; neighbours changed about are one. Above TOLD only that it is above."""
    if abs(len(a) - len(b)) > TOLD:
        return TOLD + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        before, last = last, row
    return last[-1]


class Notice:
    def __init__(self, label: str, text: str, told: str = "") -> None:
        data = text.encode()
        self.label, self.size = label, len(data)
        self.exact = told.encode() if label.startswith("cc-") else b""
        self.told = [] if self.exact else told.encode().split()
        self.own = [w for w in data.split() if len(w) > 1]
        self.edits = max(1, len(data) // EDIT_SHARE)
        cuts = [len(data) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(a, data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.pattern = regex.compile(b"(?b)(?:" + regex.escape(data) + b"){e<=%d}" % self.edits)

    def windows(self, text: bytes) -> list[tuple[int, int]]:
        """Stretches around the places of the pieces; places that lie within the errors of each other share one."""
        starts = []
        for offset, piece in self.pieces:
            at = text.find(piece)
            while at >= 0:
                starts.append(at - offset)
                at = text.find(piece, at + 1)
        out: list[tuple[int, int]] = []
        for s in sorted(set(starts)):
            if out and s - out[-1][0] <= self.edits:
                out[-1] = out[-1][0], s
            else:
                out.append((s, s))
        return [(max(0, a - self.edits), min(b + self.size + self.edits, len(text))) for a, b in out]

    def tells(self, text: bytes, a: int, b: int, window: bool = False) -> bool:
        """Whether the telling words are in a stretch, with the words at its ends; of a window, whether they may be."""
        a = text.rfind(b" ", 0, a + 1) + 1
        b = text.find(b" ", b)
        stretch = text[a : b if b >= 0 else len(text)]
        if self.exact:
            return b" " + self.exact + b" " in b" " + stretch + b" "
        return all(self._told(word, stretch.split(), window) for word in self.told)

    def _told(self, word: bytes, words: list[bytes], window: bool) -> bool:
        """Whether one of the words is near enough; a blank may be lost beside another word of the notice, or be too many."""
        most = TOLD if len(word) > 4 else 1
        near = [w for w in words if apart(w, word) <= most]
        if not near:
            near = [x + y for x, y in zip(words, words[1:], strict=False) if apart(x + y, word) <= most]
        if not near:
            longer = [w for w in words if len(w) > len(word) + most]
            cut = [w[len(o) :] for w in longer for o in self.own if w.startswith(o)] + [w[: -len(o)] for w in longer for o in self.own if w.endswith(o)]
            near = [w for w in cut if apart(w, word) <= most]
        if window or not near:
            return bool(near)
        best = min(near, key=lambda w: apart(w, word))
        return all(apart(best, rival.encode()) >= apart(best, word) for rival in RIVALS.get(word.decode(), ()))

    def _searched(self, text: bytes, a: int, b: int):
        """The best match of a window that the telling words allow."""
        match = self.pattern.search(text, a, b)
        while match and not self.tells(text, *match.span()):
            match = self.pattern.search(text, match.start() + 1, b)
        return match

    def find(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) in bytes of the matches, in order; they don't overlap."""
        # a window without words like the telling ones holds no match; this spares the costly search
        found = (self._searched(text, a, b) for a, b in self.windows(text) if self.tells(text, a, b, window=True))
        out: list[tuple[int, int, int]] = []
        for match in sorted({(m.start(), m.end(), sum(m.fuzzy_counts)) for m in found if m}):
            if not out or match[0] >= out[-1][1]:
                out.append(match)
            elif match[2] < out[-1][2]:
                out[-1] = match
        return out


LIBRARY = [Notice(*x) for x in NOTICES]


def normalised(data: bytes) -> bytes:
    return b" ".join(data.lower().translate(_KEEP).split())


class Counter:
    """Counts the spaces before places that are asked for in ascending order."""

    def __init__(self, text: bytes) -> None:
        self.text, self.at, self.spaces = text, 0, 0

    def before(self, place: int) -> int:
        self.spaces += self.text.count(b" ", self.at, place)
        self.at = place
        return self.spaces


def base_places(padded: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase; padded: normalised text between spaces."""
    out = []
    for phrase, label in PHRASES.items():
        key = b" " + phrase + b" "
        at, words = padded.find(key), Counter(padded)
        while at >= 0:
            out.append((words.before(at), label))
            at = padded.find(key, at + 1)
    return out


def best_of_overlapping(found: list[tuple[int, int, int, Notice]]) -> list[tuple[int, int, int, Notice]]:
    """Matches of all notices in order of their starts, without those that overlap a better one."""
    out: list[tuple[int, int, int, Notice]] = []
    better = lambda x: (x[2] / x[3].size, x[0] - x[1], x[0], x[3].label)
    stretch: list[tuple[int, int, int, Notice]] = []

    def settle() -> None:
        kept: list[tuple[int, int, int, Notice]] = []
        for x in sorted(stretch, key=better):
            if all(x[1] <= y[0] or y[1] <= x[0] for y in kept):
                kept.append(x)
        out.extend(sorted(kept, key=lambda x: x[:3]))

    end = -1
    for x in sorted(found, key=lambda x: x[:3]):  # stretches of matches that overlap each other; matches of one notice do not
        if x[0] >= end:
            settle()
            stretch.clear()
        stretch.append(x)
        end = max(end, x[1])
    settle()
    return out


def scan(data: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int, float]]]:
    """Number of words, places of phrases, and notices as (label, first word, word after the last, edits, similarity)."""
    text = normalised(data)
    padded = b" " + text + b" "
    found = [(a, b, edits, notice) for notice in LIBRARY for a, b, edits in notice.find(text)]
    notices, words = [], Counter(text)
    for a, b, edits, notice in best_of_overlapping(found):
        while a < b and text[a] == 32:
            a += 1
        first = words.before(a)
        notices.append((notice.label, first, first + text.count(b" ", a, max(b - 1, a)) + 1, edits, 1 - edits / notice.size))
    return (text.count(b" ") + 1 if text else 0), base_places(padded) if text else [], notices


def _scanned(batch: pa.RecordBatch) -> dict[str, list]:
    found = [scan(x) for x in utf8(batch)]
    places = [[p for p, _ in base] for _, base, _ in found]
    names = ("label", "start_word", "end_word", "edits", "similarity")
    return {
        "key": batch.column(0),
        "doc_id": batch.column(1),
        "n_words": [n for n, _, _ in found],
        "n_base": [len(p) for p in places],
        "first_word": [min(p, default=None) for p in places],
        "last_word": [max(p, default=None) for p in places],
        "base_labels": [sorted({label for _, label in base}) for _, base, _ in found],
        "notices": [[dict(zip(names, x, strict=True)) for x in more] for _, _, more in found],
    }


def licenses(docs: DataFrame) -> DataFrame:
    """Every row of docs with its words, the places of the phrases and the notices found with their spans."""
    return map_batches(docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text"), _scanned, _RESULT)


def op3_license_scan(docs: DataFrame) -> DataFrame:
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("notices", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("notices", lambda x: x["similarity"])), F.lit(0.0))
    return licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.transform("notices", lambda x: F.concat_ws(":", *(x[k].cast("string") for k in ("label", "start_word", "end_word", "edits")))), ",").alias("notices"),
    )
