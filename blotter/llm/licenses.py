"""License scan: fuzzy search for short notices.

A text becomes its words (A-Z in lower case) joined by single blanks.  Every
notice may differ by a bounded number of edits k.  It is split into k + 1
pieces, of which one must stand in the text unchanged (pigeonhole); one
Aho-Corasick pass over the text finds all pieces of all notices, and only the
windows around hits are matched with the regex library's bounded-error search,
which gives the span and the number of edits.  An edit may not change what tells licences apart:
the marking words (``MARKS``: nc, nd, sa, lesser, affero) of a span must be those of its notice.  Of overlapping spans the one
with the fewest edits for its length stays, of equal ones the longest.  The time grows with the text,
also where a notice is repeated a million times.

Besides, the exact base phrases are counted and placed.  Null texts count as
empty; empty texts have no words and no labels; a very long text is scanned whole, by one task.  Every row is scanned by
itself: repeated rows give equal results, an empty table an empty one.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Short notices as they are usually written, with their labels.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under the creative commons attribution"),
    ("cc-by", "licensed under cc by"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nc-nd", "licensed under cc by nc nd"),
    ("cc-by-nc-sa", "licensed under cc by nc sa"),
    ("cc-by-nd", "licensed under cc by nd"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "dedicated to the public domain"),
    ("epl", "eclipse public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "mozilla public license"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
# Words that tell licences of one family apart.
MARKS = frozenset({"nc", "nd", "sa", "lesser", "affero"})
# One edit for each so many characters of a notice.
CHARS_PER_EDIT = 12
# Fixed value: words are runs of bytes of 0-9, a-z and everything beyond ASCII.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TO_WORDS).split()


def base_places(joined: bytes, starts: np.ndarray) -> list[tuple[int, str]]:
    """(start word, label) of each place of a base phrase; ``joined`` has a blank
    before each word and at the end, ``starts`` the places of these blanks."""
    out = []
    for phrase, label in BASE.items():
        key = b" " + phrase.encode() + b" "
        places = []
        at = joined.find(key)
        while at >= 0:
            places.append(at)
            at = joined.find(key, at + 1)
        out += [(int(w), label) for w in np.searchsorted(starts, places)]
    return out


def _blanks(lengths) -> np.ndarray:
    """Where the blank before each word stands, from the words' lengths."""
    sizes = np.fromiter(lengths, dtype=np.int64)
    return np.cumsum(sizes + 1) - (sizes + 1)


class NoticeSearch:
    """The automaton of the pieces and the bounded-error patterns of the notices."""

    def __init__(self, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        self.notices = notices
        self.edits = [max(1, len(t) // chars_per_edit) for _, t in notices]
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(t, literal_spaces=True)}){{e<={k}}}") for (_, t), k in zip(notices, self.edits, strict=True)]
        self.marks = [sorted(w for w in t.split(" ") if w in MARKS) for _, t in notices]
        self.pieces: dict[tuple[int, int], int] = {}
        self.seeds = ahocorasick.Automaton()
        for which, (_, t) in enumerate(notices):
            parts = self.edits[which] + 1
            cuts = [len(t) * i // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):  # noqa: B905
                self.pieces[which, a] = b - a
                self.seeds.add_word(t[a:b], [*self.seeds.get(t[a:b], []), (which, a)])
        self.seeds.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, edits, length of the notice) of the spans that stay."""
        windows: dict[int, list[list[int]]] = {}
        for end, hits in self.seeds.iter(text):
            for which, offset in hits:
                notice = self.notices[which][1]
                # the notice would start here, give or take the edits
                start = end + 1 - self.pieces[which, offset] - offset
                lo, hi = max(0, start - self.edits[which]), min(len(text), start + len(notice) + self.edits[which])
                own = windows.setdefault(which, [])
                if own and lo <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(lo, own[-1][0]), max(hi, own[-1][1])
                else:
                    own.append([lo, hi])
        found = []
        for which, own in windows.items():
            label, notice = self.notices[which]
            for lo, hi in own:
                for m in self.patterns[which].finditer(text, lo, hi):
                    if self._marks(text, m.start(), m.end()) == self.marks[which]:
                        found.append((m.start(), m.end(), label, sum(m.fuzzy_counts), len(notice)))
        found.sort(key=lambda x: (x[3] / x[4], -x[4], x[0]))
        taken = bytearray(len(text))
        kept: list[tuple[int, int, str, int, int]] = []
        for x in found:
            if taken.find(1, x[0], x[1]) < 0:
                taken[x[0] : x[1]] = b"\x01" * (x[1] - x[0])
                kept.append(x)
        return sorted(kept)

    @staticmethod
    def _marks(text: str, start: int, end: int) -> list[str]:
        """The marking words that a span touches, whole."""
        while start > 0 and text[start - 1] != " " and text[start] != " ":
            start -= 1
        until = text.find(" ", max(start, end - 1))
        return sorted(w for w in text[start : until if until >= 0 else len(text)].split(" ") if w in MARKS)


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])
_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN)),
]
_SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,last_word:long,edits:int>>"


def scan_text(text: str | None, search: NoticeSearch) -> dict:
    """What one text says: counts, places, labels, score and spans (in words).
    The score is 1 with a base phrase, else 1 less the edits of the best span
    per character of its notice, else 0."""
    words = words_of(text or "")
    joined = b" " + b" ".join(words) + b" "
    base = base_places(joined, _blanks(map(len, words)))
    plain = joined.decode("utf-8", "replace")
    starts = _blanks(map(len, plain[1:-1].split(" "))) if words else np.zeros(0, dtype=np.int64)
    spans = search.find(plain)
    # a span that starts on a blank starts with the word after it
    firsts = np.searchsorted(starts, [s[0] for s in spans], side="right") - 1
    lasts = np.searchsorted(starts, [s[1] - 1 for s in spans], side="right") - 1
    at = [p for p, _ in base]
    base_labels = {x for _, x in base}
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(at, default=None),
        "last_word": max(at, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {s[2] for s in spans})),
        "score": 1.0 if base else max((1.0 - s[3] / s[4] for s in spans), default=0.0),
        "spans": [{"label": s[2], "first_word": max(0, int(a)), "last_word": min(max(0, int(b)), len(words) - 1), "edits": s[3]} for s, a, b in zip(spans, firsts, lasts, strict=True)],
    }


def _scanning(notices: Sequence[tuple[str, str]]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = NoticeSearch(notices)
        for b in batches:
            rows = [scan_text(t, search) for t in b.column("text").to_pylist()]
            columns = [pa.array([r[n] for r in rows], type=t) for n, t in _FIELDS]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", *[n for n, _ in _FIELDS]])

    return scan


def license_scan(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans``.  ``notices`` are (label, notice) with the
    words of the notice in lower case, joined by single blanks."""
    return docs.select("doc_id", F.col("text")).mapInArrow(_scanning(tuple(notices)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_SCHEMA}")
