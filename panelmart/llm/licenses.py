"""License scans: exact phrases plus fuzzy short-notice search.

Every notice is a short normalised string.  A notice that may be off by ``k``
edits is split into ``k + 1`` pieces; by the pigeonhole principle an occurrence
with at most ``k`` edits holds at least one piece unchanged, so one
Aho-Corasick pass over a document's normalised text finds every candidate
place.  The ``regex`` library's bounded-error matching then verifies the
candidate window, counts the edits and reports the span.

One map-only pass, no shuffle: each document is judged on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The base phrases with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices (lower case, words joined by one space) by label.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc0", "licensed under cc0 1 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
]
EDIT_SHARE = 0.1  # edits allowed per character of a notice

SPAN = "array<struct<label:string,first_word:long,n_words:long,edits:int,span:string>>"
SCHEMA_TAIL = (f"n_words long, n_base long, first_word long, last_word long, base_labels string, "
               f"labels string, score double, spans {SPAN}")

# Byte table of the word contract: A-Z to lower case, every ASCII byte that is
# neither digit nor letter to a space, bytes from 0x80 up (non-ASCII) kept.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                   for b in range(256))


def edit_bound(notice: str, share: float = EDIT_SHARE) -> int:
    return max(1, int(len(notice) * share))


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of near-equal length with their offsets."""
    n = len(notice)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(cuts[i], notice[cuts[i]:cuts[i + 1]]) for i in range(k + 1)]


class NoticeSearch:
    """Compiled automaton and verifiers; one per Python worker."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple[str, str]], share: float):
        import ahocorasick
        import regex

        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.rarest = [max(p.split(), key=len).encode() for p in phrases]
        self.notices, seeds = [], {}
        for i, (label, notice) in enumerate(notices):
            k = edit_bound(notice, share)
            self.notices.append((label, len(notice), k,
                                 regex.compile(f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={k}}}", regex.BESTMATCH)))
            for at, seed in pieces(notice, k):
                seeds.setdefault(seed, []).append((i, at))
        self.machine = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.machine.add_word(seed, (len(seed), uses))
        self.machine.make_automaton()

    def base(self, padded: bytes) -> list[tuple[int, str]]:
        """(word number, label) of every place of every base phrase; ``padded`` is the
        normalised text with a space on either side."""
        found = []
        for phrase, label in self.phrases:
            at = padded.find(phrase)
            while at >= 0:
                found.append((padded.count(b" ", 0, at), label))
                at = padded.find(phrase, at + 1)
        return found

    def fuzzy(self, norm: str) -> list[tuple[str, int, int, int, str]]:
        """Verified notices: (label, first word, words, edits, span), overlaps resolved
        in favour of the smaller edit rate, then the longer notice."""
        wanted: dict[int, list[tuple[int, int]]] = {}
        for end, (size, uses) in self.machine.iter(norm):
            for i, at in uses:
                _, length, k, _ = self.notices[i]
                lo = max(0, end - size + 1 - at - k)
                hi = end - size + 1 - at + length + k
                runs = wanted.setdefault(i, [])
                if runs and lo <= runs[-1][1]:  # windows of one notice melt together
                    runs[-1] = (min(lo, runs[-1][0]), max(hi, runs[-1][1]))
                else:
                    runs.append((lo, hi))
        hits = []
        for i, runs in wanted.items():
            label, length, k, verify = self.notices[i]
            for lo, hi in runs:
                for m in verify.finditer(norm, lo, min(hi, len(norm))):
                    a, b = m.span()
                    while a < b and norm[a] == " ":
                        a += 1
                    while b > a and norm[b - 1] == " ":
                        b -= 1
                    edits = sum(m.fuzzy_counts)
                    hits.append((edits / length, -length, a, b, label, edits))
        kept: list[tuple] = []
        for hit in sorted(hits):
            if all(hit[3] <= x[2] or hit[2] >= x[3] for x in kept):
                kept.append(hit)
        return [(label, norm.count(" ", 0, a), norm.count(" ", a, b) + 1, edits, norm[a:b], 1 - rate)
                for rate, _, a, b, label, edits in sorted(kept, key=lambda x: x[2])]

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode().translate(WORD_BYTES).split()
        norm = b" ".join(words)
        base = self.base(b" " + norm + b" ") if any(w in norm for w in self.rarest) else []
        spans = self.fuzzy(norm.decode()) if words else []
        base_labels = sorted({label for _, label in base})
        labels = sorted({*base_labels, *(s[0] for s in spans)})
        score = 1.0 if base else max((s[5] for s in spans), default=0.0)
        places = [w for w, _ in base]
        return (len(words), len(base), min(places, default=None), max(places, default=None),
                ",".join(base_labels), ",".join(labels), float(score),
                [dict(zip(("label", "first_word", "n_words", "edits", "span"), s[:5])) for s in spans])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str]] = NOTICES,
                  share: float = EDIT_SHARE) -> DataFrame:
    """License phrases and notices of every document.

    Returns ``id_col``, n_words, n_base, first_word, last_word, base_labels, labels,
    score and spans (verified notices with their edits).  Null or empty text: no
    words, no place, empty label strings, score 0.  Null ids and repeated rows are
    kept, one result per input row; other columns are not read.  An empty table
    gives an empty result.  Text of any length is searched whole.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {SCHEMA_TAIL}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = NoticeSearch(phrases, notices, share)
        tail = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                 pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                     ("edits", pa.int32()), ("span", pa.string())])))
        for batch in batches:
            out = [search.scan(t.as_py()) for t in batch.column(1)]
            cols = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [id_col, *tail])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
