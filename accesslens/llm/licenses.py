"""License scans: fuzzy search for short notices.

A text becomes its words, A-Z lower-cased, joined by one blank, so that layout and
punctuation cannot hide a notice. Every notice has a number of edits (characters
inserted, deleted or replaced) that it may be off by. A notice with ``k`` edits is
split into ``k + 1`` seeds: by the pigeonhole principle one of them stands
unchanged in every occurrence, at most ``k`` characters from its place. One
Aho-Corasick automaton holds the seeds of all notices and locates them in one pass.
Around them lie the candidate windows; windows of a notice that meet are joined,
so a seed that a text repeats throughout costs one pass over that text. There the
``regex`` library matches the notice with its bounded number of errors, between
word borders, and counts the edits. Base phrases are notices without edits: they
are their own only seed.

Spans are reported in code points of the original text. ``score`` is the best of
``1 - edits / length`` over all spans, 1 for a base phrase and 0 without any.

A map over rows: nothing moves, and a task holds one batch of texts. Defined
cases: a null text is empty; empty texts have no words, labels ``''`` and score 0;
overlapping notices are all reported; rows alike each have a row of their own,
null ids too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from accesslens.llm.common import text_of

# Phrases whose places are counted, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, edits allowed, notice in normal form (lower case, words joined by one blank).
NOTICES = (
    ("mit", 0, "mit licence"),
    ("mit", 3, "released under the mit license"),
    ("mit", 3, "licensed under the mit license"),
    ("mit", 4, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", 1, "apache licence"),
    ("apache", 4, "licensed under the apache license version 2 0"),
    ("gpl", 1, "general public licence"),
    ("gpl", 4, "licensed under the gnu general public license"),
    ("gpl", 4, "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 2, "gnu lesser general public license"),
    ("agpl", 2, "gnu affero general public license"),
    ("mpl", 2, "mozilla public license"),
    ("bsd", 4, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", 4, "permission to use copy modify and or distribute this software for any purpose"),
    ("cc-by", 1, "licensed under cc by 4 0"),
    ("cc-by-nc", 1, "licensed under cc by nc 4 0"),
    ("cc-by-sa", 1, "licensed under cc by sa 4 0"),
    ("cc", 2, "creative commons attribution"),
    ("public-domain", 3, "released into the public domain"),
    ("proprietary", 1, "all rights reserved"),
)

# Bytes of UTF-8: digits, letters and what is beyond ASCII stay, the rest parts words.
NORMAL = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

Span = tuple[int, int, str, int, int]  # first character, end, label, edits, the notice's length


def normal(text: str) -> str:
    """The words of a text, lower-cased, with a blank before and after each."""
    words = text.encode("utf-8", "replace").translate(NORMAL).split()
    return f" {b' '.join(words).decode()} " if words else " "


def seeds_of(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces with their places, of even length."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Seeds of all notices in one automaton, and a bounded-error expression for each notice."""

    def __init__(self, base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, int, str]]):
        self.base, self.notices = base, notices
        # A match begins with the blank before it, which is not part of it.
        self.fuzzy = [regex.compile(rf"(?e) (?:{regex.escape(n, literal_spaces=True)}){{e<={k}}}(?= )") for _, k, n in notices]
        found: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for at, (phrase, _) in enumerate(base):
            found[f" {phrase} "].append((-1 - at, 0, 0))
        for at, (_, k, notice) in enumerate(notices):
            for place, seed in seeds_of(notice, k):
                # From a seed's last character to both ends of its window, blanks included.
                end = place + len(seed) - 1
                found[seed].append((at, end + k + 1, len(notice) - end + k + 1))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in found.items():
            self.automaton.add_word(seed, uses)
        self.automaton.make_automaton()

    def scan(self, form: str) -> tuple[list[Span], list[Span]]:
        """Places of base phrases and spans of notices, each by their start in the normal form."""
        places, windows = [], defaultdict(list)
        for last, uses in self.automaton.iter(form):
            for at, before, after in uses:
                if at < 0:
                    phrase, label = self.base[-1 - at]
                    places.append((last - len(phrase), last, label, 0, len(phrase)))
                    continue
                # Seeds come by their ends, so a window can only meet the latest ones.
                runs, a, b = windows[at], max(0, last - before), last + after
                while runs and a <= runs[-1][1]:
                    c, d = runs.pop()
                    a, b = min(a, c), max(b, d)
                runs.append((a, b))
        spans = []
        for at, runs in windows.items():
            label, _, notice = self.notices[at]
            for a, b in runs:
                for match in self.fuzzy[at].finditer(form, a, b):
                    spans.append((match.start() + 1, match.end(), label, sum(match.fuzzy_counts), len(notice)))
        return sorted(places), sorted(spans)


@cache
def scanner(base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, int, str]]) -> Scanner:
    return Scanner(base, notices)


def in_text(text: str, form: str, spans: list[Span]) -> list[dict]:
    """Spans of the normal form as spans of the original text."""
    if not spans:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    found, at, word = [], 0, 0
    for start, end, label, edits, _ in spans:  # by start, so that blanks are counted once
        word, at = word + form.count(" ", at, start), start
        last = word - 1 + form.count(" ", start, end)
        found.append({"label": label, "start": words[word - 1][0], "end": words[last][1], "edits": edits})
    return found


SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]))


def scan_licenses(
    docs: DataFrame,
    spans: bool = True,
    base: Sequence[tuple[str, str]] = BASE,
    notices: Sequence[tuple[str, int, str]] = NOTICES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start), ``base_labels``, ``labels``, ``score`` and, if asked
    for, ``spans`` (label, start, end, edits)."""
    rows = docs.select("doc_id", text_of(docs).alias("_text"))
    base, notices = tuple(base), tuple(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(base, notices)
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                yield scan_part(own, part)

    def scan_part(own: Scanner, part: pa.RecordBatch) -> pa.RecordBatch:
        out = defaultdict(list)
        for text in part.column("_text"):
            text = text.as_py()
            form = normal(text)
            places, found = own.scan(form)
            out["n_words"].append(form.count(" ") - 1)
            out["n_base"].append(len(places))
            out["first_word"].append(form.count(" ", 0, places[0][0]) - 1 if places else None)
            out["last_word"].append(form.count(" ", 0, places[-1][0]) - 1 if places else None)
            labels = {place[2] for place in places}
            every = sorted({*places, *found})
            out["base_labels"].append(",".join(sorted(labels)))
            out["labels"].append(",".join(sorted(labels | {span[2] for span in found})))
            out["score"].append(max((max(0.0, 1 - edits / size) for *_, edits, size in every), default=0.0))
            if spans:
                out["spans"].append(in_text(text, form, every))
        kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": SPANS}
        columns = {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()}
        return pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **columns})

    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
    kind += "last_word long, base_labels string, labels string, score double"
    if spans:
        kind += ", spans array<struct<label:string,start:long,end:long,edits:long>>"
    return rows.mapInArrow(run, kind)

