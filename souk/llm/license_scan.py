"""License scans: fuzzy search for short notices.

Texts are lower-cased (A-Z) and reduced to words of letters, digits and
non-ASCII signs.  Base places are those where a phrase's words stand
consecutively.

Fuzzy search: a phrase that may carry e edits is cut into e + 1 pieces, of
which one must occur unchanged.  Exact finds of the pieces give candidate
windows; there the ``regex`` library matches the phrase with at most e edits,
and the span and its edits are reported if it starts and ends at word bounds.

Null and empty texts have no words, places or labels and score 0.  Repeated
rows give repeated results.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.shared import slices, utf8

# Base phrases and labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Phrases searched with edits, besides the base ones.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "boost software license": "bsl",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software": "unlicense",
}
#: One edit for this many characters of a phrase; shorter ones are exact.
CHARS_PER_EDIT = 9

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B))
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD or c >= 0x80 else 0x20 for c in range(256))


def normal(text: bytes) -> bytes:
    """The text's words, each with one space before and after it."""
    words = text.translate(_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b" "


@dataclass(frozen=True)
class Notice:
    phrase: bytes
    label: str
    edits: int
    pieces: tuple[tuple[int, bytes], ...]  # place in the phrase, piece
    pattern: object


def notices(phrases: dict[str, str], chars_per_edit: int = CHARS_PER_EDIT) -> list[Notice]:
    out = []
    for phrase, label in phrases.items():
        raw = phrase.encode()
        edits = len(raw) // chars_per_edit
        cuts = [len(raw) * i // (edits + 1) for i in range(edits + 2)]
        pieces = tuple((a, raw[a:b]) for a, b in zip(cuts, cuts[1:]))
        pattern = regex.compile(b"(?be)(?<= )(?:" + regex.escape(raw) + b"){e<=%d}(?= )" % edits)
        out.append(Notice(raw, label, edits, pieces, pattern))
    return out


@dataclass(frozen=True)
class Span:
    """A notice found: words first to last (end exclusive) and its edits."""
    label: str
    first: int
    last: int
    edits: int
    phrase: str


def _places(data: bytes, phrase: bytes) -> list[int]:
    """Byte places of all occurrences, overlapping ones too."""
    out, at = [], data.find(phrase)
    while at >= 0:
        out.append(at)
        at = data.find(phrase, at + 1)
    return out


def _word_numbers(data: bytes, places: list[int]) -> list[int]:
    """The number of spaces before each place, for ascending places."""
    out, at, n = [], 0, 0
    for place in places:
        n += data.count(b" ", at, place)
        at = place
        out.append(n)
    return out


def exact(data: bytes, phrases: dict[str, str]) -> list[Span]:
    """Base places in a normalised text."""
    out = []
    for phrase, label in phrases.items():
        size = phrase.count(" ") + 1
        places = _places(data, b" " + phrase.encode() + b" ")
        out += [Span(label, first, first + size, 0, phrase) for first in _word_numbers(data, places)]
    return out


def fuzzy(data: bytes, search: list[Notice]) -> list[Span]:
    """Spans within the bounded number of edits of a phrase.  Each candidate
    is matched in a window of its own, just wide enough for the phrase and its
    edits, so the work grows with the text.  Of overlapping spans of a phrase
    the one with fewer edits stays, then the earlier."""
    out = []
    for notice in search:
        reach, found = notice.edits + 1, set()
        for at in sorted({at - place for place, piece in notice.pieces for at in _places(data, piece)}):
            found.update((m.start(), m.end(), sum(m.fuzzy_counts)) for m in notice.pattern.finditer(
                data, max(0, at - reach), min(len(data), at + len(notice.phrase) + reach)))
        kept: list[tuple[int, int, int]] = []
        for span in sorted(found):
            if not kept or span[0] >= kept[-1][1]:
                kept.append(span)
            elif span[2] < kept[-1][2]:
                kept[-1] = span
        for (a, b, edits), n in zip(kept, _word_numbers(data, [a for a, _, _ in kept])):
            out.append(Span(notice.label, n - 1, n + data.count(b" ", a, b), edits, notice.phrase.decode()))
    return out


def scan(text: bytes, search: list[Notice], base: dict[str, str] = BASE) -> tuple[int, list[Span], list[Span]]:
    """Number of words, base places and fuzzy spans of one text."""
    data = normal(text)
    return data.count(b" ") - 1, exact(data, base), fuzzy(data, search)


_SPAN = "struct<label:string,first:bigint,last:bigint,edits:int,phrase:string>"


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE,
          more: dict[str, str] = MORE, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """(id, n_words, base, fuzzy): all base places and fuzzy spans of every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    names = ("label", "first", "last", "edits", "phrase")
    arrow = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                                ("edits", pa.int32()), ("phrase", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = notices({**base, **more}, chars_per_edit)
        rows = lambda found: [{n: getattr(s, n) for n in names} for s in found]
        for part in slices(batches, "text"):
            found = [scan(x, search, base) for x in utf8(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([n for n, _, _ in found], pa.int64()),
                 pa.array([rows(b) for _, b, _ in found], arrow), pa.array([rows(f) for _, _, f in found], arrow)],
                ["id", "n_words", "base", "fuzzy"])

    return (source.mapInArrow(run, f"id {kind}, n_words bigint, base array<{_SPAN}>, fuzzy array<{_SPAN}>")
            .withColumnRenamed("id", id_col))


def labels(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One line per row of ``spans``: counts, first and last base word, labels
    and a score: 1 less the share of edits of the best span, 0 without any."""
    every = F.concat("base", "fuzzy")
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda s: s["label"]))), ",")
    best = F.array_max(F.transform(every, lambda s: F.lit(1.0) - s["edits"] / F.length(s["phrase"])))
    start = F.transform("base", lambda s: s["first"])
    return found.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        listed("base").alias("base_labels"), listed(every).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"), F.size("fuzzy").cast("long").alias("n_fuzzy"))
