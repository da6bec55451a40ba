"""Fuzzy short-notice search for license lines.

A notice of n characters with an error budget of k edits is split into k + 1
pieces; any occurrence with at most k edits holds one piece unchanged.  One
Aho-Corasick pass over the normalised text finds the pieces; the window each
piece implies is then verified with the ``regex`` library's bounded-error
matching, which also gives the span and the number of edits.

Rows: a null or empty text has no words and no findings; repeated rows give
one row each; a null doc_id is carried through; other columns are not read, so
their names are free; an empty table gives an empty result; of overlapping spans
of one notice with equal edits the leftmost stays.  Long texts are scanned whole.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases of the contract (label of each phrase).
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices searched with errors: (notice, label, error budget).
NOTICES = (
    ("all rights reserved", "reserved", 2),
    ("gnu general public license", "gpl", 3),
    ("released under the mit license", "mit", 3),
    ("licensed under the apache license", "apache", 3),
    ("licensed under cc by", "cc-by", 2),
    ("creative commons attribution", "cc-by", 3),
    ("mozilla public license", "mpl", 2),
    ("redistribution and use in source and binary forms", "bsd", 5),
    ("permission is hereby granted free of charge", "mit", 4),
)

SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}

SCHEMA = (
    "doc_id long, n_words long, base array<struct<label:string,first:long>>, "
    "spans array<struct<label:string,notice:string,start:long,end:long,edits:int>>"
)


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """The notice cut into k + 1 pieces: (offset, piece)."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def normalise(text: str) -> str:
    """Words in order, joined by one space (A-Z lower-cased)."""
    return SEPARATORS.sub(" ", text.translate(UPPER)).strip(" ")


def disjoint(found: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Spans in order, none overlapping another: fewest edits first, then the
    leftmost."""
    kept: list[tuple[int, int]] = []
    for span in sorted(found, key=lambda s: (found[s], s)):
        at = bisect.bisect_left(kept, span)
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
            kept.insert(at, span)
    return kept


class Scanner:
    def __init__(self, notices=NOTICES, base=BASE_PHRASES):
        import ahocorasick
        import regex

        self.base = [(f" {p} ", label) for p, label in base.items()]
        self.notices = notices
        self.fuzzy = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in notices]
        self.seeds = ahocorasick.Automaton()
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k) in enumerate(notices):
            for off, piece in pieces(n, k):
                by_piece.setdefault(piece, []).append((i, off))
        for piece, where in by_piece.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()

    def spans(self, norm: str) -> list[dict]:
        """Verified spans of all notices in a normalised text.  Every window
        about a seed is searched for its best match; of overlapping matches of
        a notice the one with the fewest edits stays, then the leftmost."""
        windows: dict[int, set[int]] = {}
        for end, (size, where) in self.seeds.iter(norm):
            for i, off in where:
                windows.setdefault(i, set()).add(max(0, end + 1 - size - off - self.notices[i][2]))
        out = []
        for i, starts in sorted(windows.items()):
            n, label, k = self.notices[i]
            found = {}
            for lo in sorted(starts):
                m = self.fuzzy[i].search(norm, lo, min(lo + len(n) + 3 * k, len(norm)))
                if m:
                    found[m.start(), m.end()] = sum(m.fuzzy_counts)
            for start, end in disjoint(found):
                out.append({"label": label, "notice": n, "start": start, "end": end, "edits": found[start, end]})
        return out

    def scan(self, text: str | None) -> tuple[int, list[dict], list[dict]]:
        norm = normalise(text or "")
        if not norm:
            return 0, [], []
        padded = f" {norm} "
        base = []
        for phrase, label in self.base:
            at, seen, word = padded.find(phrase), 0, 0
            while at >= 0:
                word += padded.count(" ", seen, at)
                seen = at
                base.append({"label": label, "first": word})
                at = padded.find(phrase, at + 1)
        return norm.count(" ") + 1, base, self.spans(norm)


def scan_licenses(docs: DataFrame, notices=NOTICES) -> DataFrame:
    """doc_id, n_words, base phrase places and verified fuzzy spans (character
    offsets in the normalised text) per row of ``docs``."""

    def run(batches):
        scanner = Scanner(notices)
        for b in batches:
            got = [scanner.scan(t) for t in b.column("text").to_pylist()]
            cols = [b.column("doc_id"), *([g[i] for g in got] for i in range(3))]
            yield pa.RecordBatch.from_arrays(
                [cols[0], pa.array(cols[1], pa.int64()), pa.array(cols[2], BASE_T), pa.array(cols[3], SPAN_T)],
                names=["doc_id", "n_words", "base", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


BASE_T = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))
SPAN_T = pa.list_(
    pa.struct([("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
)


def license_report(found: DataFrame) -> DataFrame:
    """Contract columns.  The score is 1 for a base phrase, else 1 minus the
    share of edited characters of the best span, else 0."""
    labels = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(c)))
    quality = F.transform("spans", lambda s: 1 - s["edits"] / F.length(s["notice"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["first"])).alias("last_word"),
        labels(F.transform("base", lambda b: b["label"])).alias("base_labels"),
        labels(F.concat(F.transform("base", lambda b: b["label"]), F.transform("spans", lambda s: s["label"]))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(quality), F.lit(0.0))).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
