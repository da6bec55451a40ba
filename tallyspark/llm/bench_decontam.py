"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is split into k + 1 pieces: any
copy within the budget holds one piece unchanged.  One Aho-Corasick pass over
each whole normalised text finds the pieces, and Myers' bit-parallel distance
verifies the window each piece implies.

The items are read to the driver in blocks of at most ``BLOCK_CHARS``
characters and every block makes its own pass over the documents, so the
automaton a task holds is bounded however long the benchmark is.

Items shorter than ``MIN_CHARS`` after normalisation have no error budget: the
whole item is its one piece, and an exact copy counts where it does not begin
or end inside a word.  Scripts written without spaces have no such limits.

Rows: null or empty texts match nothing; items that are null or empty after
normalisation are not searched.  Repeated rows and repeated items give one
match each.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_SHARE = 0.05
MIN_CHARS = 40
BLOCK_CHARS = 4 << 20

SCHEMA = "doc_id long, item_id long, edits int, start long, end long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
UPPER = {i: i + 32 for i in range(65, 91)}
# Scripts without spaces between words: Thai to Myanmar, Khmer, CJK with kana, Yi.
UNSPACED = re.compile(r"[\u0E00-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF]")


def normalise(text: str) -> str:
    return SPACE.sub(" ", text.translate(UPPER)).strip(" ")


def budget(n: int, share: float = ERROR_SHARE) -> int:
    return max(1, int(n * share)) if n >= MIN_CHARS else 0


def in_word(c: str) -> bool:
    return (c == "_" or unicodedata.category(c)[0] in "LMN") and not UNSPACED.match(c)


def splits_word(text: str, at: int) -> bool:
    """Whether a cut before character ``at`` parts a word in two."""
    return 0 < at < len(text) and in_word(text[at - 1]) and in_word(text[at])


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to a substring of ``text`` and where
    that substring ends; None above ``most``."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


class Matcher:
    """Finds every item of one block in a text."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        import ahocorasick

        self.items = [(i, t, budget(len(t), share)) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t, most) in enumerate(self.items):
            cuts = [len(t) * c // (most + 1) for c in range(most + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                where.setdefault(t[a:b], []).append((k, a))
        self.seeds = ahocorasick.Automaton()
        for piece, at in where.items():
            self.seeds.add_word(piece, (len(piece), at))
        self.seeds.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the best match of each found item."""
        windows: dict[int, list[list[int]]] = {}
        exact: dict[int, tuple[int, int]] = {}
        for end, (size, at) in self.seeds.iter(text):
            for k, off in at:
                _, t, most = self.items[k]
                if not most:
                    if k not in exact and not splits_word(text, end + 1 - size) and not splits_word(text, end + 1):
                        exact[k] = (end + 1 - size, end + 1)
                    continue
                lo = max(0, end + 1 - size - off - most)
                hi = min(len(text), end + 1 - size - off + len(t) + most)
                got = windows.setdefault(k, [])
                while got and lo <= got[-1][1]:
                    a, b = got.pop()
                    lo, hi = min(lo, a), max(hi, b)
                got.append([lo, hi])
        out = [(self.items[k][0], 0, *span) for k, span in exact.items()]
        for k, spans in windows.items():
            item, t, most = self.items[k]
            best = None
            for lo, hi in spans:
                at = text.find(t, lo, hi)
                got = (0, at - lo + len(t)) if at >= 0 else myers(t, text[lo:hi], most)
                if got and (best is None or got[0] < best[1]):
                    best = (item, got[0], max(0, lo + got[1] - len(t)), lo + got[1])
            if best:
                out.append(best)
        return out


def item_blocks(benchmark: DataFrame, limit: int):
    """Blocks of normalised items, streamed to the driver one at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").filter("text is not null").distinct().toLocalIterator():
        t = normalise(row["text"])
        if not t:
            continue
        if block and size + len(t) > limit:
            yield block
            block, size = [], 0
        block.append((row["item_id"], t))
        size += len(t)
    if block:
        yield block


def find_items(docs: DataFrame, benchmark: DataFrame, share: float = ERROR_SHARE, limit: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edits,
    start, end (characters of the normalised text)."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], SCHEMA)
    first = True
    for block in item_blocks(benchmark, limit):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, share)
            for b in batches:
                found = [
                    (d, *hit)
                    for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
                    if t
                    for hit in matcher.find(normalise(t))
                ]
                cols = list(zip(*found, strict=True)) if found else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "edits", "start", "end"]
                )

        got = docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
        out, first = (got if first else out.union(got)), False
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = ERROR_SHARE, limit: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns."""
    for block in item_blocks(benchmark, limit):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, share)
            for b in batches:
                clean = [not (t and matcher.find(normalise(t))) for t in b.column("text").to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
