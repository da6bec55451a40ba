"""SimHash near-duplicates by bit-sliced comparison.

A text's words (A-Z lower-cased, split at ASCII white space) give 3-word
shingles, repeats included (with fewer words the whole sequence is one); each
shingle is hashed with XXH64 (seed 42).  A fingerprint bit is 1 if it is set in
over half of the hashes.  Fingerprints that differ in at most ``RADIUS`` bits
are linked, and a document's component is named by the smallest doc_id that it
reaches.

Equal fingerprints are one node.  Candidates share one of four masked parts of
the 64 bits (with three errors one part is free of them).  A part's bucket with
more than ``LEAF`` fingerprints is split again over four parts of its remaining
bits, which keeps every pair by the same argument; after ``len(LEVELS)`` levels
at most 13 bits are free, so every bucket is bounded without a cap.  No bucket
is ever held by one task before it is known to be small: sizes are counted
first, by aggregation.

Inside a bucket the fingerprints are stored as 64 vertical bit planes, 64
candidates to a word.  One query is compared with a word of candidates at once:
its differing planes are added by carry-save adders into two bitwise counter
planes with an overflow plane, and a word is abandoned once all its candidates
have left the radius.  A bucket gives the edges of a spanning forest of its
links, not its pairs.

Rows: a null, empty or blank text has the fingerprint zero and is linked like
any other.  A null doc_id keeps its fingerprint and links but names no
component: its component_id is the smallest doc_id reachable, or null.  Rows
that repeat a doc_id give a row each; those of one doc_id are not linked by
that.  Ties cannot occur (the smallest id is unique); an empty table gives an
empty result; other columns are not read.  A text of any length is hashed in
pieces of ``PIECE`` bytes, so memory does not grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages, components, flat_bytes

WORDS = 3
SEED = 42
BITS = 64
RADIUS = 3
LEAF = 8192
PARTS = RADIUS + 1
PIECE = 1 << 20
TILE = 1 << 14  # (query, word) entries compared at a time

U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LANES = U(0x0101010101010101)


# ------------------------------------------------------------- fingerprints


def pieces(text: memoryview, size: int = PIECE) -> Iterator[bytes]:
    """Pieces of a text that end at white space (or with the text); a word
    longer than ``size`` makes its piece longer."""
    lo, n = 0, len(text)
    while lo < n:
        hi = min(n, lo + size)
        while hi < n:
            tail = bytes(text[max(lo, hi - 4096) : hi])
            cut = max(tail.rfind(s) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut >= 0:
                hi = hi - len(tail) + cut + 1
                break
            hi = min(n, hi + 4096)
        yield bytes(text[lo:hi])
        lo = hi


def shingle_hashes(text: memoryview) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of one text, a piece at a time."""
    carry: list[bytes] = []
    seen = False
    for piece in pieces(text):
        words = carry + piece.translate(_LOWER).split()
        if len(words) < WORDS:
            carry = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[: -WORDS] + 1]).tolist()
        digest = xxhash.xxh64_intdigest
        yield np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist(), strict=True)), U, len(starts)
        )
        seen, carry = True, words[-(WORDS - 1) :]
    if not seen and carry:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], U)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set: eight bits at a time in the
    byte lanes of a word, over at most 255 words before the lanes are read."""
    out = np.zeros(BITS, np.int64)
    if not len(hashes):
        return out
    at = np.arange(0, len(hashes), 255)
    for b in range(8):
        lanes = np.add.reduceat((hashes >> U(b)) & _LANES, at)
        out[b::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: memoryview) -> int:
    counts, n = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(text):
        counts += bit_counts(h)
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view(U)[0]) if n else 0


def sign(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""

    def run(batches):
        for b in batches:
            data, offs = flat_bytes(b.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            got = np.fromiter((fingerprint(view[offs[i] : offs[i + 1]]) for i in range(len(offs) - 1)), U, len(offs) - 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------ buckets


def _split(mask: int) -> list[int]:
    """``mask`` plus a fourth of the remaining bits, for each fourth."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [round(i * len(free) / PARTS) for i in range(PARTS + 1)]
    return [mask | sum(1 << b for b in free[cuts[i] : cuts[i + 1]]) for i in range(PARTS)]


def _levels() -> list[dict[int, list[int]]]:
    """Masks by the mask that they refine, until a bucket is bounded."""
    out, masks = [], [0]
    while any(1 << (BITS - m.bit_count()) > LEAF for m in masks):
        out.append({m: _split(m) for m in masks})
        masks = sorted({x for xs in out[-1].values() for x in xs})
    return out


LEVELS = _levels()


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def keyed(rows: DataFrame, level: int) -> DataFrame:
    """(mask, key, fp) of the rows (mask, fp) under the masks of a level."""
    spark = rows.sparkSession
    if level == 0:
        children = F.array(*[F.lit(_signed(m)) for m in LEVELS[0][0]])
        out = rows.select(F.explode(children).alias("mask"), "fp")
    else:
        # at most PARTS ** level rows: a constant of the method
        table = [(_signed(m), [_signed(x) for x in xs]) for m, xs in LEVELS[level].items()]
        small = F.broadcast(spark.createDataFrame(table, "mask long, next array<long>"))
        out = rows.join(small, "mask").select(F.explode("next").alias("mask"), "fp")
    return out.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


# --------------------------------------------------- bit-sliced comparison


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 x words: plane b holds bit b of every fingerprint, 64 to a word."""
    words = -(-len(fps) // 64)
    padded = np.zeros(words * 64, U)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(U).reshape(BITS, words)


def sliced_pairs(fps: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j < last[i], within RADIUS, tile by tile.

    ``last[i]`` ends the bucket of row i.  An entry is a query and a word of 64
    candidates; the planes of the word that differ from the query's bits are
    counted in ``ones``, ``twos`` and ``over`` (four or more)."""
    n = len(fps)
    planes = bit_planes(fps)
    rows = np.arange(n)
    first_word, last_word = (rows + 1) // 64, (last - 1) // 64
    count = np.where(last > rows + 1, last_word - first_word + 1, 0)
    ends = np.cumsum(count)
    total = int(ends[-1]) if n else 0
    for lo in range(0, total, TILE):
        entry = np.arange(lo, min(total, lo + TILE))
        i = np.searchsorted(ends, entry, side="right")
        w = first_word[i] + entry - (ends[i] - count[i])
        # lanes of the word that lie in (i, last[i])
        low = np.clip(i + 1 - w * 64, 0, 63).astype(U)
        high = np.clip(last[i] - w * 64, 1, 64).astype(U)
        live = (~U(0) << low) & (~U(0) >> (U(64) - high))
        ones = np.zeros(len(i), U)
        twos = np.zeros(len(i), U)
        over = ~live
        query = fps[i]
        for b in range(0, BITS, 2):
            # all ones where the query's bit is set, so that xor marks the candidates that differ
            d1 = planes[b][w] ^ (U(0) - ((query >> U(b)) & U(1)))
            d2 = planes[b + 1][w] ^ (U(0) - ((query >> U(b + 1)) & U(1)))
            both = ones ^ d1
            carry = (ones & d1) | (both & d2)
            ones = both ^ d2
            over |= twos & carry
            twos ^= carry
            if b % 8 == 6:
                stay = np.flatnonzero(~over)
                if len(stay) == 0:
                    break
                if 4 * len(stay) < 3 * len(i):  # abandon the words that are out
                    i, w, query, ones, twos, over = i[stay], w[stay], query[stay], ones[stay], twos[stay], over[stay]
        else:
            hit, lane = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            if len(hit):
                yield i[hit], w[hit] * 64 + lane


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest row of each row's component under the pairs."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def bucket_edges(rows: DataFrame) -> DataFrame:
    """Edges (a, b) of a spanning forest of each bucket (mask, key); a bucket
    has at most LEAF rows."""

    def edges(group: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        last = np.repeat(np.concatenate([start[1:], [len(group)]]), np.diff(np.concatenate([start, [len(group)]])))
        root = forest(len(fps), sliced_pairs(fps, last))
        child = np.flatnonzero(root != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[root[child]]), pa.array(signed[child])], names=["a", "b"])

    def run(batches):
        keep = np.zeros((3, 0), np.int64)
        for batch in batches:
            new = np.stack([batch.column(c).to_numpy() for c in ("mask", "key", "fp")])
            keep = np.concatenate([keep, new], axis=1)
            same = np.flatnonzero((keep[:2, 1:] != keep[:2, :-1]).any(axis=0))
            if len(same) and keep.shape[1] > LEAF:
                done, keep = keep[:, : same[-1] + 1], keep[:, same[-1] + 1 :]
                group = np.cumsum(np.concatenate([[True], (done[:2, 1:] != done[:2, :-1]).any(axis=0)]))
                yield edges(group, np.ascontiguousarray(done[2]).view(U))
        if keep.shape[1]:
            group = np.cumsum(np.concatenate([[True], (keep[:2, 1:] != keep[:2, :-1]).any(axis=0)]))
            yield edges(group, np.ascontiguousarray(keep[2]).view(U))

    return rows.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(run, "a long, b long")


def link(fps: DataFrame, stages: Stages, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) that connect all that
    lie within RADIUS of one another, directly or by others."""
    rows, out = fps.select("fp"), []
    for level in range(len(LEVELS)):
        mine = keyed(rows, level)
        size = mine.groupBy("mask", "key").agg(F.count("*").alias("n"))
        size = stages.write(size.filter("n > 1"), f"size{level}")
        # the last level's buckets are bounded by the bits that are left
        small = size if level == len(LEVELS) - 1 else size.filter(F.col("n") <= leaf)
        near = bucket_edges(mine.join(small.select("mask", "key"), ["mask", "key"], "left_semi"))
        out.append(stages.write(near, f"edges{level}"))
        large = size.filter(F.col("n") > leaf)
        if level == len(LEVELS) - 1 or large.isEmpty():
            break
        rows = stages.write(mine.join(large.select("mask", "key"), ["mask", "key"], "left_semi").select("mask", "fp"), f"hot{level}")
    edges = out[0]
    for more in out[1:]:
        edges = edges.union(more)
    return edges


def near_duplicates(docs: DataFrame, stages: Stages | None = None, leaf: int = LEAF) -> DataFrame:
    """doc_id, fingerprint, component_id per row of ``docs``."""
    stages = stages or Stages(docs.sparkSession, "simhash")
    signed = stages.write(sign(docs), "signed")
    nodes = stages.write(signed.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    comp = components(link(nodes, stages, leaf), stages, "comp")
    labelled = nodes.join(comp.select(F.col("node").alias("fp"), "comp"), "fp", "left")
    labelled = stages.write(labelled.select("fp", "rep", F.coalesce("comp", "fp").alias("comp")), "labelled")
    smallest = labelled.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = labelled.join(smallest, "comp").select("fp", "component_id")
    return signed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
