"""Removal of repeated 400-byte strings with sharded suffix arrays.

1. Texts are identified by (64-bit hash, length); all of a text that has
   copies goes if it is long enough, and one copy stands for the others.
2. Winnowing: every window of ``LENGTH`` bytes selects the leftmost smallest
   hash of its ``GRAM``-byte pieces, its anchor.  Equal windows have equal
   anchors, so only windows whose anchor occurs elsewhere can repeat, and all
   copies of a window fall to the same anchor.
3. Windows are dealt to shards by anchor, each anchor occurrence with its
   bytes once.  A shard sorts the suffixes of its blocks by Larsson-Sadakane
   refinement in numpy (ranks double their depth; settled groups drop out),
   the last step joining depth 256 at offset 144 to depth 400.  Kasai's reuse
   confirms neighbours: where both move on by one byte, only the new last byte
   is compared.
4. An anchor with more than ``PART`` occurrences is split over several shards;
   their distinct windows are merged by binary search over sorted digests.

Rows: a null text is empty; empty or short texts lose nothing; repeated rows
are copies of each other, so a repeated text of at least ``LENGTH`` bytes is
removed wholly.  A null doc_id is carried through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages, chunks, flat_bytes, prefix_hash, span_hash, text_or_empty

RUNS = "array<struct<start:bigint,end:bigint>>"
LENGTH = 400
GRAM = 32
PART = 2000
BLOCK_BYTES = 1 << 20
U = np.uint64
LOW32 = U(0xFFFFFFFF)


# ------------------------------------------------------------------ anchors


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text row, first start, last start, anchor hash) of the runs of windows
    that share an anchor occurrence."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, U),)
    prefix = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    h = span_hash(prefix, at, at + GRAM)
    m = (h & ~LOW32) | at.astype(U)
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if width > span:
        m = np.minimum(m[: -(width - span)], m[width - span :])
    pos = (m & LOW32).astype(np.int64)
    sizes = np.diff(offs) - LENGTH + 1
    rows = np.flatnonzero(sizes > 0)
    n = sizes[rows]
    row = np.repeat(rows, n)
    begin = np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(offs[rows], n) + np.arange(n.sum()) - begin
    pick = pos[start]
    new = np.ones(len(pick), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pick)) - 1
    base = offs[row[first]]
    return row[first], start[first] - base, start[last] - base, h[pick[first]]


def find_anchors(base: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            data, offs = flat_bytes(b.column("text"))
            for lo, hi in chunks(offs):
                with np.errstate(over="ignore"):
                    row, s0, s1, a = anchors(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                own = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), b.column("tid").take(own), b.column("n").take(own), pa.array(s0), pa.array(s1)],
                    names=["a", "tid", "n", "s0", "s1"],
                )

    return base.select("tid", "n", "text").mapInArrow(run, "a long, tid long, n long, s0 long, s1 long")


# ------------------------------------------------------------ suffix arrays


def refine(rank: np.ndarray, active: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """One Larsson-Sadakane step: groups of equal rank are split by the rank
    ``offset`` further on; settled positions drop out of ``active``."""
    n = len(rank)
    nxt = active + offset
    second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
    order = np.lexsort((second, rank[active]))
    act, r, s = active[order], rank[active][order], second[order]
    head = np.ones(len(act), bool)
    head[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    group = np.ones(len(act), bool)
    group[1:] = r[1:] != r[:-1]
    begin = np.flatnonzero(group)[np.cumsum(group) - 1]
    own = np.maximum.accumulate(np.where(head, np.arange(len(act)), 0))
    out = rank.copy()
    out[act] = r + own - begin
    tail = np.append(head[1:], True)
    return out, act[~(head & tail)]


def suffix_ranks(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Rank of each suffix by its first ``length`` bytes; equal prefixes have
    equal ranks."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U)
    key = np.zeros(len(data), U)
    for k in range(8):
        key = (key << U(8)) | padded[k : k + len(data)]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.ones(len(data), bool)
    head[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(data), np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(data)), 0))
    tail = np.append(head[1:], True)
    active, depth = order[~(head & tail)], 8
    while len(active) and depth * 2 <= length:
        rank, active = refine(rank, active, depth)
        depth *= 2
    if len(active) and depth < length:
        rank, active = refine(rank, active, length - depth)
    return rank


def confirm(data: np.ndarray, left: np.ndarray, right: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether data[left:] and data[right:] share ``length`` bytes.  ``left``
    ascends; a pair that follows its neighbour by one byte on both sides needs
    its last byte only (Kasai)."""
    follows = np.zeros(len(left), bool)
    follows[1:] = (np.diff(left) == 1) & (np.diff(right) == 1)
    same = np.ones(len(left), bool)
    heads = np.flatnonzero(~follows)
    step = np.arange(length)
    for k in range(0, len(heads), 4096):
        h = heads[k : k + 4096]
        same[h] = (data[left[h, None] + step] == data[right[h, None] + step]).all(axis=1)
    same[follows] = data[left[follows] + length - 1] == data[right[follows] + length - 1]
    run = np.cumsum(~follows)
    bad = np.zeros(run[-1] + 1 if len(run) else 1, bool)
    bad[run[~same]] = True
    return ~bad[run] if len(run) else same


def shard_repeats(contexts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For contexts (bytes, number of places with them): per window its
    context, its start in it, whether it repeats, and a digest of its bytes
    (one window per class has ``first``)."""
    data = np.frombuffer(b"".join(c for c, _ in contexts), np.uint8)
    size = np.array([len(c) for c, _ in contexts])
    base = np.cumsum(size) - size
    n = size - LENGTH + 1
    ctx = np.repeat(np.arange(len(contexts)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = base[ctx] + start
    rank = suffix_ranks(data)[at]
    order = np.argsort(rank, kind="stable")
    equal = np.zeros(len(order), bool)
    equal[1:] = rank[order][1:] == rank[order][:-1]
    twin = np.flatnonzero(equal)
    here = np.argsort(at[order[twin]], kind="stable")
    ok = confirm(data, at[order[twin]][here], at[order[twin - 1]][here])
    equal[twin[here]] = ok
    repeats = np.zeros(len(order), bool)
    repeats[order[equal]] = True
    repeats[order[np.flatnonzero(equal) - 1]] = True
    repeats |= np.array([k > 1 for _, k in contexts])[ctx]
    first = np.zeros(len(order), bool)
    first[order[~equal]] = True
    with np.errstate(over="ignore"):
        digest = span_hash(prefix_hash(data), at, at + LENGTH)
    return ctx, start, repeats, np.where(first, digest, U(0))


SHARD_SCHEMA = "tid long, n long, lo long, hi long, digest long"
SHARD_NAMES = ["tid", "n", "lo", "hi", "digest"]


def search_block(groups: list[tuple[bool, dict]]):
    """One block of whole (anchor, part) groups -> repeated ranges (digest
    null) and, for split anchors, single windows with their digest."""
    contexts, places, split = [], [], []
    for is_split, members in groups:
        for ctx, where in members.items():
            contexts.append((ctx, len(where)))
            places.append(sorted(where))
            split.append(is_split)
    ctx, start, repeats, digest = shard_repeats(contexts)
    out = []
    edge = np.ones(len(ctx), bool)
    edge[1:] = (ctx[1:] != ctx[:-1]) | (repeats[1:] != repeats[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(ctx)) - 1
    for f, e in zip(first[repeats[first]], last[repeats[first]], strict=True):
        out += [(t, n, s0 + int(start[f]), s0 + int(start[e]), None) for t, n, s0 in places[ctx[f]]]
    for i in np.flatnonzero(np.array(split)[ctx] & (digest != 0)):
        t, n, s0 = places[ctx[i]][0]
        out.append((t, n, s0 + int(start[i]), -1 if repeats[i] else s0 + int(start[i]), int(digest[i].view(np.int64))))
    cols = list(zip(*out, strict=True)) if out else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=SHARD_NAMES)


def search_shards(contexts: DataFrame) -> DataFrame:
    def run(batches):
        key, members, parts, groups, size = None, {}, 1, [], 0
        for b in batches:
            for a, p, parts_now, t, n, s0, c in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                if (a, p) != key:
                    if members:
                        groups.append((parts > 1, members))
                    if size > BLOCK_BYTES:
                        yield search_block(groups)
                        groups, size = [], 0
                    key, members, parts = (a, p), {}, parts_now
                got = members.get(c)
                if got is None:
                    members[c] = got = set()
                    size += len(c)
                got.add((t, n, s0))
        if members:
            groups.append((parts > 1, members))
        if groups:
            yield search_block(groups)

    cols = ["a", "part", "parts", "tid", "n", "s0", "ctx"]
    return contexts.select(cols).repartition("a", "part").sortWithinPartitions("a", "part").mapInArrow(run, SHARD_SCHEMA)


def merge_shards(singles: DataFrame) -> DataFrame:
    """Windows of split anchors that also occur in another shard: each task
    has a range of digests, and each shard's windows are looked up in the
    sorted digests by binary search."""

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        d = rows.column("digest").to_numpy()
        s = np.sort(d)
        many = np.searchsorted(s, d, "right") - np.searchsorted(s, d, "left") > 1
        mine = rows.filter(pa.array(many & (rows.column("hi").to_numpy() >= 0)))
        yield from mine.to_batches()

    return singles.repartition("digest").mapInArrow(run, SHARD_SCHEMA)


# -------------------------------------------------------------------- whole


def cut_contexts(texts: DataFrame) -> DataFrame:
    """One row per anchor occurrence with the bytes of its windows."""

    def run(batches):
        for b in batches:
            for t, n, raw, runs in zip(*(b.column(c).to_pylist() for c in ("tid", "n", "text", "runs")), strict=True):
                raw = raw if isinstance(raw, bytes) else raw.encode()
                rows = [(r["a"], r["parts"], t, n, r["s0"], raw[r["s0"] : r["s1"] + LENGTH]) for r in runs]
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["a", "parts", "tid", "n", "s0", "ctx"]
                )

    return texts.mapInArrow(run, "a long, parts long, tid long, n long, s0 long, ctx binary")


def cover(n: int, ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows with starts in ``ranges``."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"] + LENGTH) for r in ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, min(b, n)) for a, b in out]


def covered(ranges: DataFrame) -> DataFrame:
    """tid, n and the removed byte runs of the texts with window ranges."""
    runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            got = [cover(n, r) for n, r in zip(b.column("n").to_pylist(), b.column("ranges").to_pylist(), strict=True)]
            spans = pa.array([[{"start": a, "end": e} for a, e in g] for g in got], runs)
            yield pa.RecordBatch.from_arrays([b.column("tid"), b.column("n"), spans], names=["tid", "n", "removed"])

    return ranges.mapInArrow(run, f"tid long, n long, removed {RUNS}")


def without(raw, n, removed):
    """The bytes outside the removed runs, joined (a cast between bytes and
    string moves bytes as they are)."""
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform(removed, lambda r: r["end"]))
    end = F.concat(F.transform(removed, lambda r: r["start"]), F.array(n))
    gaps = F.zip_with(begin, end, lambda a, e: F.substring(raw, (a + 1).cast("int"), (e - a).cast("int")).cast("string"))
    return F.when(F.size(removed) == 0, raw).otherwise(F.array_join(gaps, "").cast("binary"))


def remove_repeats(docs: DataFrame, stages: Stages | None = None, part: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what remains,
    U+FFFD for a character cut by a run's edge) and removed (the runs) per row
    of ``docs``."""
    stages = stages or Stages(docs.sparkSession, "suffix_dedup")
    text = text_or_empty()
    base = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tid"), F.octet_length(text).cast("long").alias("n"))
    light = stages.write(base.select("doc_id", "tid", "n"), "light")
    copies = light.groupBy("tid", "n").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"))

    found = find_anchors(base.filter(F.col("n") >= LENGTH))
    found = stages.write(found.groupBy("tid", "n", "s0").agg(F.first("a").alias("a"), F.first("s1").alias("s1")), "anchors")
    hot = found.groupBy("a").agg(F.count("*").alias("m")).filter("m > 1")
    hot = hot.select("a", F.ceil(F.col("m") / part).alias("parts"))
    runs = found.join(hot, "a").groupBy("tid", "n").agg(F.collect_list(F.struct("a", "parts", "s0", "s1")).alias("runs"))
    need = runs.join(copies.select("tid", "n", "rep"), ["tid", "n"])
    rows = base.select("doc_id", F.col("tid").alias("row_tid"), F.col("n").alias("row_n"), "text")
    own = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("row_tid") == F.col("tid")) & (F.col("row_n") == F.col("n"))
    # (rows that repeat a doc_id and text come twice: a window is known by text and place)
    texts = stages.write(rows.join(need, own).select("tid", "n", "text", "runs"), "texts")
    stages.drop("anchors")
    contexts = cut_contexts(texts).withColumn("part", F.pmod(F.xxhash64("tid", "s0"), "parts"))
    got = stages.write(search_shards(contexts), "shards")
    stages.drop("texts")
    ranges = got.filter("digest is null").union(merge_shards(got.filter("digest is not null")))
    spans = covered(ranges.groupBy("tid", "n").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))
    # a text that has copies goes wholly, what else repeats by its runs
    whole = copies.filter((F.col("copies") > 1) & (F.col("n") >= LENGTH)).select("tid", "n", F.lit(True).alias("whole"))
    facts = whole.join(spans, ["tid", "n"], "full")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end")))
    facts = stages.write(facts.select("tid", "n", F.when(F.col("whole"), all_of_it).otherwise(F.col("removed")).alias("removed")), "facts")
    # what repeats grows with the corpus, so the facts are never broadcast
    rows = base.join(facts.hint("merge"), ["tid", "n"], "left").withColumn("removed", F.coalesce("removed", F.array().cast(RUNS)))
    rows = rows.withColumn("kept", without(F.col("text").cast("binary"), F.col("n"), F.col("removed")))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        "removed",
    )
