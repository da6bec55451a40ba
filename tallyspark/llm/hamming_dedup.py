"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of distinct 5-word shingles gets a signature of ``SLOTS``
b-bit MinHash values, in chunks of ``CHUNK`` slots.  Two signatures that
differ in at most ``2 * chunks - 1`` slots have, by pigeonhole, a chunk with
at most one error, so indexing every chunk with each of its slots left out in
turn reaches every pair within the distance ``MAX_DIFF``.  At similarity 0.85
a slot differs with probability 0.15, so a linked pair lies beyond
``MAX_DIFF`` with probability 8e-6 (:func:`miss_probability`).

Rows of equal sets are one class.  Only connectivity is asked for, so pairs
are not all emitted: every member of an index key is paired with the key's
smallest member, and after contracting what is near only keys that still hold
several components give pairs, as many as join these.  What is connected so
far is a cluster, and no pair within the distance leaves one.  These pairs are
confirmed on the full sets; then the members of a cluster that are still in
different components are compared, all with all, on their full sets
(``cluster_links``).  Keys and clusters of more than ``LEAF`` members are
compared block against block, each two blocks in a task.

Rows: null or blank texts have an empty set and stand alone; with fewer than
five words the whole sequence is the one shingle.  A null doc_id stands alone
(component_id null, kept).  Rows that repeat a doc_id are one document.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages, chunks, components, flat_bytes, mix64, prefix_hash, span_hash

WORDS = 5
PERCENT = 85
SLOTS, CHUNK = 48, 4
CHUNKS = SLOTS // CHUNK
MAX_DIFF = 19
LEAF = 2048
LEVELS = 3  # a pair within MAX_DIFF meets in so many chunks at least: MAX_DIFF <= 2 * (CHUNKS - LEVELS + 1) - 1
BLOCK_SHINGLES = 1 << 21  # of a block's full sets, on average

SIG_SCHEMA = "doc_id long, n_shingles long, d1 long, d2 long, sig binary"
U = np.uint64


def _constants(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


_XOR, _MUL = _constants(SLOTS, 11), _constants(SLOTS, 12) | U(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, concatenated, and
    their offsets."""
    low = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    word = ~space
    before = np.empty(len(low) + 1, bool)
    before[0], before[1:] = False, word
    starts = word & ~before[:-1]
    cuts = offs[:-1][offs[:-1] < len(low)]
    starts[cuts] = word[cuts]
    ends = np.zeros(len(low) + 1, bool)
    ends[1:] = word
    ends[:-1] &= ~word
    ends[cuts] = np.concatenate([[False], word])[cuts]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    h = span_hash(prefix_hash(low), s, e)
    first = np.searchsorted(s, offs)
    total = np.zeros(max(0, len(h) - WORDS + 1), U)
    for k in range(WORDS):
        total = total * U(0x9E3779B97F4A7C15) + h[k : k + len(total)]
    total = mix64(total)
    sets, sizes = [], np.zeros(len(offs) - 1, np.int64)
    for i in range(len(offs) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= WORDS:
            got = np.unique(total[a : b - WORDS + 1])
        elif b > a:
            x = U(b - a)
            for v in h[a:b]:
                x = x * U(0xD1342543DE82EF95) + v
            got = mix64(np.array([x], U))
        else:
            continue
        sets.append(got)
        sizes[i] = len(got)
    out = np.zeros(len(offs), np.int64)
    np.cumsum(sizes, out=out[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, U)), out


def signatures(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of SLOTS 16-bit MinHash values per non-empty set."""
    begin = at[:-1][np.diff(at) > 0]
    sig = np.empty((len(begin), SLOTS), np.uint16)
    for k in range(SLOTS):
        low = np.minimum.reduceat((flat ^ _XOR[k]) * _MUL[k], begin) if len(begin) else np.zeros(0, U)
        sig[:, k] = (mix64(low) >> U(48)).astype(np.uint16)
    return sig


def sign(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            data, offs = flat_bytes(b.column("text"))
            for lo, hi in chunks(offs):
                with np.errstate(over="ignore"):
                    flat, at = shingle_sets(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                    size, full = np.diff(at), np.diff(at) > 0
                    begin = at[:-1][full]
                    d = np.zeros((2, hi - lo), U)
                    if len(begin):
                        d[0, full] = np.add.reduceat(mix64(flat ^ U(0x1234567)), begin)
                        d[1, full] = np.add.reduceat(mix64(flat ^ U(0xABCDEF)), begin)
                    sig = np.zeros((hi - lo, SLOTS), np.uint16)
                    sig[full] = signatures(flat, at)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(lo, hi - lo),
                        pa.array(size),
                        pa.array(d[0].view(np.int64)),
                        pa.array(d[1].view(np.int64)),
                        pa.array([r.tobytes() for r in sig], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "sig"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SIG_SCHEMA)


def sig_matrix(col: pa.Array) -> np.ndarray:
    data, _ = flat_bytes(col)
    return data.view(np.uint16).reshape(-1, SLOTS)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """N x (CHUNKS * CHUNK) index keys: each chunk with one slot left out."""
    out = np.empty((len(sig), SLOTS), U)
    with np.errstate(over="ignore"):
        for c in range(CHUNKS):
            part = sig[:, c * CHUNK : (c + 1) * CHUNK].astype(U)
            for j in range(CHUNK):
                x = np.full(len(sig), c * CHUNK + j + 1, U)
                for k in range(CHUNK):
                    if k != j:
                        x = (x << U(16)) | part[:, k]
                out[:, c * CHUNK + j] = mix64(x * U(0x9E3779B97F4A7C15))
    return out


def index(reps: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            keys = chunk_keys(sig_matrix(b.column("sig")))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.reshape(-1).view(np.int64)),
                    pa.array(np.repeat(b.column("rep").to_numpy(zero_copy_only=False), SLOTS)),
                    pa.array(np.tile(np.repeat(np.arange(CHUNKS, dtype=np.int32), CHUNK), len(keys))),
                ],
                names=["key", "rep", "last"],
            )

    return reps.select("rep", "sig").mapInArrow(run, "key long, rep long, last int")


def near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose signatures are
    within MAX_DIFF."""
    side = lambda n: reps.select(F.col("rep").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("sig").alias(f"sig_{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")

    def run(batches):
        for b in batches:
            ok = (sig_matrix(b.column("sig_a")) != sig_matrix(b.column("sig_b"))).sum(axis=1) <= MAX_DIFF
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits per set, as 64-bit words: bit k is the parity of the
    number of its shingles that fall to k.  Two sets differ in at least as
    many shingles as their rows differ in bits."""
    sizes = np.array([len(x) for x in sets])
    bits = 1 << min(max(int(4 * sizes.mean()).bit_length(), 8), 14)
    out = np.empty((len(sets), bits // 64), U)
    for lo in range(0, len(sets), 256):
        part = sets[lo : lo + 256]
        at = (np.concatenate(part).view(U) >> U(65 - bits.bit_length())).astype(np.int64)
        at += np.repeat(np.arange(len(part)) * bits, sizes[lo : lo + 256])
        odd = (np.bincount(at, minlength=len(part) * bits) & 1).astype(np.uint8)
        out[lo : lo + 256] = np.packbits(odd.reshape(len(part), bits), axis=1).view(U)
    return out


def compare(block: list[tuple]) -> tuple[list, list]:
    """Pairs within MAX_DIFF of a block's members (rep, comp, sig, side,
    shingles) in different components, of different sides if it has both.

    A pair joins its two components, so what is given spans what is near.
    With full sets the pairs given are confirmed; most others are refused by
    the parities of their sets before these are met."""
    block = sorted(block, key=lambda r: r[3])
    rep = np.array([r[0] for r in block])
    sig = np.frombuffer(b"".join(r[2] for r in block), np.uint16).reshape(-1, SLOTS)
    sets = [r[4] for r in block] if block[0][4] is not None else None
    if sets:
        sizes, odd = np.array([len(x) for x in sets]), parities(sets)
    _, comp = np.unique([r[1] for r in block], return_inverse=True)
    second = sum(r[3] == 0 for r in block)  # where the other side begins
    a, b = [], []
    for i in range(second if second < len(block) else second - 1):
        begin = second if second < len(block) else i + 1
        other = np.flatnonzero(comp[begin:] != comp[i]) + begin
        if sets:
            both = sizes[other] + sizes[i]
            differ = np.bitwise_count(odd[other] ^ odd[i]).sum(axis=1, dtype=np.int64)
            other = other[(100 + PERCENT) * differ <= (100 - PERCENT) * both]
        other = other[(sig[other] != sig[i]).sum(axis=1) <= MAX_DIFF]
        for j in other:
            if comp[j] == comp[i]:
                continue
            if sets:
                n = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * n < PERCENT * (sizes[i] + sizes[j] - n):
                    continue
            comp[comp == comp[j]] = comp[i]
            a.append(min(rep[i], rep[j]))
            b.append(max(rep[i], rep[j]))
    return a, b


def block_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of the rows (key, rep, comp, sig, blocks, shingles) under a common
    key: its members are dealt to ``blocks`` blocks, and each two blocks meet
    in a task, which holds no others.  Shingles may be null."""

    def run(batches):
        key, block = None, []

        def out():
            a, b = compare(block)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            full = batch.column("shingles")
            offs, flat = full.offsets.to_numpy(), full.values.to_numpy()
            cols = [batch.column(c).to_pylist() for c in ("key", "part", "rep", "comp", "sig", "side")]
            for i, (k, p, *member) in enumerate(zip(*cols, strict=True)):
                if (k, p) != key:
                    if len(block) > 1:
                        yield out()
                    key, block = (k, p), []
                block.append((*member, flat[offs[i] : offs[i + 1]].copy() if full[i].is_valid else None))
        if len(block) > 1:
            yield out()

    blocks = F.col("blocks")
    dealt = rows.withColumn("mine", F.when(blocks > 1, F.pmod(F.xxhash64("rep"), blocks)).otherwise(F.lit(0).cast("long")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    part = F.least("mine", "other") * blocks + F.greatest("mine", "other")
    side = (F.col("mine") > F.col("other")).cast("int")
    return (
        dealt.select("key", part.alias("part"), "rep", "comp", "sig", side.alias("side"), "shingles")
        .repartition("key", "part")
        .sortWithinPartitions("key", "part")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def labelled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``rep``, itself if it has no edge."""
    label = comp.select(F.col("node").alias("rep"), "comp")
    return rows.join(label, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def open_pairs(shared: DataFrame, comp: DataFrame, reps: DataFrame, stages: Stages, name: str, leaf: int = LEAF) -> DataFrame:
    """Candidate pairs that join the components under a common key.  A key
    whose members are in one component is closed: it gives no pair."""
    rows = labelled(shared.select("key", "rep"), comp)
    stat = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    rows = rows.join(stat.filter("c0 < c1").select("key", F.ceil(F.col("n") / leaf).alias("blocks")), "key")
    rows = rows.join(reps.select("rep", "sig"), "rep").withColumn("shingles", F.lit(None).cast("array<long>"))
    return block_pairs(stages.write(rows, f"{name}-open"))


def cluster_links(maybe: DataFrame, linked: DataFrame, reps: DataFrame, sets: DataFrame, stages: Stages, leaf: int = LEAF) -> DataFrame:
    """Links that join the components of ``linked``.  Every candidate pair lies
    in one component of ``maybe``, a cluster, so a document is carried with
    its full set once for all its keys.  A block is bounded by its members
    and by their shingles."""
    cluster = components(maybe, stages, "c2").select(F.col("node").alias("rep"), F.col("comp").alias("key"))
    rows = labelled(cluster, components(linked, stages, "c3")).join(reps.select("rep", "n_shingles", "sig"), "rep")
    rows = stages.write(rows, "clusters")
    stat = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("held"), F.min("comp").alias("c0"), F.max("comp").alias("c1")
    )
    blocks = F.ceil(F.greatest(F.col("n") / leaf, F.col("held") / BLOCK_SHINGLES))
    rows = rows.join(stat.filter("c0 < c1").select("key", blocks.alias("blocks")), "key")
    return block_pairs(rows.join(sets.select(F.col("doc_id").alias("rep"), "shingles"), "rep"))


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that the full sets link."""
    side = lambda n: sets.select(F.col("doc_id").alias(n), F.col("shingles").alias(f"s_{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    inter = F.size(F.array_intersect("s_a", "s_b"))
    return (
        both.withColumn("i", inter)
        .filter(100 * F.col("i") >= PERCENT * (F.size("s_a") + F.size("s_b") - F.col("i")))
        .select("a", "b")
    )


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, shingles of the documents in ``ids`` (doc_id), once each."""

    def run(batches):
        for b in batches:
            data, offs = flat_bytes(b.column("text"))
            for lo, hi in chunks(offs):
                with np.errstate(over="ignore"):
                    flat, at = shingle_sets(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), sets], names=["doc_id", "shingles"])

    mine = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return mine.mapInArrow(run, "doc_id long, shingles array<long>").dropDuplicates(["doc_id"])


def near_duplicates(docs: DataFrame, stages: Stages | None = None, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id per row of ``docs``."""
    stages = stages or Stages(docs.sparkSession, "hamming_dedup")
    signed = stages.write(sign(docs), "signed")
    known = signed.filter("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    reps = stages.write(classes.select("rep", "n_shingles", "sig", "d1", "d2"), "reps")

    keys = stages.write(index(reps), "keys")
    lead = keys.groupBy("key").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).filter("n > 1")
    shared = stages.write(keys.join(lead, "key"), "shared")
    stages.drop("keys")
    star = shared.filter("rep > lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    first = stages.write(near(star, reps), "near")
    many = shared.filter("n > 2")
    second = stages.write(open_pairs(many, components(first, stages, "c1"), reps, stages, "p1", leaf), "second")
    maybe = first.union(second)
    ids = maybe.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stages.write(full_sets(docs, ids), "sets")
    linked = stages.write(confirm(maybe, sets), "linked")

    # ``second`` only spans what is near, and links refused above may have
    # hidden others: members of a cluster in different components are compared
    # on their full sets, which gives only the links that join components.
    linked = linked.union(stages.write(cluster_links(maybe, linked, reps, sets, stages, leaf), "third"))
    twins = known.join(reps.select("d1", "d2", "n_shingles", "rep"), ["d1", "d2", "n_shingles"])
    same = twins.filter("doc_id > rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    comp = components(linked, stages, "c4").select(F.col("node").alias("rep"), "comp")
    rep_of = same.select(F.col("b").alias("doc_id"), F.col("a").alias("rep"))
    out = signed.select("doc_id", "n_shingles").join(rep_of, "doc_id", "left")
    out = out.withColumn("rep", F.coalesce("rep", "doc_id")).join(comp, "rep", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("comp", "rep").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("comp", "rep")).alias("kept"),
        F.col("rep").alias("class_id"),
    )


def keep_representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id stands for its group, all columns (of
    any name: a row travels as one column)."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("keep")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col("doc_id").alias("id"))
    return rows.join(kept, F.col("id").eqNullSafe(F.col("keep")), "left_semi").select("whole.*")


def miss_probability(percent: int = PERCENT) -> float:
    """Chance that a pair at the threshold differs in more than MAX_DIFF slots."""
    p = 1 - percent / 100
    return sum(comb(SLOTS, k) * p**k * (1 - p) ** (SLOTS - k) for k in range(MAX_DIFF + 1, SLOTS + 1))
