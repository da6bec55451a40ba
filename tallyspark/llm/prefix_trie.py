"""Prefix trie of conversations by the Euler-tour technique.

Each distinct sequence of first d turns (role, text) is a node.  A node has an
enter and an exit arc; the arcs form one linked list, the Euler tour (children
by conv_id).  The list is ranked with weights: every arc 1, an enter arc also
its leaf mark and its saved tokens.  Sums over a subtree are then differences of
the sums at the exit and enter arcs.

Prefixes are named by a sum of SHA-256 digests of (place, role, text), 120 bits
of it, so a conversation is never folded turn by turn in one task: places and
sums are taken in ranges and blocks and stitched by offsets.

Ranking is distributed: by pointer jumping each arc learns the next arc of a
hashed sample (one in ``EVERY``) and the weights up to it, the sample is ranked
in the same way, and the sums are handed back.  Only a list of at most ``LOCAL``
arcs is walked in one task.  No arc is pointed at by more than one open arc, so
the joins have no hot key.  Siblings are chained inside blocks of ``BLOCK``
conv_ids, then block to block.

A node's end digest is SHA-256 over its conv_ids in order, which is sequential
by definition: the ids of one node are streamed through one task, sorted by
Spark, without being held.

Rows: turns are ordered by turn (null first), equal turns by a digest of role
and text; a null role or text is empty; repeated rows are turns of their own; a
null conv_id takes no part; an empty table has no node.  Long texts are digested
by Spark where they are read and go no further.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages, text_or_empty

HEAD = 6  # a conversation takes crc32 % HEAD first turns of its base
GROUP = 100  # conversations of one base
CHUNK = 1024  # turns of a conversation summed by one window
BLOCK = 12  # log2 of the conv_ids that chain siblings in one window
EVERY = 64  # one arc of so many is sampled
LOCAL = 4096  # arcs walked in one task
MASK = (1 << 40) - 1
PIECES = (1, 2, 3)  # 40-bit parts of a prefix digest
KEY = ["d", "k1", "k2", "k3"]


# ------------------------------------------------------- rebuilt conversations


def numbered_turns(conversations: DataFrame, stages: Stages) -> DataFrame:
    """conv_id, p (place from 1), dig, chars of every turn.

    The rows are ranged by (conv_id, turn), so that a conversation with most of
    the rows lies in several ranges; places are counted in each and moved by
    the counts of the ranges before."""
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("dig"),
        F.length(text).cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("dig")]
    ranged = rows.repartitionByRange(F.col("conv_id"), *order).withColumn("part", F.spark_partition_id())
    ranged = stages.write(ranged, "ranged")
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)).cast("long")
    parts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # only a range's first conversation begins before it: one row a range at most
    moved = F.broadcast(parts.withColumn("before", before).filter("before > 0").select("conv_id", "part", "before"))
    placed = ranged.withColumn("i", place).join(moved, ["conv_id", "part"], "left")
    out = placed.select("conv_id", (F.col("i") + F.coalesce("before", F.lit(0))).alias("p"), "dig", "chars")
    return stages.write(out, "turns")


def rebuild(turns: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """The conversations (c, n: rebuilt turns) and their rebuilt turns
    (c, d, dig, chars, n): the first turns of the base, then the own ones."""
    lengths = turns.groupBy(F.col("conv_id").alias("c")).agg(F.max("p").alias("own"))
    base = lengths.filter(F.col("c") % GROUP == 0).select(F.col("c").alias("base"), F.col("own").alias("base_n"))
    plan = lengths.select(
        "c", "own", (F.col("c") - F.col("c") % GROUP).alias("base"), (F.crc32(F.col("c").cast("string")) % HEAD).alias("h")
    ).join(base, "base", "left")
    plan = plan.withColumn("b", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = plan.withColumn("n", F.col("b") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long")))
    plan = stages.write(plan.select("c", "base", "h", "b", "n"), "plan")
    first = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("p") < HEAD)).withColumnRenamed("conv_id", "base")
    head = plan.join(first, "base").filter(F.col("p") <= F.col("h")).select("c", F.col("p").alias("d"), "dig", "chars", "n")
    own = turns.withColumnRenamed("conv_id", "c").join(plan, "c").filter(F.col("p") > F.col("h"))
    own = own.select("c", (F.col("b") + F.col("p") - F.col("h")).alias("d"), "dig", "chars", "n")
    return plan.select("c", "n"), head.union(own)


def prefixes(seq: DataFrame, stages: Stages) -> DataFrame:
    """c, d, the key of the prefix (k1..k3) and of the one before (q1..q3),
    chars, n."""
    full = F.sha2(F.concat_ws(":", F.col("d").cast("string"), "dig"), 256)
    part = lambda i: F.conv(F.substring("full", 10 * i - 9, 10), 16, 10).cast("long").alias(f"g{i}")
    rows = seq.withColumn("full", full).select(
        "c", "d", "chars", "n", F.floor((F.col("d") - 1) / CHUNK).alias("chunk"), *[part(i) for i in PIECES]
    )
    run = Window.partitionBy("c", "chunk").orderBy("d")
    rows = stages.write(rows.select("*", *[F.sum(f"g{i}").over(run).alias(f"s{i}") for i in PIECES]), "sums")
    # what the chunks before add, for conversations of more than one
    total = rows.filter(F.col("n") > CHUNK).groupBy("c", "chunk").agg(
        *[F.sum(f"g{i}").bitwiseAND(F.lit(MASK)).alias(f"t{i}") for i in PIECES]
    )
    before = Window.partitionBy("c").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("c", "chunk", *[F.sum(f"t{i}").over(before).alias(f"o{i}") for i in PIECES])
    rows = rows.join(total.filter("chunk > 0"), ["c", "chunk"], "left")
    key = {i: (F.col(f"s{i}") + F.coalesce(f"o{i}", F.lit(0))).bitwiseAND(F.lit(MASK)) for i in PIECES}
    out = rows.select(
        "c",
        "d",
        *[key[i].alias(f"k{i}") for i in PIECES],
        *[(key[i] - F.col(f"g{i}")).bitwiseAND(F.lit(MASK)).alias(f"q{i}") for i in PIECES],
        "chars",
        "n",
    )
    return stages.write(out, "prefixes")


# ------------------------------------------------------------------- nodes


def trie_nodes(convs: DataFrame, seq: DataFrame, stages: Stages) -> DataFrame:
    """conv, d, pconv (the parent's conv), n_convs, chars and the key of each
    node; (conv, d) names a node, conv being its smallest member."""
    zero = [F.lit(0).cast("long").alias(f"k{i}") for i in PIECES]
    none = [F.lit(None).cast("long").alias(f"q{i}") for i in PIECES]
    root = convs.agg(F.min("c").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("d"), *zero, *none, "conv", "n_convs", F.lit(0).cast("long").alias("chars"))
    inner = seq.groupBy(*KEY).agg(
        *[F.max(f"q{i}").alias(f"q{i}") for i in PIECES],
        F.min("c").alias("conv"),
        F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"),
    )
    nodes = stages.write(root.unionByName(inner), "nodes")
    cols = [*KEY, "conv", "n_convs", "chars"]
    top = nodes.filter("d = 0").select(F.lit(1).cast("long").alias("d"), F.col("conv").alias("pconv"))
    # the first turns all hang on the root, which is one row
    first = nodes.filter("d = 1").join(F.broadcast(top), "d").select(*cols, "pconv")
    above = nodes.filter("d > 0").select(
        (F.col("d") + 1).alias("d"), *[F.col(f"k{i}").alias(f"q{i}") for i in PIECES], F.col("conv").alias("pconv")
    )
    deeper = nodes.filter("d > 1").join(above, ["d", "q1", "q2", "q3"]).select(*cols, "pconv")
    whole = nodes.filter("d = 0").select(*cols, F.lit(None).cast("long").alias("pconv")).union(first).union(deeper)
    return stages.write(whole, "family")


def siblings(nodes: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """(conv, d, next: the next sibling's conv or null) of the nodes below the
    root, and (conv, d, first_child, n_children) of the parents."""
    kids = nodes.filter("d > 0").select("conv", "d", "pconv", F.shiftright("conv", BLOCK).alias("block"))
    inside = F.lead("conv").over(Window.partitionBy("pconv", "d", "block").orderBy("conv"))
    kids = stages.write(kids.withColumn("near", inside), "kids")
    blocks = kids.groupBy("pconv", "d", "block").agg(F.min("conv").alias("first"), F.count("*").alias("n"))
    blocks = stages.write(blocks, "blocks")
    far = F.lead("first").over(Window.partitionBy("pconv", "d").orderBy("block"))
    after = blocks.select("pconv", "d", "block", far.alias("far")).filter("far is not null")
    # of a block only the last child looks further
    end = kids.filter("near is null").join(after, ["pconv", "d", "block"], "left")
    chained = end.select("conv", "d", F.col("far").alias("next"))
    chained = chained.union(kids.filter("near is not null").select("conv", "d", F.col("near").alias("next")))
    parents = blocks.groupBy(F.col("pconv").alias("conv"), (F.col("d") - 1).alias("d")).agg(
        F.min("first").alias("first_child"), F.sum("n").alias("n_children")
    )
    return chained, parents


def tour(nodes: DataFrame, chained: DataFrame, parents: DataFrame, stages: Stages) -> DataFrame:
    """Arcs (c, x) with their successor (tc, tx) and weights; x = 2d enters
    node (c, d), x = 2d + 1 leaves it."""
    rows = nodes.join(chained, ["conv", "d"], "left").join(parents, ["conv", "d"], "left")
    rows = rows.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf = F.col("n_children") == 0
    zero = F.lit(0).cast("long")
    enter = F.struct(
        (2 * F.col("d")).alias("x"),
        F.when(leaf, F.col("conv")).otherwise(F.col("first_child")).alias("tc"),
        F.when(leaf, 2 * F.col("d") + 1).otherwise(2 * F.col("d") + 2).alias("tx"),
        leaf.cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    leave = F.struct(
        (2 * F.col("d") + 1).alias("x"),
        F.coalesce("next", "pconv").alias("tc"),
        F.when(F.col("next").isNotNull(), 2 * F.col("d")).when(F.col("pconv").isNotNull(), 2 * F.col("d") - 1).alias("tx"),
        zero.alias("leaves"),
        zero.alias("saved"),
    )
    arcs = rows.select(F.col("conv").alias("c"), F.explode(F.array(enter, leave)).alias("a"))
    return stages.write(arcs.select("c", "a.x", "a.tc", "a.tx", F.lit(1).cast("long").alias("arcs"), "a.leaves", "a.saved"), "arcs")


# ------------------------------------------------------------ list ranking

WEIGHTS = ["arcs", "leaves", "saved"]


def sampled(c: str, x: str, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), c, x), F.lit(EVERY)) == 0


def walk(arcs: DataFrame) -> DataFrame:
    """Sums from each arc to the end of the list, of at most LOCAL arcs."""

    def run(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        by = {(r["c"], r["x"]): r for r in rows}
        start = set(by) - {(r["tc"], r["tx"]) for r in rows}
        for at in start:
            path = []
            while at in by:
                path.append(at)
                at = (by[at]["tc"], by[at]["tx"])
            sums = dict.fromkeys(WEIGHTS, 0)
            for key in reversed(path):
                for w in WEIGHTS:
                    sums[w] += by[key][w]
                    by[key][w] = sums[w]
        names = ["c", "x", *WEIGHTS]
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.int64()) for n in names], names=names)

    return arcs.coalesce(1).mapInArrow(run, "c long, x long, arcs long, leaves long, saved long")


def rank(arcs: DataFrame, stages: Stages, level: int = 0, local: int = LOCAL) -> DataFrame:
    """Sums of the weights from each arc (c, x) to the end of the list."""
    if arcs.count() <= local:
        return walk(arcs)
    cols = ["c", "x", "tc", "tx", *WEIGHTS]
    # done: the successor is sampled or the list ends there
    done = F.col("tc").isNull() | sampled("tc", "tx", level)
    now, k = arcs, 0
    while True:
        closed, open_ = now.filter(done), now.filter(~done)
        if open_.isEmpty():
            break
        for _ in range(2):
            step = now.select(
                F.col("c").alias("tc"), F.col("x").alias("tx"), F.col("tc").alias("to_c"), F.col("tx").alias("to_x"), *[F.col(w).alias(f"{w}_2") for w in WEIGHTS]
            )
            jumped = open_.join(step, ["tc", "tx"]).select(
                "c", "x", F.col("to_c").alias("tc"), F.col("to_x").alias("tx"), *[(F.col(w) + F.col(f"{w}_2")).alias(w) for w in WEIGHTS]
            )
            now = closed.select(*cols).union(jumped.select(*cols))
            k += 1
            now = stages.write(now, f"jump{level}-{k}")
            if k > 1:
                stages.drop(f"jump{level}-{k - 1}")
            closed, open_ = now.filter(done), now.filter(~done)
    ranked = stages.write(rank(now.filter(sampled("c", "x", level)), stages, level + 1, local), f"rank{level}")
    rest = ranked.select(F.col("c").alias("tc"), F.col("x").alias("tx"), *[F.col(w).alias(f"{w}_2") for w in WEIGHTS])
    whole = now.join(rest, ["tc", "tx"], "left")
    return whole.select("c", "x", *[(F.col(w) + F.coalesce(f"{w}_2", F.lit(0))).alias(w) for w in WEIGHTS])


# ------------------------------------------------------------------ result


def end_digests(convs: DataFrame, seq: DataFrame) -> DataFrame:
    """SHA-256 of the conv_ids that end at each key, in order."""
    last = seq.filter("d = n").select(*KEY, "c")
    bare = convs.filter("n = 0").select(*[F.lit(0).cast("long").alias(k) for k in KEY], "c")

    def run(batches):
        key, digest = None, None
        names = [*KEY, "ends_sha256"]

        def out():
            cols = [pa.array([v], pa.int64()) for v in key] + [pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            ids = b.column("c").to_pylist()
            for i, k in enumerate(zip(*[b.column(n).to_pylist() for n in KEY], strict=True)):
                if k != key:
                    if key is not None:
                        yield out()
                    key, digest = k, hashlib.sha256(str(ids[i]).encode())
                else:
                    digest.update(f",{ids[i]}".encode())
        if key is not None:
            yield out()

    return (
        last.union(bare).repartition(*KEY).sortWithinPartitions(*KEY, "c").mapInArrow(run, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string")
    )


def build_trie(conversations: DataFrame, stages: Stages | None = None, local: int = LOCAL) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and the tour's enter_pos, exit_pos."""
    stages = stages or Stages(conversations.sparkSession, "prefix_trie")
    convs, seq = rebuild(numbered_turns(conversations, stages), stages)
    seq = prefixes(seq, stages)
    nodes = trie_nodes(convs, seq, stages)
    chained, parents = siblings(nodes, stages)
    arcs = tour(nodes, chained, parents, stages)
    sums = rank(arcs, stages, local=local)
    sums = sums.select(F.shiftright("x", 1).alias("d"), F.col("c").alias("conv"), (1 - 2 * (F.col("x") % 2)).alias("sign"), *WEIGHTS)
    sign = F.col("sign")
    over = sums.groupBy("conv", "d").agg(
        F.sum(F.col("leaves") * sign).alias("n_leaves"),
        F.sum(F.col("saved") * sign).alias("saved_tokens"),
        F.max("arcs").alias("to_enter"),
        F.min("arcs").alias("to_exit"),
    )
    ends = end_digests(convs, seq)
    out = nodes.join(over, ["conv", "d"]).join(parents, ["conv", "d"], "left").join(ends, KEY, "left")
    total = F.lit(2 * nodes.count())
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("pconv").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        (total - F.col("to_enter")).alias("enter_pos"),
        (total - F.col("to_exit")).alias("exit_pos"),
    )


def trie_report(nodes: DataFrame) -> DataFrame:
    return nodes.drop("enter_pos", "exit_pos")


_CRC = (
    "xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length({s}) + 1), "
    "lambda i: [ascii({s}[i]), -1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"
)
_DIG = "sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"

ORACLE = f"""WITH t AS (
  SELECT conv_id, dig, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dig) AS p
  FROM (SELECT conv_id, turn, {_DIG} AS dig, length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL) s),
own AS (SELECT conv_id, count(*) AS own, CAST(conv_id AS VARCHAR) AS s FROM t GROUP BY conv_id),
plan AS (SELECT o.conv_id, o.own, {_CRC.format(s='o.s')} % 6 AS h, coalesce(b.own, 0) AS base_n
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
seq AS (
  SELECT p.conv_id, t.p AS d, dig, chars FROM plan p JOIN t ON t.conv_id = p.conv_id - p.conv_id % 100 AND t.p <= p.h
  UNION ALL
  SELECT p.conv_id, least(p.h, base_n) + t.p - p.h, dig, chars FROM plan p JOIN t ON t.conv_id = p.conv_id AND t.p > p.h),
pre AS (
  SELECT conv_id, d, chars, string_agg(dig, '') OVER (PARTITION BY conv_id ORDER BY d) AS k FROM seq
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
node AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM pre GROUP BY k, d),
kid AS (SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
below AS (SELECT DISTINCT a.k AS top, b.k FROM pre a JOIN pre b ON b.conv_id = a.conv_id AND b.d >= a.d),
sums AS (SELECT b.top, count(*) FILTER (WHERE kid.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM below b JOIN node n ON n.k = b.k LEFT JOIN kid ON kid.k = b.k GROUP BY b.top),
ends AS (SELECT k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (
  SELECT conv_id, arg_max(k, d) AS k FROM pre GROUP BY conv_id) e GROUP BY k)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kid.n, 0) AS n_children,
  s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n JOIN sums s ON s.top = n.k
LEFT JOIN node up ON n.d > 0 AND up.d = n.d - 1 AND up.k = left(n.k, CAST(64 * (n.d - 1) AS BIGINT))
LEFT JOIN kid ON kid.k = n.k LEFT JOIN ends e ON e.k = n.k"""
