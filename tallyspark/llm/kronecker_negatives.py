"""Hard-negative mining by Kronecker-packed integer products.

Vector components become integers ``floor(SCALE * x)``.  The scores of an
anchor against a block of rows are computed for the whole block at once: the
rows' i-th components, biased to be non-negative, stand in separated fields of
one wide integer, which is multiplied once by the anchor's (biased) i-th
component.  The sum over i holds every row's biased inner product in its own
field; taking the biases off gives the exact scores.  Fields are as wide as the
block's values need, so no component is too large.

Anchors (vec_id divisible by ``EVERY``) are held against all rows in a grid of
anchor blocks and row blocks, both of bounded size, so no task holds more than
one of each.  A first pass over the rows of the anchor's label finds its
positives, a second over the others its negatives; each cell gives at most
``TOP`` rows an anchor (and positive), and the best of the cells are chosen by
a window over those.

Rows: a null vec_id, null label, null vector or any null, NaN or infinite
component takes no part.  Rows that repeat a vec_id count once (the smallest
label, then the smallest vector).  Ties of score go to the smaller vec_id.
Vectors of different lengths are compared over their common components, so an
empty vector scores 0 with everything.  A score outside 64 bits is put at the
nearer bound.  An anchor without positives, or a positive without negatives in
its window, gives no row; an empty table gives an empty result.  Other columns
are not read, and text length plays no part.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages

SCALE = 256
EVERY = 100
TOP = 5
MARGIN = 80  # percent of the positive's score that a negative reaches at least
ROWS, ANCHORS = 4096, 1024  # mean rows of a block
LONG = (-(1 << 63), (1 << 63) - 1)


# ---------------------------------------------------------- packed products


def scaled(vectors: pa.Array) -> np.ndarray:
    """rows x components of floor(SCALE * x), missing components 0; int64, or
    exact Python integers where a value needs them."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    offs = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)[offs[0] : offs[-1]]
    size = np.diff(offs)
    width = int(size.max()) if len(size) else 0
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], size)
    if len(flat) and np.abs(flat).max() >= 2.0**31:
        # beyond 2**53 a double is an integer, and the product is exact in Python
        out = np.zeros((len(size), width), object)
        out[row, col] = [int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(SCALE * x)) for x in flat.tolist()]
        return out
    out = np.zeros((len(size), width), np.int64)
    out[row, col] = np.floor(SCALE * flat).astype(np.int64)
    return out


class Packed:
    """A block of integer vectors, component by component in wide integers."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        self.n, self.dim = len(rows), min(rows.shape[1], anchors.shape[1])
        rows, used = rows[:, : self.dim], anchors[:, : self.dim]
        self.low = min(0, int(rows.min())) if rows.size else 0
        self.anchor_low = min(0, int(used.min())) if used.size else 0
        top = (int(rows.max()) - self.low if rows.size else 0) * (int(used.max()) - self.anchor_low if used.size else 0)
        bound = max(1, self.dim) * max(1, top)
        bits = bound.bit_length()
        # the biases are taken off in 64 bits where all terms fit, else in Python integers
        terms = max(1, self.dim) * max(abs(self.low), abs(int(rows.max()) if rows.size else 0), 1) * max(
            abs(self.anchor_low), abs(int(used.max()) if used.size else 0), 1
        )
        self.small = bits <= 62 and terms < 1 << 60
        self.field = 4 if bits <= 32 else 8 if bits <= 64 else -(-bits // 8)
        self.words = [self._pack([int(x) - self.low for x in rows[:, i]] if rows.dtype == object else rows[:, i] - self.low) for i in range(self.dim)]
        self.sums = rows.sum(axis=1) if rows.size else np.zeros(self.n, np.int64)

    def _pack(self, column) -> int:
        if self.field in (4, 8):
            return int.from_bytes(np.asarray(column, np.uint32 if self.field == 4 else np.uint64).tobytes(), "little")
        return int.from_bytes(b"".join(int(x).to_bytes(self.field, "little") for x in column), "little")

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows with one anchor vector."""
        a = [int(x) - self.anchor_low for x in anchor[: self.dim].tolist()]
        raw = sum(map(mul, a, self.words)).to_bytes(self.field * self.n, "little")
        a_sum = sum(a) + self.dim * self.anchor_low
        # sum((x - lx)(y - ly)) = sum(xy) - lx sum(y) - ly sum(x) + dim lx ly, over x of the anchor and y of the row
        fixed = self.dim * self.anchor_low * self.low - self.low * a_sum
        if self.small:
            got = np.frombuffer(raw, np.uint32 if self.field == 4 else np.uint64).astype(np.int64)
            return got + self.anchor_low * self.sums - fixed
        fields = (int.from_bytes(raw[i : i + self.field], "little") for i in range(0, len(raw), self.field))
        exact = (f + self.anchor_low * int(s) - fixed for f, s in zip(fields, self.sums, strict=True))
        return np.array([min(max(x, LONG[0]), LONG[1]) for x in exact], np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], ~scores[at]))][:k]


# -------------------------------------------------------------- the grid


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (changed for every seventh), embedding of the rows that
    take part, once per vec_id."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    rows = rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), "embedding")).alias("row")
    )
    label = F.col("row.label")
    return rows.select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("row.embedding").alias("embedding")
    )


def cells(rows: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
    """The rows in their block, once for each block of the other side."""
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(own_blocks)).cast("int")
    return rows.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))))


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _positives_of_cell(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    out = {"anchor_id": [], "positive_id": [], "score": []}
    a_vec, r_vec = scaled(anchors["embedding"]), scaled(rows["embedding"])
    a_id, a_label = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    r_id, r_label = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for label in np.unique(a_label):
        mine = np.flatnonzero(r_label == label)
        asked = np.flatnonzero(a_label == label)
        if not len(mine):
            continue
        block, ids = Packed(r_vec[mine], a_vec[asked]), r_id[mine]
        for i in asked:
            other = ids != a_id[i]
            scores, named = block.scores(a_vec[i])[other], ids[other]
            top = best(scores, named, TOP)
            out["anchor_id"] += [int(a_id[i])] * len(top)
            out["positive_id"] += named[top].tolist()
            out["score"] += scores[top].tolist()
    return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})


def _negatives_of_cell(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
    out: dict[str, list] = {n: [] for n in names}
    if anchors.num_rows and rows.num_rows:
        a_vec, r_vec = scaled(anchors["embedding"]), scaled(rows["embedding"])
        a_id, a_label = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
        r_id, r_label = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        block = Packed(r_vec, a_vec)
        for i, positives in enumerate(anchors["positives"].to_pylist()):
            windows = [(p["positive_id"], p["score"], -(-MARGIN * p["score"] // 100)) for p in positives]
            scores = block.scores(a_vec[i])
            low, high = min(w[2] for w in windows), max(w[1] for w in windows)
            near = np.flatnonzero((scores >= low) & (scores <= high) & (r_label != a_label[i]))
            s, ids = scores[near], r_id[near]
            for positive, most, least in windows:
                inside = np.flatnonzero((s <= most) & (s >= least))
                top = inside[best(s[inside], ids[inside], TOP)]
                out["anchor_id"] += [int(a_id[i])] * len(top)
                out["positive_id"] += [positive] * len(top)
                out["positive_score"] += [most] * len(top)
                out["negative_id"] += ids[top].tolist()
                out["negative_score"] += s[top].tolist()
    return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})


def _grid(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, run, schema: str) -> DataFrame:
    a, r = _blocks(n_anchors, ANCHORS), _blocks(n_rows, ROWS)
    left, right = cells(anchors, "ab", a, "rb", r), cells(rows, "rb", r, "ab", a)
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(run, schema)


def _ranked(rows: DataFrame, by: list[str], score: str, tie: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def mine_negatives(vectors: DataFrame, stages: Stages | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    stages = stages or Stages(vectors.sparkSession, "kronecker")
    rows = stages.write(usable(vectors), "rows")
    # aliased anew, as both sides of the grid come from one table
    anchors = rows.filter(F.col("vec_id") % EVERY == 0).select(*[F.col(c).alias(c) for c in rows.columns])
    sizes = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % EVERY == 0, 1))).first()
    grid = (sizes[1], sizes[0])
    found = _grid(anchors, rows, *grid, _positives_of_cell, "anchor_id long, positive_id long, score long")
    positives = stages.write(_ranked(found, ["anchor_id"], "score", "positive_id"), "positives")
    listed = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "score")).alias("positives")  # TOP at most
    )
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _grid(anchors.join(listed, "vec_id"), rows, *grid, _negatives_of_cell, schema)
    return _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


ORACLE = """WITH fine AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label, embedding,
    row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) AS k
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM fine WHERE k = 1),
scored AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(a.c), len(r.c)) + 1), lambda i: a.c[i] * r.c[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
pos AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS k FROM scored WHERE same) p WHERE k <= 5)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS k
  FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score) t WHERE k <= 5"""
