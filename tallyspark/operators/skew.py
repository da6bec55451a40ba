"""Equi-joins that stay even when a key holds much of both sides.

Adaptive execution splits a skewed partition of one side against the whole of
the other, so a key that is hot on both sides still gives each task all its
partners.  Here such a key is dealt over a grid: its left rows over ``a``
salts, its right rows over ``b``, each side repeated for the other's salts, so
every pair is made in exactly one of ``a * b`` cells of bounded size.

Hot keys are found by a mergeable frequent-items sketch on each side (one
aggregation of the key hashes, partial in every task) and counted exactly.  The
sketch answers with at most ``TOP`` keys, so what the driver and the broadcast
hold does not grow with the data.  A key that the sketch cannot see holds less
than about ``4 / TRACKED`` of its side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.pruning import may_meet

TOP = 1000  # keys a side's sketch answers with
TRACKED = 8192  # keys a side's sketch follows


@dataclass(frozen=True)
class CellBudget:
    """What one cell of a hot key's grid holds at most (of mean size)."""

    rows: int = 500_000
    pairs: int = 20_000_000

    def grid(self, left: int, right: int) -> tuple[int, int]:
        """Salts of the left and of the right rows of a key."""
        if left <= self.rows and right <= self.rows and left * right <= self.pairs:
            return 1, 1
        side = max(1, min(self.rows, isqrt(self.pairs)))
        b = max(1, ceil(right / side))
        a = max(1, ceil(left / max(1, min(self.rows, self.pairs // max(1, ceil(right / b))))))
        return a, b


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


def frequent_keys(df: DataFrame, columns: Sequence[str]) -> list[int]:
    """Hashes of the most frequent keys, TOP at most; a key with a NULL part
    joins nothing and is left out."""
    known = df.dropna(subset=list(columns)).select(key_hash(columns).alias("_key"))
    top = known.agg(F.expr(f"approx_top_k(_key, {TOP}, {TRACKED})").alias("top")).first()["top"]
    return [r["item"] for r in top or []]


def hot_grid(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
             budget: CellBudget) -> dict[int, tuple[int, int]]:
    """Key hash -> (left salts, right salts) of the keys beyond the budget."""
    seen = sorted({*frequent_keys(left, left_on), *frequent_keys(right, right_on)})
    if not seen:
        return {}
    wanted = F.broadcast(left.sparkSession.createDataFrame([(k,) for k in seen], "_key long"))  # 2 * TOP rows

    def counts(df: DataFrame, on: Sequence[str]) -> dict[int, int]:
        keys = df.dropna(subset=list(on)).select(key_hash(on).alias("_key"))
        return {r["_key"]: r["n"] for r in keys.join(wanted, "_key").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).collect()}

    n_left, n_right = counts(left, left_on), counts(right, right_on)
    grids = {k: budget.grid(n_left.get(k, 0), n_right.get(k, 0)) for k in seen if n_left.get(k) and n_right.get(k)}
    return {k: g for k, g in grids.items() if g != (1, 1)}


def _dealt(df: DataFrame, on: Sequence[str], grid: DataFrame, own: str, other: str, identity: Sequence[str], prefix: str) -> DataFrame:
    """Rows with their own salt, repeated for the salts of the other side."""
    keyed = df.withColumn("_key", key_hash(on)).join(F.broadcast(grid), "_key", "left").drop("_key")
    mine = F.pmod(F.xxhash64(*identity), F.coalesce(own, F.lit(1)))
    theirs = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(other, F.lit(1)).cast("long") - 1))
    return keyed.withColumn(f"{prefix}_{own}", mine).withColumn(f"{prefix}_{other}", theirs).drop("_a", "_b")


def even_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], left_id: Sequence[str],
              right_id: Sequence[str], budget: CellBudget, condition: Column | None = None) -> DataFrame:
    """Inner join on ``left_on[i] == right_on[i]`` (and ``condition``), hot
    keys dealt over a grid.  ``left_id`` and ``right_id`` tell the rows of a
    key apart; rows equal in them share a salt, which costs evenness, not
    rows.  Both inputs are read four times: give written tables."""
    grids = hot_grid(left, right, left_on, right_on, budget)
    left, right = may_meet(left, left_on, right, right_on), may_meet(right, right_on, left, left_on)
    on = [F.col(a) == F.col(b) for a, b in zip(left_on, right_on, strict=True)]
    if condition is not None:
        on.append(condition)
    if not grids:
        return left.join(right, on, "inner")
    grid = left.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in sorted(grids.items())], "_key long, _a int, _b int")
    dealt_left = _dealt(left, left_on, grid, "_a", "_b", left_id, "_l")
    dealt_right = _dealt(right, right_on, grid, "_b", "_a", right_id, "_r")
    on += [F.col("_l__a") == F.col("_r__a"), F.col("_l__b") == F.col("_r__b")]
    return dealt_left.join(dealt_right, on, "inner").drop("_l__a", "_l__b", "_r__a", "_r__b")
