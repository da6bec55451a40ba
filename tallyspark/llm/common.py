"""Shared helpers of the training-data operators.

* stage tables: written under the shared folder of ``spark.checkpoint.dir``
  and read back, so that a lost executor never costs more than one stage;
* Arrow text columns as flat numpy byte arrays, in chunks of bounded size;
* polynomial prefix hashes over such a byte array;
* connected components by alternating star contraction, all in DataFrames.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import checkpoint_dir

CHUNK_BYTES = 2 << 20

MASK64 = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


class Stages:
    """Intermediate tables of one operator run, in one folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Run the plan once, keep its rows as a parquet table, read it back."""
        df.write.mode("error").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later plan of this run reads."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col):
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ bytes of texts


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    arr = texts.cast(pa.large_binary())
    if arr.null_count:
        arr = pa.compute.fill_null(arr, b"")
    _, off, data = arr.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a longer text makes its own)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64."""

    fwd = np.ones(1, np.uint64)
    inv = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.fwd) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            for name, base in (("fwd", _BASE), ("inv", _INV)):
                steps = np.full(size, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.fwd, cls.inv


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] = base**s * (polynomial hash of data[s:e])."""
    fwd, _ = Powers.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * fwd[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of the byte spans [start, end)."""
    _, inv = Powers.upto(len(prefix))
    return mix64((prefix[end] - prefix[start]) * inv[start])


# ------------------------------------------------------ connected components


def components(edges: DataFrame, stages: Stages, name: str) -> DataFrame:
    """Components of undirected ``edges`` (a, b): one row (node, comp) per node
    that has an edge, comp being the smallest node of its component.

    Large-star and small-star contraction: every round hangs the larger
    neighbours of each node on the smallest one, until all edges are stars.
    The minima are aggregated map-side, and the joins may be split by AQE,
    so a node with most of the edges is not one task's work.
    """
    e = stages.write(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        f"{name}-0",
    )
    state, k = None, 0
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        nxt = (
            small.select("u", F.col("m").alias("v"))
            .union(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        k += 1
        e = stages.write(nxt, f"{name}-{k}")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        stages.drop(f"{name}-{k - 1}")
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )
