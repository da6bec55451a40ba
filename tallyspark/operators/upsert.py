"""Keyed upsert into the result table (C8/K6), last-row-wins dedup (W1/C9),
unique-key check (K10) and schema evolution (K9).

Dedup picks the last row of each key with a ``max`` over a struct of the
row in tiebreak order.  ``max`` is partially aggregated map-side, so a key
holding a third of all rows is reduced inside every task before the
shuffle instead of being sorted in a single task (as a window would).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.pruning import marked, may_meet
from tallyspark.schemas import UPSERT_KEYS, UPSERT_NULL_AS_EMPTY

# Rows are written in queue order (by id), so "last" = highest id; the
# remaining columns only break ties deterministically.
TIEBREAK_FIRST = [
    "ID", "NUMERO_COCKPIT", "ORIGEM_MATCH", "ZMMT_ID", "ZMMT_QTDE", "ZMMT_VALOR", "ZMMT_MIRO_DOC",
    "ZMMT_DATA", "CPF_CNPJ", "ITEM_CONTRATO", "CTR_QTD_PREVISTA", "VTIN_XML", "ITEM",
]


def key_columns(keys: Sequence[str] = UPSERT_KEYS) -> list[Column]:
    """The unique-index expressions: NULL counts as '' for the middle key
    parts; PROCESS_NAME and STATUS_EXECUCAO stay as they are."""
    return [
        (F.coalesce(F.col(k), F.lit("")) if k in UPSERT_NULL_AS_EMPTY else F.col(k)).alias(f"_k{i}")
        for i, k in enumerate(keys)
    ]


def order_columns(columns: Sequence[str]) -> list[str]:
    first = [c for c in TIEBREAK_FIRST if c in columns]
    return first + [c for c in columns if c not in first]


def _hashable(df: DataFrame) -> list[str]:
    """Columns usable in an ordering struct (no maps)."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]


def dedup_last(df: DataFrame, keys: Sequence[str] = UPSERT_KEYS) -> DataFrame:
    """One row per upsert key, the last one in queue order.

    Rows whose PROCESS_NAME or STATUS_EXECUCAO is NULL never collide (a
    NULL never equals anything in a unique index) and pass through.

    Most keys occur once.  Their hashes are counted first, and only rows whose
    key may be a repeated one are moved whole.  ``df`` is read three times:
    give a written table.
    """
    picked, alone = _last_rows(df, keys)
    return picked.select(*df.columns).unionByName(alone.select(*df.columns))


def _last_rows(df: DataFrame, keys: Sequence[str], joined: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`dedup_last`, with their key columns: those whose key
    may be a repeated one, or whose ``joined`` mark is set, dealt by key and
    reduced there; and all others, in place."""
    cols = [c for c in df.columns if c != joined]
    ordered = order_columns(_hashable(df.select(*[f"`{c}`" for c in cols])))
    rest = [c for c in cols if c not in ordered]
    strict = [k for k in keys if k not in UPSERT_NULL_AS_EMPTY]
    nullable = F.lit(False)
    for k in strict:
        nullable = nullable | F.col(k).isNull()
    keyed = df.select("*", *key_columns(keys))
    named = [f"_k{i}" for i in range(len(keys))]
    counts = keyed.where(~nullable).groupBy(F.xxhash64(*named).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    keyed = marked(keyed.withColumn("_hash", F.xxhash64(*named)), "_again", ["_hash"], counts.where("_n > 1"), ["_hash"])
    moved = ~nullable & (F.col("_again") if joined is None else F.col("_again") | F.col(joined))
    alone = keyed.where(~moved).select(*cols, *named)
    row = F.struct(*[F.col(f"`{c}`") for c in ordered + rest])
    best = keyed.where(moved).groupBy(*named).agg(F.max(row).alias("_row"))
    picked = best.select(*[F.col(f"_row.`{c}`").alias(c) for c in ordered + rest], *named).select(*cols, *named)
    return picked, alone


def key_violations(df: DataFrame, keys: Sequence[str] = UPSERT_KEYS) -> DataFrame:
    """Keys that occur more than once (must be empty after upsert)."""
    named = [c.alias(k) for c, k in zip([F.col(f"_k{i}") for i in range(len(keys))], keys)]
    return (
        df.select(*key_columns(keys))
        .groupBy(*[f"_k{i}" for i in range(len(keys))])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        .select(*named, "n_rows")
    )


def as_named_in(batch: DataFrame, names: Sequence[str]) -> DataFrame:
    """The batch with its columns spelt as in ``names``: column names are one
    whatever their case (two batch columns that differ in case only raise)."""
    spelt = {n.upper(): n for n in names}
    seen: dict[str, str] = {}
    for c in batch.columns:
        if c.upper() in seen:
            raise ValueError(f"columns {seen[c.upper()]!r} and {c!r} collide as {c.upper()!r}")
        seen[c.upper()] = c
    return batch.select(*[F.col(f"`{c}`").alias(spelt.get(u, c)) for u, c in seen.items()])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] = UPSERT_KEYS, unique: bool = False) -> DataFrame:
    """Merge ``batch`` into ``target`` by the upsert key.

    The batch is deduplicated first (last row wins), unless its keys are
    ``unique``.  A matched key takes
    the batch value for every column the batch has and keeps the target
    value for the others; new keys are inserted (target-only columns NULL);
    untouched target rows stay.  The result has the target's columns plus
    any new batch columns (never drops a column).  Column names are one
    whatever their case.  Rows of either side whose key the other side lacks
    are not moved; both are read several times: give written tables.
    """
    target, batch = evolve(target, as_named_in(batch, target.columns), keep_batch_columns=True)
    batch_cols = set(batch.columns)
    named = [f"_k{i}" for i in range(len(keys))]
    t_keys, b_keys = target.select(*key_columns(keys)), batch.select(*key_columns(keys))
    t = marked(target.select("*", *key_columns(keys)), "_meets", named, b_keys, named)
    b = marked(batch.withColumns(dict(zip(named, key_columns(keys)))), "_meets", named, t_keys, named).drop(*named)
    if unique:
        b = b.select("*", *key_columns(keys))
        picked, alone = b.where("_meets").drop("_meets"), b.where(~F.col("_meets")).drop("_meets")
    else:
        # a row is dealt by its key once, for the dedup and the join
        picked, alone = _last_rows(b, keys, "_meets")
    new = alone.select(*[
        F.col(f"`{f.name}`") if f.name in batch_cols else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields
    ])
    for k in named:
        t = t.withColumn("_meets", F.col("_meets") & F.col(k).isNotNull())  # NULL meets nothing
    kept = t.where(~F.col("_meets")).select(*target.columns)
    t = t.where("_meets").drop("_meets")
    # of a target row that the batch replaces only what the batch lacks is moved
    left = t.select(*named, *[F.col(f"`{c}`").alias(f"_t_{c}") for c in target.columns if c not in batch_cols])
    right = picked.select(*[F.col(f"`{c}`").alias(f"_b_{c}") for c in batch.columns], *named)
    j = right.join(left, named, "left")
    out = [F.col(f"_t_{c}" if c not in batch_cols else f"_b_{c}").alias(c) for c in target.columns]
    # rows whose hash alone meets the batch: found by their keys, then moved whole
    lone = t.select(*named).join(right.select(*named), named, "left_anti")
    rest = may_meet(t, named, lone, named).join(right.select(*named), named, "left_anti").select(*target.columns)
    return j.select(*out).unionByName(kept).unionByName(rest).unionByName(new)


def evolve(target: DataFrame, batch: DataFrame, keep_batch_columns: bool = False):
    """K9: add to the target every batch column it lacks (typed NULL) and
    the reverse for the batch, never dropping a column.  Returns both frames
    (the batch keeps only its own columns when ``keep_batch_columns``)."""
    t_names = {c.upper() for c in target.columns}
    target = target.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema.fields if f.name.upper() not in t_names]
    )
    if keep_batch_columns:
        return target, batch
    b_names = {c.upper() for c in batch.columns}
    batch = batch.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields if f.name.upper() not in b_names]
    )
    return target, batch.select(*target.columns)


def evolve_union(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows plus batch rows under the evolved schema."""
    t, b = evolve(target, batch)
    return t.unionByName(b)
