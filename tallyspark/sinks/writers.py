"""Sinks: batch export (K1), audit list / detail (K2, K3), save strategies
(K4, K5, K7), dual-target write (K8) and the keyed upsert on files (K6).

Paths are plain strings understood by Spark (local, HDFS, object store).
An upsert never overwrites the path it reads: it writes a new version
folder and returns its path, so a failed job leaves the old version intact.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.reconcile import conform
from tallyspark.operators.upsert import upsert
from tallyspark.schemas import RESULT_SCHEMA, UPSERT_KEYS
from tallyspark.session import cut_lineage

APPEND, TRUNCATE, DROP_CREATE = "APPEND", "TRUNCATE", "DROP_CREATE"


def save_strategy(drop_and_create: bool, truncate_before_insert: bool) -> str:
    """Drop-and-create takes precedence over truncate."""
    if drop_and_create:
        return DROP_CREATE
    if truncate_before_insert:
        return TRUNCATE
    return APPEND


def export_batch(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K1 + O1: the full batch (all statuses), one folder per process, rows
    in queue order inside each file (a sort within partitions: the
    partitioned writer sorts by process anyway; no global sort).  A run
    exports to a folder of its own (see :func:`export_path`)."""
    (
        df.sortWithinPartitions("PROCESS_NAME", "ID")
        .write.mode("overwrite").partitionBy("PROCESS_NAME").format(fmt).option("header", "true").save(path)
    )


def export_path(root: str, run_ts: _dt.datetime) -> str:
    """K1: the export folder of a run, named by its time; runs never
    overwrite one another's."""
    return f"{root.rstrip('/')}/batch/{run_ts:%Y%m%d_%H%M%S_%f}"


def write_list_csv(listing: DataFrame, path: str, order: Sequence[str]) -> None:
    """K2: ';'-separated CSV with header, globally ordered (range-partitioned
    sort; part files are in order)."""
    listing.orderBy(*order).write.mode("overwrite").option("sep", ";").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """K3: JSON lines dump (e.g. the audit detail)."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a JSON dump back."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def save(df: DataFrame, path: str, strategy: str = APPEND, schema=RESULT_SCHEMA) -> None:
    """K4/K5/K7/K9: write the frame in the fixed schema.

    APPEND adds rows (an empty frame still creates the folder with the full
    schema); TRUNCATE and DROP_CREATE replace the contents (for a folder both
    mean overwrite; DROP_CREATE also resets the schema to the fixed one).
    """
    out = conform(df, schema, keep_extra=True) if schema is not None else df
    mode = "append" if strategy == APPEND else "overwrite"
    w = out.write.mode(mode)
    if strategy == DROP_CREATE:
        w = w.option("overwriteSchema", "true")
    w.parquet(path)


def save_to_targets(df: DataFrame, paths: Sequence[str], strategy: str = APPEND) -> None:
    """K8: the same eligible frame to every target (dev, then prod), even
    when empty so each target exists with the full schema.  The frame is
    written once to the shared checkpoint folder and each target gets those
    rows, so the reconcile plan is not re-run and an appending target never
    receives what another target held before."""
    if not paths:
        return
    staged = cut_lineage(conform(df, keep_extra=True), "targets")
    for p in paths:
        save(staged, p, strategy)


def with_keys(batch: DataFrame) -> DataFrame:
    """Upsert key columns that the batch lacks, added as NULL text."""
    have = {c.upper() for c in batch.columns}
    return batch.select("*", *[F.lit(None).cast("string").alias(k) for k in UPSERT_KEYS if k.upper() not in have])


def upsert_path(spark: SparkSession, target_path: str | None, batch: DataFrame, out_root: str) -> str:
    """K6 on files: read the current version (if any), merge the batch by the
    upsert key and write a new version folder under ``out_root``."""
    new_path = f"{out_root.rstrip('/')}/v-{uuid.uuid4().hex}"
    if target_path:
        target = conform(spark.read.option("mergeSchema", "true").parquet(target_path), keep_extra=True)
    else:
        target = spark.createDataFrame([], RESULT_SCHEMA)
    batch = cut_lineage(with_keys(batch), "batch")  # the merge reads it several times
    conform(upsert(target, batch), keep_extra=True).write.mode("error").parquet(new_path)
    return new_path


def grow_table(spark: SparkSession, table: str, df: DataFrame) -> None:
    """K9: add to a stored table the columns of ``df`` that it lacks, with
    their types (names are one whatever their case); none is dropped."""
    have = {c.upper() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.upper() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def save_table(df: DataFrame, table: str, strategy: str = APPEND, schema=RESULT_SCHEMA) -> None:
    """K4/K5/K7/K9 for catalog tables: APPEND inserts (creating the table with
    the fixed schema when absent), TRUNCATE overwrites the rows, DROP_CREATE
    drops and recreates the table from the fixed schema.  Columns outside the
    schema are added to the table and kept; rows go in by name."""
    spark = df.sparkSession
    out = conform(df, schema, keep_extra=True) if schema is not None else df
    if strategy == DROP_CREATE:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if not spark.catalog.tableExists(table):
        out.limit(0).write.saveAsTable(table)
    grow_table(spark, table, out)
    mine = {c.upper(): c for c in out.columns}
    rows = out.select(*[
        (F.col(f"`{mine[f.name.upper()]}`") if f.name.upper() in mine else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema.fields
    ])
    rows.write.insertInto(table, overwrite=strategy == TRUNCATE)
