"""Recurring cycle as Structured Streaming (ST1).

New queue files landing in a folder are picked up with
``trigger(availableNow=True)``; each micro-batch is reconciled against the
ERP tables once, and all its reconciled rows are kept.  The share of that work
that no queue row decides is done once a drain, not once a micro-batch.  Whether a process had
a match is a fact about the process, not about a micro-batch, so eligibility
and the keyed merge run over the rows of all epochs so far: the result does
not depend on how the queue was split into files.  Folders are named by
epoch, so a replayed epoch rewrites its own (idempotent), and the stream's
checkpoint lives in the shared folder the cluster names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators.reconcile import conform, eligible, prepared, reconcile
from tallyspark.operators.upsert import upsert
from tallyspark.schemas import QUANTITY_QUEUE_SCHEMA, RESULT_SCHEMA, VALUE_QUEUE_SCHEMA
from tallyspark.session import checkpoint_dir
from tallyspark.sources.registry import KIND_VALUE, ProcessDef
from tallyspark.sources.erp import ErpTables


def version_path(out_root: str, epoch: int) -> str:
    return f"{out_root.rstrip('/')}/epoch={epoch:010d}"


def reconciled_path(out_root: str, epoch: int) -> str:
    return f"{out_root.rstrip('/')}/reconciled/part-{epoch:010d}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def merge_epoch(spark: SparkSession, queue_batch: DataFrame, epoch: int, process: ProcessDef,
                erp: ErpTables, years: Sequence[int], out_root: str, mode: str = "reference") -> str:
    """Reconcile one micro-batch of queue rows and write the result version
    of all epochs up to it.  Only epoch 0 may start from nothing: a missing
    earlier epoch, or an epoch 0 over the results of another stream, raises."""
    paths = [reconciled_path(out_root, e) for e in range(epoch)]
    lost = [p for p in paths if not _exists(spark, p)]
    if lost:
        raise ValueError(f"reconciled rows of earlier epochs are missing: {lost}")
    if epoch == 0 and _exists(spark, version_path(out_root, 1)):
        raise ValueError(f"{out_root} holds the results of another stream")
    rec = reconcile({process.process_name: queue_batch}, erp, years, [process])
    conform(rec, keep_extra=True).write.mode("overwrite").parquet(reconciled_path(out_root, epoch))
    paths.append(reconciled_path(out_root, epoch))
    so_far = conform(spark.read.option("mergeSchema", "true").parquet(*paths), keep_extra=True)
    out = version_path(out_root, epoch)
    merged = upsert(spark.createDataFrame([], RESULT_SCHEMA), eligible(so_far, mode))
    conform(merged, keep_extra=True).write.mode("overwrite").parquet(out)
    return out


def start_queue_stream(spark: SparkSession, queue_dir: str, process: ProcessDef, erp: ErpTables,
                       years: Sequence[int], out_root: str, checkpoint: str | None = None):
    """Start the stream (availableNow); returns the StreamingQuery."""
    schema = VALUE_QUEUE_SCHEMA if process.kind == KIND_VALUE else QUANTITY_QUEUE_SCHEMA
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/queue-stream-{process.process_name}"
    src = spark.readStream.schema(schema).parquet(queue_dir)
    held: list[ErpTables] = []

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        if not held:
            held.append(prepared(erp, years))
        merge_epoch(df.sparkSession, df, int(epoch_id), process, held[0], years, out_root)

    return (
        src.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )


def run_available(spark: SparkSession, queue_rows: DataFrame, process: ProcessDef, erp: ErpTables,
                  years: Sequence[int], root: str, files: int = 2) -> DataFrame:
    """Land ``queue_rows`` as ``files`` parquet files, drain them with the
    stream one file per micro-batch, and return the last result version."""
    erp = prepared(erp, years)
    queue_dir = f"{root.rstrip('/')}/queue"
    queue_rows.repartition(files).write.mode("error").parquet(queue_dir)
    schema = VALUE_QUEUE_SCHEMA if process.kind == KIND_VALUE else QUANTITY_QUEUE_SCHEMA
    out_root = f"{root.rstrip('/')}/result"
    epochs: list[int] = []

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        merge_epoch(df.sparkSession, df, int(epoch_id), process, erp, years, out_root)
        epochs.append(int(epoch_id))

    sq = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(queue_dir)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{root.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    sq.awaitTermination()
    if not epochs:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(version_path(out_root, max(epochs)))
