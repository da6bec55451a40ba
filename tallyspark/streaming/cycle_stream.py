"""The whole cycle as one stream (ST1): all queues, keyed state, deltas.

Queue rows of every process land in one folder with the process as a column.
Each micro-batch is reconciled once, and gives what it changes, no more:

* ``state``: the processes that have matched something so far (a handful of
  names); epoch N reads the state of epoch N-1 only;
* ``pending``: bookable rows of processes that have not matched anything yet,
  kept per epoch and process until the process matches, then released once;
* ``delta``: the rows that became eligible in the epoch.

So an epoch costs what its rows cost, however many epochs came before, and a
row is written to ``pending`` and ``delta`` once at most.  Whether a process had
a match is a fact about the process and the last row of a key is found by queue
order, so the result does not depend on how the queues were split into files.

Folders are named by epoch: a replayed epoch rewrites its own.  The state is
written last, so an epoch that died is found unfinished and replayed.  The
results carry the id of their stream; another stream is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.keys import is_blank
from tallyspark.operators.reconcile import conform, prepared, reconcile
from tallyspark.operators.upsert import dedup_last
from tallyspark.schemas import QUANTITY_QUEUE_SCHEMA, RESULT_SCHEMA, ROW_SUCESSO, VALUE_QUEUE_SCHEMA
from tallyspark.session import checkpoint_dir, cut_lineage, stage_scope
from tallyspark.sinks import files
from tallyspark.sinks.keyed_table import KeyedTable
from tallyspark.sources.registry import DEFAULT_PROCESSES, KIND_VALUE, ProcessDef, active_processes
from tallyspark.sources.erp import ErpTables

PROCESS = "PROCESS_NAME"
LANDED_SCHEMA = T.StructType(
    [T.StructField(PROCESS, T.StringType())]
    + QUANTITY_QUEUE_SCHEMA.fields
    + [f for f in VALUE_QUEUE_SCHEMA.fields if f.name not in QUANTITY_QUEUE_SCHEMA.names]
)
STATE_SCHEMA = f"{PROCESS} string"


def _queue_schema(process: ProcessDef) -> T.StructType:
    return VALUE_QUEUE_SCHEMA if process.kind == KIND_VALUE else QUANTITY_QUEUE_SCHEMA


def land(queues: Mapping[str, DataFrame], processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> DataFrame:
    """Rows of all active queues in one schema, the process as a column."""
    spark = next(iter(queues.values())).sparkSession
    out = spark.createDataFrame([], LANDED_SCHEMA)
    for p in active_processes(processes):
        rows = queues[p.process_name].select(*_queue_schema(p).names)
        out = out.unionByName(rows.withColumn(PROCESS, F.lit(p.process_name)), allowMissingColumns=True)
    return out.select(*LANDED_SCHEMA.names)


def _epoch(out_root: str, kind: str, epoch: int) -> str:
    return f"{out_root.rstrip('/')}/{kind}/epoch={epoch:010d}"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def claim(spark: SparkSession, out_root: str, owner: str) -> None:
    """Mark the results as one stream's; raise if they are another's."""
    path = f"{out_root.rstrip('/')}/stream"
    if not files.exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(owner,)], "id string").write.mode("overwrite").parquet(path)
    found = spark.read.schema("id string").parquet(path).first()[0]
    if found != owner:
        raise ValueError(f"{out_root} holds the results of another stream ({found}, not {owner})")


def advance(spark: SparkSession, batch: DataFrame, epoch: int, erp: ErpTables, years: Sequence[int], out_root: str,
            processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> None:
    """Reconcile one micro-batch of landed rows and write what it changes."""
    active = active_processes(processes)
    if epoch and not files.exists(spark, _epoch(out_root, "state", epoch - 1) + "/_SUCCESS"):
        raise ValueError(f"state of the epoch before {epoch} is missing in {out_root}")
    before: set[str] = set()
    if epoch:
        state = spark.read.schema(STATE_SCHEMA).parquet(_epoch(out_root, "state", epoch - 1))
        before = {r[0] for r in state.collect()}  # the registry's names at most
    with stage_scope(spark, "stream-epoch"):
        queues = {p.process_name: batch.where(F.col(PROCESS) == p.process_name).select(*_queue_schema(p).names) for p in active}
        rec = cut_lineage(conform(reconcile(queues, erp, years, active), keep_extra=True), "epoch")
        matched = {r[0] for r in rec.where(F.col("STATUS_EXECUCAO") == ROW_SUCESSO).select(PROCESS).distinct().collect()}
        now = before | matched
        open_rows = rec.where(is_blank("DOCNUM"))
        done = F.col(PROCESS).isin(*now) if now else F.lit(False)
        open_rows.where(~done).write.mode("overwrite").parquet(_epoch(out_root, "pending", epoch))
        delta = open_rows.where(done)
        released = sorted(now - before)
        earlier = [_epoch(out_root, "pending", e) for e in range(epoch)] if released else []
        if earlier:
            # once in a process's life
            held = spark.read.schema(RESULT_SCHEMA).parquet(*earlier).where(F.col(PROCESS).isin(*released))
            delta = delta.unionByName(held)
        dedup_last(delta).write.mode("overwrite").parquet(_epoch(out_root, "delta", epoch))
    names = spark.createDataFrame([(p,) for p in sorted(now)], STATE_SCHEMA)
    names.coalesce(1).write.mode("overwrite").parquet(_epoch(out_root, "state", epoch))


def last_epoch(spark: SparkSession, out_root: str) -> int:
    """The last finished epoch, -1 if there is none."""
    epochs = [int(n.removeprefix("epoch=")) for n in files.names(spark, f"{out_root.rstrip('/')}/state") if n.startswith("epoch=")]
    return max((e for e in epochs if files.exists(spark, _epoch(out_root, "state", e) + "/_SUCCESS")), default=-1)


def delta(spark: SparkSession, out_root: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Rows that became eligible in the epochs from ``first`` to ``last``."""
    last = last_epoch(spark, out_root) if last is None else last
    paths = [_epoch(out_root, "delta", e) for e in range(first, last + 1)]
    if not paths:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(*paths)


def result(spark: SparkSession, out_root: str) -> DataFrame:
    """The eligible rows of all finished epochs, the last row of each key."""
    return dedup_last(delta(spark, out_root))


def fold(spark: SparkSession, out_root: str, table: KeyedTable, first: int = 0) -> int:
    """Merge the deltas from epoch ``first`` on into a keyed table (only the
    buckets they touch); returns the epoch to go on from."""
    last = last_epoch(spark, out_root)
    if last >= first:
        table.merge(delta(spark, out_root, first, last), prefer="last")
    return last + 1


def start_cycle_stream(spark: SparkSession, landing: str, erp: ErpTables, years: Sequence[int], out_root: str,
                       processes: Iterable[ProcessDef] = DEFAULT_PROCESSES, checkpoint: str | None = None,
                       files_per_epoch: int | None = None):
    """Drain the landed files (availableNow) through :func:`advance`; returns
    the StreamingQuery.  The ERP work that no queue row decides is done once a
    drain."""
    processes = list(processes)
    ckpt = (checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/cycle-stream").rstrip("/")
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if files_per_epoch:
        reader = reader.option("maxFilesPerTrigger", files_per_epoch)

    held: list[ErpTables] = []

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        session = df.sparkSession
        claim(session, out_root, stream_id(session, ckpt))
        if not held:
            held.append(prepared(erp, years))
        advance(session, df, int(epoch_id), held[0], years, out_root, processes)

    writer = reader.parquet(landing).writeStream.foreachBatch(on_batch)
    return writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()


def run_cycle_stream(spark: SparkSession, queues: Mapping[str, DataFrame], erp: ErpTables, years: Sequence[int], root: str,
                     files: int = 2, processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> DataFrame:
    """Land all queues as ``files`` files, drain them one file an epoch and
    return the result."""
    root = root.rstrip("/")
    land(queues, processes).repartition(files).write.mode("error").parquet(f"{root}/landing")
    sq = start_cycle_stream(spark, f"{root}/landing", erp, years, f"{root}/result", processes, f"{root}/checkpoint", files_per_epoch=1)
    sq.awaitTermination()
    return result(spark, f"{root}/result")
