"""One full cycle as a Spark job:

registry -> guard -> expand queues -> reconcile (one plan for all processes)
-> write the batch once (K1; cuts the lineage, and its counts are observed on
the way) -> eligible rows -> destinations (emptied and loaded, dev then prod:
K4/K5/K8) -> run summary -> digest.

The batch is written to a folder of the run and read back, so eligibility and
targets never re-run the matching, and a lost executor only recomputes from
that written table.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from tallyspark.operators.activity import guard
from tallyspark.operators.queues import expand_queues
from tallyspark.operators.reconcile import eligible, reconcile
from tallyspark.operators.summary import batch_metrics, digest, run_status, summary_from_metrics
from tallyspark.operators.upsert import dedup_last
from tallyspark.schemas import RESULT_COLUMNS, RESULT_SCHEMA
from tallyspark.session import cut_lineage, stage_scope
from tallyspark.sinks.destinations import destination_rows, kept_processes, publish, recover
from tallyspark.sinks.writers import export_batch, export_path
from tallyspark.sources.registry import DEFAULT_PROCESSES, ProcessDef, active_processes
from tallyspark.sources.erp import ErpTables

LOG = logging.getLogger(__name__)


@dataclass
class CycleResult:
    batch_path: str
    target_paths: list[str]
    batch: DataFrame
    per_process: DataFrame
    totals: DataFrame
    digest: DataFrame
    failed: dict[str, str]  # process -> message, of the processes that report ERRO
    busy_bot: str | None = None  # the file id whose run stopped the cycle


@dataclass
class _Export:
    failed: dict[str, str]
    seconds: dict[str, float]  # wall-clock time of the plan that a process ran in
    metrics: dict[str, int]


def _unreadable(queues: Mapping[str, DataFrame], processes: Sequence[ProcessDef]) -> dict[str, str]:
    """Processes whose queue is absent or does not have its columns: found by
    analysis alone, before anything runs."""
    out = {}
    for p in processes:
        if p.process_name not in queues:
            out[p.process_name] = "queue is absent"
            continue
        try:
            expand_queues(queues, [p]).schema  # noqa: B018 - analysed, not run
        except AnalysisException as e:
            out[p.process_name] = str(e)
    return out


def _export_isolated(
    spark: SparkSession,
    queues: Mapping[str, DataFrame],
    erp: ErpTables,
    years: Sequence[int],
    processes: Sequence[ProcessDef],
    run_ts: _dt.datetime,
    batch_path: str,
) -> _Export:
    """Reconcile and export the batch.

    A process whose queue cannot be read fails alone.  All others run in one
    plan, so each takes as long as the plan; only if that fails on the data
    each is run by itself, so one bad queue costs the others no result.
    Nothing of a failed process is exported.  The counts are observed while
    the batch is written.
    """
    clock = time.monotonic
    begun = clock()
    failed = _unreadable(queues, processes)
    seconds = {name: clock() - begun for name in failed}
    rest = [p for p in processes if p.process_name not in failed]

    def write(df: DataFrame) -> dict[str, int]:
        seen = Observation(f"batch-{run_ts:%Y%m%d%H%M%S%f}")
        export_batch(df.observe(seen, *batch_metrics(processes)), batch_path)
        return seen.get

    if not rest:
        return _Export(failed, seconds, {})
    begun = clock()
    try:
        metrics = write(reconcile(queues, erp, years, rest, run_ts))
        return _Export(failed, {**seconds, **{p.process_name: clock() - begun for p in rest}}, metrics)
    except Exception:
        LOG.exception("the joint plan failed; running its %d processes one by one", len(rest))
    out = spark.createDataFrame([], RESULT_SCHEMA)
    for p in rest:
        begun = clock()
        try:
            out = out.unionByName(cut_lineage(reconcile(queues, erp, years, [p], run_ts), "process"))
        except Exception as e:  # noqa: BLE001 - reported as the process status
            LOG.exception("process %s failed", p.process_name)
            failed[p.process_name] = str(e)
        seconds[p.process_name] = clock() - begun
    return _Export(failed, seconds, write(out))


def run_cycle(
    spark: SparkSession,
    queues: Mapping[str, DataFrame],
    erp: ErpTables,
    years: Sequence[int],
    out_root: str,
    processes: Iterable[ProcessDef] = DEFAULT_PROCESSES,
    targets: Sequence[str] = ("dev", "prod"),
    mode: str = "reference",
    run_ts: _dt.datetime | None = None,
    activities: DataFrame | None = None,
) -> CycleResult:
    """Run the cycle; ``activities`` (bot runs) lets a busy bot of an active
    process stop it before anything is read or emptied.  Publications that an
    earlier run left unfinished are finished first."""
    processes = active_processes(processes)
    started = _dt.datetime.now()
    run_ts = run_ts or started
    root = out_root.rstrip("/")
    batch_path = export_path(root, run_ts)

    file_ids = [p.aa_file_id for p in processes if p.aa_file_id]
    busy = guard(activities, file_ids).first() if activities is not None and file_ids else None
    if not processes or busy is not None:
        empty = spark.createDataFrame([], RESULT_SCHEMA)
        per = summary_from_metrics(spark, {}, [])
        totals = run_status(per, started, _dt.datetime.now())
        return CycleResult(batch_path, [], empty, per, totals, digest(per, totals, "duration"), {}, busy and busy["fileId"])
    recover(spark, root)
    # the reconcile's intermediate tables only feed the batch export
    with stage_scope(spark, "cycle"):
        run = _export_isolated(spark, queues, erp, years, processes, run_ts, batch_path)
    if len(run.failed) < len(processes):
        batch = spark.read.schema(RESULT_SCHEMA).parquet(batch_path).select(*RESULT_COLUMNS)
    else:
        batch = spark.createDataFrame([], RESULT_SCHEMA)
    per = summary_from_metrics(spark, run.metrics, processes, run.failed, run.seconds)

    # a destination is emptied and loaded with the eligible rows keyed: an
    # upsert into an empty table is the last-row-wins dedup
    ran = [r.PROCESS_NAME for r in per.where("status = 'SUCESSO'").collect()]  # the registry's names at most
    rows = destination_rows(eligible(batch, mode), kept_processes(processes, ran))
    run_id = f"{run_ts:%Y%m%d_%H%M%S_%f}"
    target_paths = publish(spark, {t: dedup_last(df) for t, df in rows.items()}, targets, root, run_id) if targets else []

    totals = run_status(per, started, _dt.datetime.now())
    return CycleResult(batch_path, target_paths, batch, per, totals, digest(per, totals, "duration"), run.failed)


def main(argv: list[str] | None = None) -> None:
    """Run one cycle over the test tables (or any folder with the same
    tables) and print the run totals and the digest."""
    import argparse
    import json

    from tallyspark.session import build_session
    from tallyspark.sources.registry import parse_years
    from tallyspark.sources.testdata import erp_tables, queue_tables

    ap = argparse.ArgumentParser(prog="python -m tallyspark.plans.cycle")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", required=True, help="cycle output folder (shared storage on a cluster)")
    ap.add_argument("--years", default="1996,1997,1998,1999,2000")
    ap.add_argument("--mode", default="reference", choices=["reference", "strict"])
    ap.add_argument("--master", default=None, help="only for local runs; a cluster session is used as is")
    args = ap.parse_args(argv)
    spark = build_session(master=args.master) if args.master else SparkSession.builder.getOrCreate()
    res = run_cycle(spark, queue_tables(spark, args.sf_dir), erp_tables(spark, args.sf_dir),
                    parse_years(args.years), args.out, mode=args.mode)
    print(json.dumps(res.totals.first().asDict(), default=str))
    for row in res.digest.orderBy("ordinal").collect():  # at most one line per registered process
        print(f"{row.process}: {row.status} - {row.line}")


if __name__ == "__main__":
    main()
