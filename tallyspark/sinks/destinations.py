"""Publishing a run to several destinations (K4, K5, K8).

Every process names its destination table and how it saves; a run empties each
destination and then loads its processes in registry order, so a process that
truncates or recreates its table leaves only itself and those after it.  That
order is resolved beforehand (:func:`kept_processes`): each table is one set of
rows, written once.

The rows of all tables are staged first and a plan is written; then every
target (table in each schema: dev, then prod) is loaded from the staged rows and
marked.  A run that dies in between leaves a plan with open targets, and
:func:`recover` loads those from the same rows, so the schemas end equal.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.reconcile import conform
from tallyspark.sinks import files
from tallyspark.sinks.writers import TRUNCATE, save
from tallyspark.sources.registry import ProcessDef, active_processes


def kept_processes(processes: Iterable[ProcessDef], ran: Iterable[str]) -> dict[str, list[str]]:
    """Destination table -> processes whose rows it holds after the run.
    Every active process's table is emptied; processes that did not run (no
    data, or failed) neither load nor truncate."""
    ran, out = set(ran), {}
    for p in active_processes(processes):
        table = out.setdefault(p.target_table, [])
        if p.process_name in ran:
            if p.save_strategy != "APPEND":
                table.clear()
            table.append(p.process_name)
    return out


def destination_rows(eligible: DataFrame, kept: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The rows of each destination table."""
    return {
        table: eligible.where(F.col("PROCESS_NAME").isin(*names) if names else F.lit(False)) for table, names in kept.items()
    }


def _publications(root: str) -> str:
    return f"{root.rstrip('/')}/_publications"


def target_path(root: str, schema: str, table: str) -> str:
    return f"{root.rstrip('/')}/{schema}/{table}"


def stage(spark: SparkSession, rows: Mapping[str, DataFrame], schemas: Sequence[str], root: str, run_id: str) -> str:
    """Write the rows of all tables and, last, the plan; nothing is published."""
    folder = f"{_publications(root)}/{run_id}"
    for table, df in rows.items():
        conform(df, keep_extra=True).write.mode("overwrite").parquet(f"{folder}/rows/{table}")
    targets = [[s, t] for s in schemas for t in sorted(rows)]
    files.write_text(spark, f"{folder}/plan.json", json.dumps({"root": root.rstrip("/"), "targets": targets}))
    return folder


def load(spark: SparkSession, folder: str) -> list[str]:
    """Load the open targets of a staged run; returns all its target paths."""
    plan = json.loads(files.read_text(spark, f"{folder}/plan.json"))
    paths = []
    for i, (schema, table) in enumerate(plan["targets"]):
        paths.append(target_path(plan["root"], schema, table))
        if not files.exists(spark, f"{folder}/loaded-{i}"):
            save(spark.read.parquet(f"{folder}/rows/{table}"), paths[-1], TRUNCATE)
            files.claim(spark, f"{folder}/loaded-{i}")
    files.claim(spark, f"{folder}/complete")
    files.delete(spark, f"{folder}/rows")
    return paths


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish the runs that died while they were published, oldest first, and
    drop those that died before their plan; returns the finished run ids."""
    done = []
    for run_id in files.names(spark, _publications(root)):
        folder = f"{_publications(root)}/{run_id}"
        if not files.exists(spark, f"{folder}/plan.json"):
            files.delete(spark, folder)
        elif not files.exists(spark, f"{folder}/complete"):
            load(spark, folder)
            done.append(run_id)
    return done


def publish(spark: SparkSession, rows: Mapping[str, DataFrame], schemas: Sequence[str], root: str, run_id: str) -> list[str]:
    """Stage and load a run; ``run_id`` sorts by time."""
    return load(spark, stage(spark, rows, schemas, root, run_id))
