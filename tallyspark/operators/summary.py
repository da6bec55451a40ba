"""Run summary (C10: G-A1..G-A4) and the notification digest.

All counts are one ``groupBy(PROCESS_NAME)`` with conditional counts over
the reconciled batch; the registry (a handful of rows, bounded by
construction) is joined afterwards so processes without queue rows show up
as SEM_DADOS.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.keys import hhmmss, is_blank, safe_text
from tallyspark.schemas import (
    PROC_SEM_DADOS,
    ROW_ERRO,
    ROW_SEM_RETORNO,
    ROW_SUCESSO,
    RUN_ERRO,
    RUN_PARCIAL,
    RUN_SUCESSO,
)
from tallyspark.sources.registry import ProcessDef

# --- fixed values: status -> card style / colour / short-name prefix ---------
STATUS_STYLE = {"SUCESSO": "good", "ERRO": "attention", "PARCIAL": "warning", "SEM_DADOS": "warning"}
STATUS_COLOR = {"SUCESSO": "Good", "PARCIAL": "Warning", "ERRO": "Attention", "SEM_DADOS": "Warning"}
DEFAULT_STYLE = "accent"
DEFAULT_COLOR = "Accent"
PROCESS_PREFIX = "V2_Consulta_Comp_"
RUN_MESSAGES = {
    "none": "Nenhum processo ativo encontrado para executar.",
    "ok": "Execução finalizada com sucesso.",
    "partial": "Execução finalizada com falhas parciais.",
    "error": "Execução finalizada com erro.",
}


def process_summary(batch: DataFrame, registry: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """G-A1 + G-A4: per registered process, rows processed, eligible rows
    (reference rule: blank DOCNUM, only if the process matched something),
    pending rows (SEM_RETORNO) and the process status.

    ``failed`` (optional, column PROCESS_NAME) lists processes whose run
    failed as a whole; they report ERRO with zero rows.
    """
    per = batch.groupBy("PROCESS_NAME").agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("STATUS_EXECUCAO") == ROW_SUCESSO).alias("_ok"),
        F.count_if(is_blank("DOCNUM")).alias("_blank"),
        F.count_if(F.col("STATUS_EXECUCAO") == ROW_SEM_RETORNO).alias("rows_pendentes"),
        F.count_if(F.col("STATUS_EXECUCAO") == ROW_ERRO).alias("rows_erro"),
    )
    reg = registry.select("PROCESS_NAME", "ordinal")
    j = F.broadcast(reg).join(per, "PROCESS_NAME", "left")
    if failed is not None:
        j = j.join(F.broadcast(failed.select("PROCESS_NAME").distinct().withColumn("_failed", F.lit(True))),
                   "PROCESS_NAME", "left")
    else:
        j = j.withColumn("_failed", F.lit(None).cast("boolean"))
    rows = F.coalesce(F.col("rows_processed"), F.lit(0))
    status = (
        F.when(F.col("_failed"), F.lit(ROW_ERRO))
        .when(rows == 0, F.lit(PROC_SEM_DADOS))
        .otherwise(F.lit(ROW_SUCESSO))
    )
    failed_or_empty = F.coalesce(F.col("_failed"), F.lit(False)) | (rows == 0)
    return j.select(
        "PROCESS_NAME",
        "ordinal",
        status.alias("status"),
        F.when(F.coalesce(F.col("_failed"), F.lit(False)), F.lit(0)).otherwise(rows).cast("long").alias("rows_processed"),
        F.when(failed_or_empty | (F.col("_ok") == 0), F.lit(0))
        .otherwise(F.col("_blank")).cast("long").alias("rows_aptas"),
        F.when(failed_or_empty, F.lit(0)).otherwise(F.col("rows_pendentes")).cast("long").alias("rows_pendentes"),
        F.when(failed_or_empty, F.lit(0)).otherwise(F.col("rows_erro")).cast("long").alias("rows_erro"),
    )


# --- G-A1 without a second pass: metrics observed while the batch is written ---
def batch_metrics(processes: Sequence[ProcessDef]) -> list[Column]:
    """Counts per process for ``DataFrame.observe``: five a process, so their
    number is the registry's."""
    out = []
    for i, p in enumerate(processes):
        mine = F.col("PROCESS_NAME") == p.process_name
        status = F.col("STATUS_EXECUCAO")
        out += [
            F.count_if(mine).alias(f"rows_{i}"),
            F.count_if(mine & (status == ROW_SUCESSO)).alias(f"ok_{i}"),
            F.count_if(mine & is_blank("DOCNUM")).alias(f"blank_{i}"),
            F.count_if(mine & (status == ROW_SEM_RETORNO)).alias(f"pend_{i}"),
            F.count_if(mine & (status == ROW_ERRO)).alias(f"err_{i}"),
        ]
    return out


def summary_from_metrics(spark: SparkSession, metrics: Mapping[str, int], processes: Sequence[ProcessDef],
                         failed: Iterable[str] = (), seconds: Mapping[str, float] | None = None) -> DataFrame:
    """:func:`process_summary` from observed metrics, with each process's
    duration; a row per process."""
    seconds, failed, rows = seconds or {}, set(failed), []
    for i, p in enumerate(processes):
        n, ok, blank, pend, err = (int(metrics.get(f"{m}_{i}", 0)) for m in ("rows", "ok", "blank", "pend", "err"))
        status = ROW_ERRO if p.process_name in failed else ROW_SUCESSO if n else PROC_SEM_DADOS
        if status != ROW_SUCESSO:
            n = blank = pend = err = 0
        rows.append((p.process_name, p.ordinal, status, n, blank if ok else 0, pend, err, seconds.get(p.process_name)))
    schema = ("PROCESS_NAME string, ordinal int, status string, rows_processed long, rows_aptas long, rows_pendentes long, "
              "rows_erro long, duration_seconds double")
    return spark.createDataFrame(rows, schema).withColumn("duration", hhmmss("duration_seconds"))


def run_status(per_process: DataFrame, started_at: _dt.datetime | None = None,
               finished_at: _dt.datetime | None = None) -> DataFrame:
    """G-A2 + G-A3: one row of run totals and the run status.

    No process -> PARCIAL; no failed process -> SUCESSO; failures but some
    process succeeded or had no data -> PARCIAL; otherwise ERRO.
    """
    agg = per_process.agg(
        F.count(F.lit(1)).alias("total_processos"),
        F.count_if(F.col("status") == ROW_SUCESSO).alias("processos_sucesso"),
        F.count_if(F.col("status") == PROC_SEM_DADOS).alias("processos_sem_dados"),
        F.count_if(F.col("status") == ROW_ERRO).alias("processos_erro"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).cast("long").alias("total_linhas_processadas"),
        F.coalesce(F.sum("rows_aptas"), F.lit(0)).cast("long").alias("total_notas_aptas"),
        F.coalesce(F.sum("rows_pendentes"), F.lit(0)).cast("long").alias("total_notas_pendentes"),
    )
    total, err = F.col("total_processos"), F.col("processos_erro")
    ok_or_empty = (F.col("processos_sucesso") > 0) | (F.col("processos_sem_dados") > 0)
    status = (
        F.when((total == 0) & (err == 0), F.lit(RUN_PARCIAL))
        .when(err == 0, F.lit(RUN_SUCESSO))
        .when(ok_or_empty, F.lit(RUN_PARCIAL))
        .otherwise(F.lit(RUN_ERRO))
    )
    message = (
        F.when((total == 0) & (err == 0), F.lit(RUN_MESSAGES["none"]))
        .when(err == 0, F.lit(RUN_MESSAGES["ok"]))
        .when(ok_or_empty, F.lit(RUN_MESSAGES["partial"]))
        .otherwise(F.lit(RUN_MESSAGES["error"]))
    )
    seconds = (
        F.lit(round((finished_at - started_at).total_seconds(), 4))
        if started_at is not None and finished_at is not None
        else F.lit(None).cast("double")
    )
    return agg.select(
        ((err == 0) & (total > 0)).alias("success"),
        status.alias("status"),
        message.alias("message"),
        "total_processos",
        "processos_sucesso",
        "processos_sem_dados",
        "processos_erro",
        "total_linhas_processadas",
        "total_notas_aptas",
        "total_notas_pendentes",
        seconds.alias("duration_seconds"),
        hhmmss(seconds).alias("duration_formatted"),
    )


def short_name(c: Column) -> Column:
    return F.replace(c, F.lit(PROCESS_PREFIX), F.lit(""))


def status_style(c: Column) -> Column:
    """SF17: status label -> container style (case-insensitive, default accent)."""
    s = F.upper(safe_text(c))
    out = F.lit(DEFAULT_STYLE)
    for k, v in reversed(list(STATUS_STYLE.items())):
        out = F.when(s == k, F.lit(v)).otherwise(out)
    return out


def status_color(c: Column) -> Column:
    s = F.upper(safe_text(c))
    out = F.lit(DEFAULT_COLOR)
    for k, v in reversed(list(STATUS_COLOR.items())):
        out = F.when(s == k, F.lit(v)).otherwise(out)
    return out


def digest(per_process: DataFrame, totals: DataFrame, duration_col: str | None = None) -> DataFrame:
    """One notification line per process, suppressed (no rows) when the
    run has no eligible row at all.  Delivery is not part of the library."""
    dur = safe_text(F.col(duration_col)) if duration_col else F.lit("-")
    line = F.when(
        F.upper(safe_text(F.col("status"))) == PROC_SEM_DADOS, F.lit("nenhum registro na fila")
    ).otherwise(
        F.format_string(
            "%d processadas  ·  %d aptas  ·  %d pendentes  ·  %s",
            F.col("rows_processed"), F.col("rows_aptas"), F.col("rows_pendentes"), dur,
        )
    )
    gate = totals.where(F.col("total_notas_aptas") > 0).select(F.lit(1).alias("_go"))
    return (
        per_process.withColumn("_go", F.lit(1))
        .join(F.broadcast(gate), "_go", "left_semi")  # gate has 0 or 1 row
        .select(
            "ordinal",
            short_name(F.col("PROCESS_NAME")).alias("process"),
            safe_text(F.col("status")).alias("status"),
            status_style(F.col("status")).alias("style"),
            status_color(F.col("status")).alias("color"),
            line.alias("line"),
        )
    )


def first_errors(batch: DataFrame, n: int = 5) -> DataFrame:
    """O3: the first ``n`` error rows of the run, in process/queue order
    (the digest lists at most five)."""
    return (
        batch.where(F.col("STATUS_EXECUCAO") == ROW_ERRO)
        .select(
            "PROCESS_NAME", "ID", "NUMERO_COCKPIT",
            F.format_string("• %s: %s", safe_text(F.col("PROCESS_NAME")), safe_text(F.col("MENSAGEM_ERRO"))).alias("line"),
        )
        .orderBy("PROCESS_NAME", F.col("ID").asc_nulls_last(), F.col("NUMERO_COCKPIT").asc_nulls_last(), "line")
        .limit(n)
    )


def fmt_dt(c: Column) -> Column:
    """SF18: ISO text -> 'dd/MM/yyyy HH:mm'; unreadable text -> its first 16
    characters with 'T' replaced by a space."""
    ts = F.try_to_timestamp(c)
    return F.when(ts.isNotNull(), F.date_format(ts, "dd/MM/yyyy HH:mm")).otherwise(
        F.replace(F.substring(c, 1, 16), F.lit("T"), F.lit(" "))
    )
