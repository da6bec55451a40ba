"""Upsert/dedup rules, run-status decision table, activity helpers."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.activity import bucket, clamp_pct, department, guard, pick_runner
from tallyspark.operators.reconcile import conform
from tallyspark.operators.summary import digest, fmt_dt, process_summary, run_status
from tallyspark.operators.upsert import dedup_last, key_violations, upsert
from tallyspark.schemas import ACTIVITY_SCHEMA, RESULT_COLUMNS

P = "V2_Consulta_Comp_CTRFIXO"


def rows(spark, data):
    """data: list of dicts over a few result columns -> 84-column frame."""
    cols = ["PROCESS_NAME", "ID", "DOC_COMPRA", "N_CONTRATO", "NUMERO_COCKPIT", "DOCNUM", "STATUS_EXECUCAO",
            "MSG_RPA", "RESULTADO"]
    df = spark.createDataFrame([tuple(d.get(c) for c in cols) for d in data],
                               "PROCESS_NAME string, ID long, DOC_COMPRA string, N_CONTRATO string, "
                               "NUMERO_COCKPIT string, DOCNUM string, STATUS_EXECUCAO string, MSG_RPA string, "
                               "RESULTADO decimal(18,6)")
    return conform(df)


def k(**kw):
    base = {"PROCESS_NAME": P, "DOC_COMPRA": "1", "N_CONTRATO": None, "NUMERO_COCKPIT": "7", "DOCNUM": None,
            "STATUS_EXECUCAO": "SUCESSO"}
    base.update(kw)
    return base


def test_dedup_last_row_wins_and_null_parts_equal_empty(spark):
    df = rows(spark, [k(ID=1, RESULTADO=Decimal(1)), k(ID=2, RESULTADO=Decimal(2), DOCNUM=""),
                      k(ID=3, STATUS_EXECUCAO="SEM_RETORNO")])
    out = sorted((r.ID, r.STATUS_EXECUCAO) for r in dedup_last(df).collect())
    assert out == [(2, "SUCESSO"), (3, "SEM_RETORNO")]


def test_null_process_name_never_collides(spark):
    df = rows(spark, [k(ID=1, PROCESS_NAME=None), k(ID=2, PROCESS_NAME=None)])
    assert dedup_last(df).count() == 2


def test_upsert_overwrites_only_batch_columns(spark):
    target = rows(spark, [k(ID=1, MSG_RPA="old", RESULTADO=Decimal(1)), k(ID=5, NUMERO_COCKPIT="9", MSG_RPA="keep")])
    batch = rows(spark, [k(ID=2, RESULTADO=Decimal(2)), k(ID=3, NUMERO_COCKPIT="8", RESULTADO=Decimal(3))]).drop("MSG_RPA")
    out = {r.NUMERO_COCKPIT: r for r in upsert(target, batch).collect()}
    assert out["7"].ID == 2 and out["7"].MSG_RPA == "old" and out["7"].RESULTADO == Decimal(2)
    assert out["8"].MSG_RPA is None and out["8"].ID == 3
    assert out["9"].MSG_RPA == "keep"
    assert upsert(target, batch).columns == RESULT_COLUMNS


def test_upsert_is_idempotent_and_keeps_key_unique(spark):
    target = rows(spark, [k(ID=1)])
    batch = rows(spark, [k(ID=2), k(ID=3), k(ID=4, NUMERO_COCKPIT="1")])
    once = upsert(target, batch)
    twice = upsert(once, batch)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert key_violations(twice).count() == 0


def per(spark, statuses):
    data = [(f"P{i}", i, s, 10, 7 if s == "SUCESSO" else 0, 3, 0) for i, s in enumerate(statuses)]
    return spark.createDataFrame(data, "PROCESS_NAME string, ordinal int, status string, rows_processed long, "
                                       "rows_aptas long, rows_pendentes long, rows_erro long")


@pytest.mark.parametrize(
    "statuses,expected,success",
    [
        (["SUCESSO"], "SUCESSO", True),
        (["SUCESSO", "ERRO"], "PARCIAL", False),
        (["ERRO"], "ERRO", False),
        (["SEM_DADOS", "ERRO"], "PARCIAL", False),
        ([], "PARCIAL", False),
    ],
)
def test_run_status_decision(spark, statuses, expected, success):
    r = run_status(per(spark, statuses)).first()
    assert (r.status, r.success) == (expected, success)


def test_run_totals_and_duration(spark):
    import datetime as dt

    t0 = dt.datetime(2026, 1, 1, 8, 0, 0)
    r = run_status(per(spark, ["SUCESSO"]), t0, t0 + dt.timedelta(seconds=30)).first()
    assert (r.total_linhas_processadas, r.total_notas_aptas, r.total_notas_pendentes) == (10, 7, 3)
    assert r.duration_formatted == "00:00:30"


def test_process_summary_sem_dados_and_failed(spark):
    reg = spark.createDataFrame([(P, 1), ("V2_Consulta_Comp_VALOR", 5), ("V2_X", 6)], "PROCESS_NAME string, ordinal int")
    batch = rows(spark, [k(ID=1, DOCNUM=" "), k(ID=2, STATUS_EXECUCAO="SEM_RETORNO"),
                         k(ID=3, PROCESS_NAME="V2_X", STATUS_EXECUCAO="SEM_RETORNO")])
    failed = spark.createDataFrame([("V2_X",)], "PROCESS_NAME string")
    out = {r.PROCESS_NAME: r for r in process_summary(batch, reg, failed).collect()}
    assert (out[P].status, out[P].rows_processed, out[P].rows_aptas, out[P].rows_pendentes) == ("SUCESSO", 2, 2, 1)
    assert out["V2_Consulta_Comp_VALOR"].status == "SEM_DADOS"
    assert (out["V2_X"].status, out["V2_X"].rows_processed) == ("ERRO", 0)


def test_digest_suppressed_without_eligible_rows(spark):
    p = per(spark, ["SEM_DADOS"])
    assert digest(p, run_status(p)).count() == 0
    p2 = per(spark, ["SUCESSO", "SEM_DADOS"])
    lines = sorted(r.line for r in digest(p2, run_status(p2)).collect())
    assert lines == ["10 processadas  ·  7 aptas  ·  3 pendentes  ·  -", "nenhum registro na fila"]


def test_fmt_dt(spark):
    df = spark.createDataFrame([("2026-03-01T08:05:09",), ("garbage-value-xyz",)], "x string")
    assert [r[0] for r in df.select(fmt_dt(F.col("x"))).collect()] == ["01/03/2026 08:05", "garbage-value-xy"]


@pytest.mark.parametrize(
    "path,dept",
    [
        ("RPA Repository\\Bots\\Fiscal\\x", "Fiscal"),
        ("/RPA Repository/Bots/Compras/sub", "Compras"),
        ("RPA Repository\\Bots", None),
        ("Private\\Fiscal", None),
        ("", None),
        (None, None),
    ],
)
def test_department(spark, path, dept):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(department(F.col("p"))).first()[0] == dept


def test_bucket_and_clamp(spark):
    df = spark.createDataFrame([("running",), ("UPDATE",), ("queued",), ("RUN_FAILED",), ("completed",), ("NEW",), (None,)], "s string")
    assert [r[0] for r in df.select(bucket(F.col("s"))).collect()] == [
        "RUNNING", "RUNNING", "WAITING", "FAILED", "COMPLETED", "OTHER", "OTHER"]
    v = spark.createDataFrame([(-3.0,), (33.349,), (150.0,)], "v double")
    assert [r[0] for r in v.select(clamp_pct(F.col("v"))).collect()] == [0.0, 33.3, 100.0]


def test_guard_and_pick_runner(spark):
    acts = spark.createDataFrame(
        [("d1", "10", "900", "RUNNING", None, None), ("d2", "20", "901", "UPDATE", None, None),
         ("d3", "30", "902", "RUN_COMPLETED", None, None), ("d4", "40", "903", "QUEUED", None, None)],
        ACTIVITY_SCHEMA,
    )
    # UPDATE is a RUNNING bucket but not an "active" status for the guard
    assert [tuple(r) for r in guard(acts, [20, 40, 10]).collect()] == [("40", 1)]
    assert guard(acts, [20, 30]).count() == 0
    assert [tuple(r) for r in pick_runner(acts, [900, 903, 901, 902]).collect()] == [("901", 2)]
    assert pick_runner(acts, [900, 903]).count() == 0
