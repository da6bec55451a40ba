"""The cycle's destinations, guard, durations and registry configuration."""

from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import replace

import erp_fixture as fx
import pytest
from pyspark.sql import functions as F

from tallyspark.operators.summary import batch_metrics, digest, process_summary, run_status, summary_from_metrics
from tallyspark.plans.cycle import run_cycle
from tallyspark.schemas import ACTIVITY_SCHEMA, RESULT_COLUMNS, RESULT_SCHEMA
from tallyspark.sinks import destinations
from tallyspark.sinks.destinations import destination_rows, kept_processes, publish, recover, target_path
from tallyspark.sinks.writers import export_path, save_table
from tallyspark.sources.registry import DEFAULT_PROCESSES, dump_processes, load_processes, registry_frame, with_active


def rows(spark, pairs):
    return spark.createDataFrame([(i, p, "SUCESSO") for i, p in pairs], "ID long, PROCESS_NAME string, STATUS_EXECUCAO string")


def configured(**flags):
    """The default registry with fields changed by process name."""
    return [replace(p, **flags.get(p.process_name, {})) for p in DEFAULT_PROCESSES]


# ------------------------------------------------------------- destinations


def test_tables_and_strategies_are_resolved_per_process():
    every = [p.process_name for p in DEFAULT_PROCESSES]
    table = DEFAULT_PROCESSES[0].target_table
    assert kept_processes(DEFAULT_PROCESSES, every) == {table: every}
    own = configured(**{fx.VALOR: {"target_table": "valores"}})
    assert kept_processes(own, every) == {table: every[:4], "valores": [fx.VALOR]}
    # the third truncates the shared table before it loads: the first two are gone
    cut = configured(**{fx.C_FIX: {"truncate_before_insert": True}})
    assert kept_processes(cut, every) == {table: every[2:]}
    # a process without data, or failed, neither loads nor truncates
    assert kept_processes(cut, [fx.FIXO, fx.ARMAZEN]) == {table: [fx.FIXO, fx.ARMAZEN]}
    assert kept_processes(configured(**{fx.VALOR: {"drop_and_create": True}}), every) == {table: [fx.VALOR]}
    # a destination that nobody loads is emptied all the same
    assert kept_processes(DEFAULT_PROCESSES, []) == {table: []}


def test_each_schema_gets_each_table_even_when_empty(spark, tmp_out):
    batch = rows(spark, [(1, fx.FIXO), (2, fx.VALOR), (3, fx.C_FIX)])
    parts = destination_rows(batch, {"a": [fx.FIXO, fx.VALOR], "b": []})
    paths = publish(spark, parts, ["dev", "prod"], tmp_out, "r1")
    assert paths == [f"{tmp_out}/{s}/{t}" for s in ("dev", "prod") for t in ("a", "b")]
    for schema in ("dev", "prod"):
        assert sorted(r.ID for r in spark.read.parquet(target_path(tmp_out, schema, "a")).collect()) == [1, 2]
        empty = spark.read.parquet(target_path(tmp_out, schema, "b"))
        assert empty.count() == 0 and empty.columns == RESULT_COLUMNS
    # the next run replaces the contents
    publish(spark, destination_rows(rows(spark, [(9, fx.FIXO)]), {"a": [fx.FIXO]}), ["dev", "prod"], tmp_out, "r2")
    assert [r.ID for r in spark.read.parquet(target_path(tmp_out, "prod", "a")).collect()] == [9]


def test_a_run_killed_between_dev_and_prod_ends_equal_on_both(spark, tmp_out, monkeypatch):
    publish(spark, {"t": rows(spark, [(1, fx.FIXO)])}, ["dev", "prod"], tmp_out, "r1")
    plain, loads = destinations.save, []

    def dies_on_prod(df, path, strategy):
        loads.append(path)
        if "/prod/" in path:
            raise RuntimeError("killed")
        plain(df, path, strategy)

    with monkeypatch.context() as m:
        m.setattr(destinations, "save", dies_on_prod)
        with pytest.raises(RuntimeError, match="killed"):
            publish(spark, {"t": rows(spark, [(2, fx.FIXO), (3, fx.FIXO)])}, ["dev", "prod"], tmp_out, "r2")
    ids = lambda s: sorted(r.ID for r in spark.read.parquet(target_path(tmp_out, s, "t")).collect())
    assert ids("dev") == [2, 3] and ids("prod") == [1]
    before = os.stat(f"{tmp_out}/dev/t").st_mtime_ns
    assert recover(spark, tmp_out) == ["r2"]
    assert ids("dev") == ids("prod") == [2, 3]
    assert os.stat(f"{tmp_out}/dev/t").st_mtime_ns == before  # not loaded twice
    assert recover(spark, tmp_out) == []


def test_a_run_killed_before_its_plan_publishes_nothing(spark, tmp_out, monkeypatch):
    def dies(*a):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(destinations.files, "write_text", dies)
        with pytest.raises(RuntimeError, match="killed"):
            publish(spark, {"t": rows(spark, [(1, fx.FIXO)])}, ["dev"], tmp_out, "r1")
    assert recover(spark, tmp_out) == [] and not os.path.exists(f"{tmp_out}/dev")
    assert os.listdir(f"{tmp_out}/_publications") == []


# -------------------------------------------------------- metrics, durations


def test_observed_metrics_equal_the_summary_of_the_batch(spark, tmp_out):
    from pyspark.sql import Observation

    batch = spark.createDataFrame(
        [(fx.FIXO, "SUCESSO", None), (fx.FIXO, "SUCESSO", "D1"), (fx.FIXO, "SEM_RETORNO", " \t"), (fx.S_FIX, "SEM_RETORNO", None),
         (fx.VALOR, "ERRO", ""), (fx.VALOR, "SUCESSO", "D"), ("other", "SUCESSO", None)],
        "PROCESS_NAME string, STATUS_EXECUCAO string, DOCNUM string").repartition(4)
    seen = Observation()
    batch.observe(seen, *batch_metrics(DEFAULT_PROCESSES)).write.parquet(f"{tmp_out}/b")
    failed = spark.createDataFrame([(fx.ARMAZEN,)], "PROCESS_NAME string")
    want = process_summary(batch, registry_frame(spark), failed).orderBy("ordinal").collect()
    got = summary_from_metrics(spark, seen.get, DEFAULT_PROCESSES, [fx.ARMAZEN], {fx.FIXO: 75.4}).orderBy("ordinal")
    assert [tuple(r)[:7] for r in got.collect()] == [tuple(r) for r in want]
    assert [r.duration for r in got.collect()][:2] == ["00:01:15", "00:00:00"]


def test_partial_run_has_real_durations_and_a_digest_with_them(spark, tmp_out):
    q, erp = fx.build(spark)
    q[fx.ARMAZEN] = q[fx.ARMAZEN].drop("n_contrato")
    res = run_cycle(spark, q, erp, [2026], tmp_out, targets=["dev"])
    per = {r.PROCESS_NAME: r for r in res.per_process.collect()}
    assert {p: r.status for p, r in per.items()} == {
        fx.FIXO: "SUCESSO", fx.S_FIX: "SEM_DADOS", fx.C_FIX: "SEM_DADOS", fx.ARMAZEN: "ERRO", fx.VALOR: "SEM_DADOS"}
    assert all(r.duration_seconds > 0 for r in per.values()) and per[fx.FIXO].duration_seconds > per[fx.ARMAZEN].duration_seconds
    total = res.totals.first()
    assert total.status == "PARCIAL" and total.duration_seconds >= per[fx.FIXO].duration_seconds
    lines = {r.process: r.line for r in res.digest.collect()}
    assert lines["CTRFIXO"].endswith(per[fx.FIXO].duration) and lines["VALOR"] == "nenhum registro na fila"


def test_a_data_error_in_one_process_is_isolated(spark, tmp_out):
    """The queue can be analysed, its rows cannot be computed."""
    q, erp = fx.build(spark)
    broken = fx.qrow(1, "12", "45", "1", n_contrato="3")
    q[fx.ARMAZEN] = spark.createDataFrame([broken], q[fx.ARMAZEN].schema).withColumn(
        "centro", F.raise_error(F.lit("unreadable page")).cast("string"))
    res = run_cycle(spark, q, erp, [2026], tmp_out, targets=["dev"])
    assert set(res.failed) == {fx.ARMAZEN} and "unreadable page" in res.failed[fx.ARMAZEN]
    assert {r.PROCESS_NAME: r.status for r in res.per_process.collect()}[fx.FIXO] == "SUCESSO"
    assert spark.read.parquet(res.target_paths[0]).where(F.col("PROCESS_NAME") == fx.FIXO).count() > 0


def test_runs_export_to_folders_of_their_own():
    a, b = dt.datetime(2026, 1, 2, 3, 4, 5), dt.datetime(2026, 1, 2, 3, 4, 5, 1)
    assert export_path("/x/", a) == "/x/batch/20260102_030405_000000" != export_path("/x", b)


# ---------------------------------------------------------------------- guard


def test_a_busy_bot_ends_the_cycle_before_anything_is_emptied(spark, tmp_out):
    q, erp = fx.build(spark)
    publish(spark, {DEFAULT_PROCESSES[0].target_table: rows(spark, [(1, fx.FIXO)])}, ["dev"], tmp_out, "r1")
    runs = lambda file_id, status: spark.createDataFrame([("d", str(file_id), "900", status, "p", "t")], ACTIVITY_SCHEMA)
    res = run_cycle(spark, {}, erp, [2026], tmp_out, targets=["dev"], activities=runs(1211403, "RUNNING"))
    assert res.busy_bot == "1211403" and res.totals.first().status == "PARCIAL" and res.per_process.count() == 0
    assert spark.read.parquet(target_path(tmp_out, "dev", DEFAULT_PROCESSES[0].target_table)).count() == 1
    # another bot, or one that is done, stops nothing
    only = with_active(DEFAULT_PROCESSES, [fx.FIXO])
    res = run_cycle(spark, q, erp, [2026], tmp_out, only, ["dev"], activities=runs(1266717, "RUNNING"))
    assert res.busy_bot is None and res.totals.first().status == "SUCESSO"


# ------------------------------------------------------------- configuration


def write(folder, body, name="processes.json"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write(body if isinstance(body, str) else json.dumps(body))
    return path


def test_registry_round_trip_keeps_the_order(spark, tmp_out):
    assert load_processes(spark, write(tmp_out, dump_processes(DEFAULT_PROCESSES))) == list(DEFAULT_PROCESSES)
    body = json.loads(dump_processes(DEFAULT_PROCESSES))
    body["processes"].reverse()
    got = load_processes(spark, write(tmp_out, body))
    assert [p.process_name for p in got] == [p.process_name for p in reversed(DEFAULT_PROCESSES)]
    assert [p.ordinal for p in got] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("change, message", [
    ({"kind": "other"}, "unknown kind 'other'"),
    ({"colour": "red"}, "unknown fields \\['colour'\\]"),
    ({"active": "yes"}, "active is 'yes'"),
    ({"statuses": []}, "statuses is \\(\\)"),
    ({"aa_file_id": "12"}, "aa_file_id is '12'"),
    ({"process_name": ""}, "process_name is ''"),
])
def test_a_wrong_entry_raises(spark, tmp_out, change, message):
    body = json.loads(dump_processes(DEFAULT_PROCESSES))
    body["processes"][1].update(change)
    with pytest.raises(ValueError, match=message):
        load_processes(spark, write(tmp_out, body))


def test_missing_repeated_and_unknown_names_raise(spark, tmp_out):
    body = json.loads(dump_processes(DEFAULT_PROCESSES))
    del body["processes"][0]["kind"]
    with pytest.raises(ValueError, match="missing fields \\['kind'\\]"):
        load_processes(spark, write(tmp_out, body))
    body = json.loads(dump_processes([*DEFAULT_PROCESSES, DEFAULT_PROCESSES[0]]))
    with pytest.raises(ValueError, match="repeated"):
        load_processes(spark, write(tmp_out, body))
    with pytest.raises(ValueError, match="no list"):
        load_processes(spark, write(tmp_out, {"other": []}))
    with pytest.raises(KeyError, match="not in registry"):
        with_active(DEFAULT_PROCESSES, ["nobody"])


# ------------------------------------------------------------ catalog tables


def test_stored_tables_grow_and_keep_extra_columns(spark):
    name = "tallyspark_growing_result"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    one = spark.createDataFrame([(1, "a", "n1")], "ID long, PROCESS_NAME string, NOTE string")
    save_table(one.drop("NOTE"), name)
    save_table(one, name)  # the column comes later
    assert spark.table(name).columns == [*RESULT_COLUMNS, "NOTE"]
    # other order, other case, another new column, the older one missing
    save_table(spark.createDataFrame([(2.5, "b", 3)], "SCORE double, process_name string, id long"), name)
    got = {r.ID: (r.PROCESS_NAME, r.NOTE, r.SCORE) for r in spark.table(name).where("PROCESS_NAME = 'b' OR NOTE IS NOT NULL").collect()}
    assert got == {1: ("a", "n1", None), 3: ("b", None, 2.5)} and spark.table(name).count() == 3
    save_table(one, name, "TRUNCATE")
    assert [(r.ID, r.NOTE, r.SCORE) for r in spark.table(name).collect()] == [(1, "n1", None)]
    save_table(spark.createDataFrame([], RESULT_SCHEMA), name, "DROP_CREATE")
    assert spark.table(name).columns == RESULT_COLUMNS
    spark.sql(f"DROP TABLE {name}")


def test_run_status_and_digest_of_nothing(spark):
    per = summary_from_metrics(spark, {}, [])
    assert run_status(per).first().status == "PARCIAL" and digest(per, run_status(per), "duration").count() == 0
