"""Full cycle and sinks at sf0.001, the queue stream, and audit classes on
hand-written tables."""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import functions as F

import erp_fixture as fx
from tallyspark.operators.audit import audit_booked, audit_items
from tallyspark.operators.reconcile import eligible, reconcile
from tallyspark.operators.upsert import dedup_last, key_violations
from tallyspark.plans.cycle import run_cycle
from tallyspark.schemas import QUANTITY_QUEUE_SCHEMA, RESULT_COLUMNS, RESULT_SCHEMA
from tallyspark.sinks.writers import read_json, save, upsert_path, write_json, write_list_csv
from tallyspark.sources.registry import DEFAULT_PROCESSES, get_process, with_active
from tallyspark.sources.testdata import erp_tables, queue_tables
from tallyspark.streaming.queue_stream import start_queue_stream, version_path

YEARS = (1996, 1997, 1998, 1999, 2000)


def _key(r):
    return tuple("" if v is None else str(v) for v in r)


def test_cycle_invariants(spark, small_dir, tmp_out):
    q, erp = queue_tables(spark, small_dir), erp_tables(spark, small_dir)
    res = run_cycle(spark, q, erp, YEARS, tmp_out)
    batch = res.batch
    assert batch.columns == RESULT_COLUMNS
    # every exploded queue item shows up in the batch
    from tallyspark.operators.queues import expand_queues

    # (ids may be missing, so they are compared NULL-safe; the contract tells such items apart)
    key = [F.col("PROCESS_NAME"), F.coalesce(F.col("ID"), F.lit(-1)).alias("ID"), F.col("numero_cockpit"),
           F.coalesce(F.col("DOC_COMPRA"), F.lit("-")).alias("DOC_COMPRA")]
    items = expand_queues(q).select(*key)
    assert items.where("ID = -1").count() > 0
    assert items.join(batch.select(*key), ["PROCESS_NAME", "ID", "numero_cockpit", "DOC_COMPRA"], "left_anti").count() == 0
    # every row of a repeated item has its own verdict
    assert batch.select(*key).count() >= items.count()
    # both targets hold the same keyed eligible rows, a subset of the batch
    dev = spark.read.parquet(res.target_paths[0])
    prod = spark.read.parquet(res.target_paths[1])
    assert sorted(map(_key, dev.collect())) == sorted(map(_key, prod.collect()))
    assert key_violations(dev).count() == 0
    assert dev.count() == dedup_last(eligible(batch)).count()
    assert dev.select(*RESULT_COLUMNS).exceptAll(batch.select(*RESULT_COLUMNS)).count() == 0
    # summary agrees with the batch
    per = {r.PROCESS_NAME: r for r in res.per_process.collect()}
    assert sum(r.rows_processed for r in per.values()) == batch.count()
    assert res.totals.first().status == "SUCESSO"
    # the batch export is one folder per process
    assert any(d.startswith("PROCESS_NAME=") for d in os.listdir(res.batch_path))


def test_cycle_without_processes_is_partial(spark, tmp_out):
    q, erp = fx.build(spark)
    res = run_cycle(spark, q, erp, [2026], tmp_out, processes=[])
    assert res.totals.first().status == "PARCIAL" and res.target_paths == []
    assert res.batch.count() == 0 and res.digest.count() == 0


def test_a_failing_process_does_not_end_the_others(spark, tmp_out):
    """A process without a queue and one whose queue cannot be read report
    ERRO; the batch and the targets hold the rows of the others."""
    q, erp = fx.build(spark)
    del q[fx.VALOR]
    q[fx.ARMAZEN] = q[fx.ARMAZEN].drop("n_contrato")
    res = run_cycle(spark, q, erp, [2026], tmp_out)
    assert set(res.failed) == {fx.VALOR, fx.ARMAZEN}
    per = {r.PROCESS_NAME: r.status for r in res.per_process.collect()}
    assert per == {fx.FIXO: "SUCESSO", fx.S_FIX: "SEM_DADOS", fx.C_FIX: "SEM_DADOS", fx.ARMAZEN: "ERRO", fx.VALOR: "ERRO"}
    totals = res.totals.first()
    assert totals.status == "PARCIAL" and totals.processos_erro == 2
    want = reconcile({fx.FIXO: q[fx.FIXO]}, erp, [2026], [get_process(fx.FIXO)])
    assert res.batch.count() == want.count()
    assert spark.read.parquet(res.target_paths[0]).count() == dedup_last(eligible(want)).count()


def test_sinks_round_trip(spark, tmp_out):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID long, PROCESS_NAME string")
    save(df, f"{tmp_out}/t", "APPEND")
    save(df, f"{tmp_out}/t", "APPEND")
    assert spark.read.parquet(f"{tmp_out}/t").count() == 4
    save(df, f"{tmp_out}/t", "TRUNCATE")
    t = spark.read.parquet(f"{tmp_out}/t")
    assert t.count() == 2 and t.columns == RESULT_COLUMNS
    save(spark.createDataFrame([], RESULT_SCHEMA), f"{tmp_out}/empty", "APPEND")
    assert spark.read.parquet(f"{tmp_out}/empty").columns == RESULT_COLUMNS
    write_list_csv(df, f"{tmp_out}/csv", ["ID"])
    back = spark.read.option("sep", ";").option("header", "true").csv(f"{tmp_out}/csv")
    assert [r.ID for r in back.collect()] == ["1", "2"]
    write_json(df, f"{tmp_out}/json")
    assert read_json(spark, f"{tmp_out}/json").count() == 2


def test_upsert_path_versions(spark, tmp_out):
    q, erp = fx.build(spark)
    rec = reconcile(q, erp, [2026])
    v1 = upsert_path(spark, None, eligible(rec), f"{tmp_out}/res")
    v2 = upsert_path(spark, v1, eligible(rec), f"{tmp_out}/res")
    a = sorted(map(_key, spark.read.parquet(v1).collect()))
    b = sorted(map(_key, spark.read.parquet(v2).collect()))
    # item 3 has two invoices under one upsert key: they collapse to one row
    assert v1 != v2 and a == b and len(a) == 4


def test_queue_stream_available_now(spark, tmp_out):
    q, erp = fx.build(spark)
    rows = fx.GOLDEN["queues"][fx.FIXO]
    qdir = f"{tmp_out}/queue"
    spark.createDataFrame(rows[:2], QUANTITY_QUEUE_SCHEMA).write.parquet(f"{qdir}/part1")
    proc = get_process(fx.FIXO)
    src_dir = f"{qdir}/*"
    out_root = f"{tmp_out}/result"
    sq = start_queue_stream(spark, src_dir, proc, erp, [2026], out_root, checkpoint=f"{tmp_out}/ckpt")
    sq.awaitTermination(120)
    first = spark.read.parquet(version_path(out_root, 0))
    assert sorted(r.ID for r in first.collect()) == [1, 2]
    # a second file arrives: the next run merges it into a new version
    spark.createDataFrame(rows[2:], QUANTITY_QUEUE_SCHEMA).write.parquet(f"{qdir}/part2")
    sq = start_queue_stream(spark, src_dir, proc, erp, [2026], out_root, checkpoint=f"{tmp_out}/ckpt")
    sq.awaitTermination(120)
    last = spark.read.parquet(version_path(out_root, 1))
    expected = dedup_last(eligible(reconcile(q, erp, [2026]))).where(F.col("PROCESS_NAME") == fx.FIXO)
    assert sorted(map(_key, last.select(*RESULT_COLUMNS).collect())) == sorted(
        map(_key, expected.select(*RESULT_COLUMNS).collect()))


def test_audit_classes(spark):
    """status-15 items of the fixed-price queue, one per class."""
    queues = {fx.FIXO: [
        fx.qrow(1, "15", "4500451189", "123490"),  # tax id match with a booked invoice
        fx.qrow(2, "15", "4500725349", "1"),  # invoice linked by order number, no DOCNUM
        fx.qrow(3, "15", "4500756534", "999"),  # cockpit not in the ledger
        fx.qrow(4, "15", "4500000004", "5"),  # ledger row but no partner tax id
        fx.qrow(5, "15", "4500000005", "6"),  # partner without invoices in the year
        fx.qrow(6, "15", "4500756534", "123492|"),  # invoices of the partner, none matching
    ]}
    led = list(fx.GOLDEN["zmmt0022"]) + [fx.ledger("4500000004", "5", 1.0, 2.0), fx.ledger("4500000005", "6", 1.0, 2.0),
                                         fx.ledger("4500725349", "1", 1.0, 2.0)]
    ekko = list(fx.GOLDEN["ekko"]) + [("300", "1000", "4500000005", "K5", "P5")]
    bp = list(fx.GOLDEN["bp_fiscal"]) + [("P5", "PROD E", "555", "IE5", "E")]
    xml = [fx.invoice("X1", "12345678", 19205.05, d_emi="20260115", nfnum="000000001"),
           fx.invoice("X2", "98765432100", 1.00, d_emi="20260115", nfnum="000000002"),
           fx.invoice("X7", "77", 5.00, d_emi="20260115", nfnum="000000007")]
    items = [fx.item("X1", 7682.0), fx.item("X2", 5.0), fx.item("X7", 1.0, ponumber="4500725349")]
    active = [fx.active_for(xml[0], "3038001")]
    q, erp = fx.build(spark, queues=queues, zmmt0022=led, ekko=ekko, bp_fiscal=bp, xml_rec=xml, nfeit=items,
                      nfe_active=active)
    got = {r.qid: r for r in audit_booked(audit_items(q), erp, 2026).collect()}
    assert {i: got[i].classe for i in got} == {
        1: "ESCRITURADO", 2: "LIGADO_SEM_DOCNUM", 3: "SEM_ZMMT_COCKPIT", 4: "SEM_CPF", 5: "SEM_NF_DO_CPF",
        6: "NF_DIVERGE"}
    assert got[1].docnum == "3038001" and got[1].nf_casada == "000000001" and got[1].cpf == "00012345678"
    assert got[1].qexp == 7682.0 and got[1].vexp == 19205.0
    assert got[6].n_match_oficial == 0 and got[2].n_po_nfs == 1


def test_read_erp_and_queues_from_paths(spark, tmp_out):
    from tallyspark.schemas import ERP_SCHEMAS
    from tallyspark.sources.readers import read_erp, read_queues

    q, erp = fx.build(spark)
    locs = {}
    for name in ERP_SCHEMAS:
        getattr(erp, name).write.parquet(f"{tmp_out}/erp/{name}")
        locs[name] = f"{tmp_out}/erp/{name}"
    q[fx.FIXO].write.parquet(f"{tmp_out}/q/fixo")
    erp2 = read_erp(spark, locs)
    q2 = read_queues(spark, {fx.FIXO: f"{tmp_out}/q/fixo"})
    a = sorted(map(_key, reconcile(q, erp, [2026]).where(F.col("PROCESS_NAME") == fx.FIXO).collect()))
    # the one queue that was read is the one active process
    b = sorted(map(_key, reconcile(q2, erp2, [2026], with_active(DEFAULT_PROCESSES, [fx.FIXO])).collect()))
    assert a == b


def test_save_table_strategies(spark):
    from tallyspark.sinks.writers import save_table

    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID long, PROCESS_NAME string")
    name = "tallyspark_test_result"
    save_table(df, name, "DROP_CREATE")
    save_table(df, name, "APPEND")
    assert spark.table(name).count() == 4
    save_table(df, name, "TRUNCATE")
    assert spark.table(name).count() == 2 and spark.table(name).columns == RESULT_COLUMNS
    spark.sql(f"DROP TABLE {name}")


def test_stage_scope_removes_its_tables(spark):
    from tallyspark.session import checkpoint_dir, cut_lineage, stage_scope

    df = spark.range(10)
    with stage_scope(spark, "t") as scope:
        staged = cut_lineage(df, "x")
        assert staged.count() == 10
        folder = f"{checkpoint_dir(spark)}/tables/{scope}"
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert spark.conf.get("tallyspark.stage.scope", None) is None


def test_jdbc_options_split_the_read():
    from tallyspark.sources.readers import jdbc_options

    o = jdbc_options("jdbc:postgresql://db/x", "prod.fila", partition_column="id", lower=1, upper=1000,
                     num_partitions=16)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "16" and o["lowerBound"] == "1"
    assert "partitionColumn" not in jdbc_options("jdbc:postgresql://db/x", "prod.fila")


def test_cycle_cli(spark, small_dir, tmp_out, capsys):
    from tallyspark.plans.cycle import main

    main(["--sf-dir", small_dir, "--out", f"{tmp_out}/cli"])
    out = capsys.readouterr().out
    assert '"status": "SUCESSO"' in out and "CTRFIXO: SUCESSO" in out


def test_stream_covers_every_active_process(spark, small_dir, monkeypatch):
    """One stream per active process, each in its own folder (the rows are
    held against the SQL by the oracle test of ``stream_cycle_all``)."""
    from tallyspark.plans.catalog import QUERIES
    from tallyspark.sources.registry import active_processes

    seen = {}

    def landed(spark, rows, process, erp, years, root, files=2):
        seen[process.process_name] = root
        return spark.createDataFrame([], RESULT_SCHEMA)

    monkeypatch.setattr("tallyspark.streaming.queue_stream.run_available", landed)
    assert "DATA_EXECUCAO" not in QUERIES["stream_cycle_all"](spark, small_dir).columns
    assert list(seen) == [p.process_name for p in active_processes()] and len(set(seen.values())) == 5
