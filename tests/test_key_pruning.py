"""Rows that no key of the other side can meet stay out of the shuffles."""

from __future__ import annotations

import erp_fixture as fx
from pyspark.sql import functions as F
from tallyspark.operators.blocks import invoice_block
from tallyspark.operators.match import match_via_document, open_invoices
from tallyspark.operators.pruning import BITS, cannot_meet, key_bits, may_meet
from tallyspark.operators.queues import expand_queues, number_items
from tallyspark.operators.reconcile import contract_hits, reconcile
from tallyspark.operators.skew import CellBudget, even_join
from tallyspark.sources.registry import DEFAULT_PROCESSES, with_active

ONLY = with_active(DEFAULT_PROCESSES, [fx.FIXO])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_row_that_meets_a_key_is_kept(spark):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).cast("decimal(18,6)").alias("q"))
    rows = rows.unionByName(spark.createDataFrame([(None, None), ("3", None)], "a string, q decimal(18,6)"))
    keys = rows.where("a % 10 = 3").union(spark.createDataFrame([(None, None)], "a string, q decimal(18,6)")).withColumnsRenamed({"a": "k", "q": "kq"})
    kept = may_meet(rows, ["a", "q"], keys, ["k", "kq"])
    assert kept.columns == rows.columns
    got = {(r.a, r.q) for r in kept.collect()}
    want = {(r.a, r.q) for r in rows.where("a % 10 = 3").dropna().collect()}
    assert want <= got and len(got) < len(want) + 50
    assert may_meet(rows, ["a"], keys.where("false"), ["k"]).count() == 0
    left_out = cannot_meet(rows, ["a", "q"], keys, ["k", "kq"])
    assert sorted(map(str, left_out.unionByName(kept).collect())) == sorted(map(str, rows.collect()))
    # the map is bounded: one word a 64 bits, however many keys
    assert key_bits(spark.range(1000).crossJoin(spark.range(3).toDF("x")), ["id"]).count() <= min(1000, BITS // 64)


def test_keys_of_unlike_types_leave_nothing_out(spark):
    keys = spark.range(2).select(F.col("id").cast("string").alias("k"))
    assert may_meet(spark.range(5), ["id"], keys, ["k"]).count() == 5
    assert cannot_meet(spark.range(5), ["id"], keys, ["k"]).count() == 0


def test_even_join_prunes_both_sides(spark):
    left = spark.range(100).select(F.col("id").alias("a"), F.col("id").alias("l"))
    right = spark.range(95, 300).select(F.col("id").alias("b"), F.col("id").alias("r"))
    for budget in (CellBudget(), CellBudget(rows=1, pairs=1)):
        j = even_join(left, right, ["a"], ["b"], ["l"], ["r"], budget)
        assert sorted((r.l, r.r) for r in j.collect()) == [(n, n) for n in range(95, 100)]
        assert plan_of(j).count("bit_or") >= 2


def test_ledger_contracts_lines_and_hits_are_cut_before_they_move(spark):
    q, erp = fx.build(spark, queues={fx.FIXO: [fx.qrow(1, "12", "4500451189", "123490")]})
    items = number_items(expand_queues(q, ONLY), by_content=False)
    # ledger, purchase header and item, sales header and item
    assert plan_of(contract_hits(items, erp, materialize=False)).count("partial_bit_or") >= 5
    hits = contract_hits(items, erp)
    assert "partial_bit_or" in plan_of(open_invoices(erp, [2026], hits))
    assert "partial_bit_or" in plan_of(match_via_document(hits, erp, [2026], False))
    # with blank numbers the invoices too (without that: 2)
    assert plan_of(match_via_document(hits, erp, [2026], True)).count("partial_bit_or") == 3  # documents in both branches, invoices in one


def test_open_invoices_need_only_the_mark_of_a_numbered_nfe(spark):
    xml = [fx.invoice(str(n), "12345678", 19205.0, nfnum=f"00000009{n}") for n in range(4)]
    lines = [fx.item(str(n), 7682.0) for n in range(4)]
    q, erp = fx.build(spark, xml_rec=xml, nfeit=lines)
    keys = ["NFYEAR", "NFMONTH", "STCD1", "MODEL", "NFNUM9", "DOCNUM9", "CDV"]
    numbers = F.element_at(F.array(F.lit("77"), F.lit(""), F.lit(None).cast("string")), F.col("ID").cast("int") + 1)
    erp.nfe_active = erp.xml_rec.where("ID < '3'").select(
        *keys, F.lit("1").alias("DIRECT"), F.lit("").alias("CANCEL"), F.col("LIFNR").alias("PARID"), F.lit("B").alias("BRANCH"),
        F.lit("20260101").alias("CREDAT"), numbers.alias("DOCNUM"),
    )
    whole = invoice_block(erp).where("DOCNUM IS NULL OR DOCNUM = ''")
    cut = invoice_block(erp, open_only=True)
    rows = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert rows(cut) == rows(whole)
    assert {(r.VTIN_XML, r.LOCAL, r.DOCNUM) for r in cut.collect()} == {("1", "B", ""), ("2", "B", None), ("3", None, None)}


def test_items_without_a_match_are_not_moved(spark):
    rows = [fx.qrow(n, "12", "4500451189" if n == 1 else f"77{n}", "123490") for n in range(1, 40)]
    q, erp = fx.build(spark, queues={fx.FIXO: rows})
    done = reconcile(q, erp, [2026], ONLY)
    assert sorted((r.ID, r.STATUS_EXECUCAO) for r in done.collect()) == [(n, "SUCESSO" if n == 1 else "SEM_RETORNO") for n in range(1, 40)]
    assert "LeftAnti" in plan_of(done) and "partial_bit_or" in plan_of(done)
