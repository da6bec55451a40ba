"""Ledger rows, invoices and result rows that nothing can meet are not moved."""

from __future__ import annotations

from decimal import Decimal

import erp_fixture as fx
from pyspark.sql import functions as F

from tallyspark.operators.match import ROUTES, contract_hits, open_invoices, wanted_keys
from tallyspark.operators import pruning
from tallyspark.operators.pruning import marked
from tallyspark.operators.queues import expand_queues, number_items
from tallyspark.operators.upsert import dedup_last, upsert
from tallyspark.schemas import ROUTE_DOCUMENT, ROUTE_TAX_ID
from tallyspark.sources.registry import DEFAULT_PROCESSES, KIND_VALUE, with_active

ONLY = with_active(DEFAULT_PROCESSES, [fx.FIXO, fx.VALOR])
KEYS = ["PROCESS_NAME", "STATUS_EXECUCAO"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_mark_keeps_every_row(spark):
    rows = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "a string")
    keys = spark.createDataFrame([("2",), (None,)], "k string")
    got = marked(rows, "_in", ["a"], keys, ["k"])
    assert sorted((str(r.a), r._in) for r in got.collect()) == [("1", False), ("2", True), ("2", True), ("None", False)]
    unlike = marked(spark.range(2), "_in", ["id"], keys, ["k"])  # keys of unlike types leave nothing out
    assert [r._in for r in unlike.collect()] == [True, True]


def test_only_ledger_rows_that_a_route_or_a_check_needs_become_hits(spark):
    queues = {fx.FIXO: [fx.qrow(1, "12", "4500451189", "1|2|3|4")], fx.VALOR: [fx.vrow(2, "01", "4500756534", "1|2")]}
    led = [fx.ledger("4500451189", "1", 10.0, 100.0), fx.ledger("4500451189", "2", 20.0, 200.0, miro_doc="51"),
           fx.ledger("4500451189", "3", 30.0, 300.0, miro_doc="52"), fx.ledger("4500451189", "4", None, 400.0),
           fx.ledger("4500756534", "1", 50.0, 500.0, miro_doc="53"), fx.ledger("4500756534", "2", None, 600.0, data="bad")]
    docs = [("", "51", "2026", "1", fx.D(20), fx.D(200), "U"), ("D7", "52", "2026", "1", fx.D(30), fx.D(300), "V")]
    q, erp = fx.build(spark, queues=queues, zmmt0022=led, nfdoc=docs)
    items = number_items(expand_queues(q, ONLY), by_content=False)

    def values(**kw):
        return sorted(float(r.ZMMT_VALOR) for r in contract_hits(items, erp, **kw).collect())

    assert values() == [100, 200, 300, 400, 500, 600]
    assert values(years=[2026], routes=ROUTES) == [100, 200, 500, 600]  # 300 has its number, 400 no quantity
    assert values(years=[2026], routes=[ROUTE_DOCUMENT]) == [200]
    assert values(years=[2026], routes=[ROUTE_TAX_ID]) == [100]
    assert values(years=[2026], routes=[KIND_VALUE]) == [500, 600]


def test_the_tax_route_wants_invoices_of_its_values_only(spark):
    xml = [fx.invoice(str(n), "12345678", v, nfnum=f"00000009{n}") for n, v in enumerate([19205.0, 19205.4, 7.0])]
    q, erp = fx.build(spark, queues={fx.FIXO: [fx.qrow(1, "12", "4500451189", "123490")]}, xml_rec=xml,
                      nfeit=[fx.item(str(n), 7682.0) for n in range(3)])
    hits = contract_hits(number_items(expand_queues(q, ONLY), by_content=False), erp)
    assert wanted_keys(hits).quantities.count() == 0 and wanted_keys(hits).values.count() == 1
    # the exact value and the one that rounds to it
    assert sorted(r.VTIN_XML for r in open_invoices(erp, [2026], hits).collect()) == ["0", "1"]


def test_the_dedup_moves_repeated_keys_only(spark):
    rows = spark.range(300).select((F.col("id") % 299).cast("string").alias("PROCESS_NAME"), F.lit("S").alias("STATUS_EXECUCAO"), F.col("id").alias("ID"))
    rows = rows.unionByName(spark.createDataFrame([(None, "S", 1), (None, "S", 1)], rows.schema))
    done = dedup_last(rows, KEYS)
    assert "partial_bit_or" in plan_of(done)
    assert sorted(r.ID for r in done.collect()) == sorted([*range(1, 300), 1, 1])


def test_the_upsert_moves_rows_that_may_meet_only(spark):
    schema = "PROCESS_NAME string, STATUS_EXECUCAO string, a string, b string"
    target = spark.createDataFrame([("p", "S", "old", "t"), ("q", "S", "old", "t"), (None, "S", "old", "t")], schema)
    batch = spark.createDataFrame([("p", "S", "x", Decimal(1)), ("p", "S", "y", Decimal(2)), ("r", "S", "z", None), (None, "S", "n", None)],
                                  "PROCESS_NAME string, STATUS_EXECUCAO string, a string, c decimal(18,6)")
    out = upsert(target, batch, KEYS)
    assert plan_of(out).count("partial_bit_or") >= 2
    assert out.columns == ["PROCESS_NAME", "STATUS_EXECUCAO", "a", "b", "c"]
    got = sorted((str(r.PROCESS_NAME), r.a, r.b, r.c) for r in out.collect())
    assert got == [("None", "n", None, None), ("None", "old", "t", None), ("p", "y", "t", Decimal(2)),
                   ("q", "old", "t", None), ("r", "z", None, None)]


def test_the_upsert_deals_a_row_by_its_key_once(spark, monkeypatch):
    """A target row that the batch replaces is moved with its key and its own
    columns only, one that merely may meet the batch stays whole."""
    monkeypatch.setattr(pruning, "BITS", 64)  # nearly every key meets another's bit
    schema = "PROCESS_NAME string, STATUS_EXECUCAO string, a string, own string"
    target = [(f"k{i % 150}", "S", f"t{i}", f"o{i}") for i in range(200)] + [(None, "S", "null", "o"), ("k1", None, "null", "o")]
    batch = [(f"k{i % 130}", "S", f"b{i:03d}") for i in range(100, 300)] + [(None, "S", "new"), (None, "S", "new")]
    out = upsert(spark.createDataFrame(target, schema), spark.createDataFrame(batch, "PROCESS_NAME string, STATUS_EXECUCAO string, a string"), KEYS)
    last = {}
    for p, s, a in batch:
        if p is not None:
            last[p] = max(a, last.get(p, ""))
    want = [(p, s, last.get(p, a) if s else a, own) for p, s, a, own in target]
    want += [(p, "S", a, None) for p, a in last.items() if p not in {r[0] for r in target}] + [(None, "S", "new", None)] * 2
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.collect())
    plan = plan_of(out)
    assert "FullOuter" not in plan and "LeftOuter" in plan
