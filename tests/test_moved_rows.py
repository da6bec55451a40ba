"""What the reconcile and the streams move and how often: items go through the
joins by number, invoices by tax id and quantity, blocks are made once a drain."""

from __future__ import annotations

from collections import Counter

import erp_fixture as fx
from tallyspark.operators import reconcile as rec
from tallyspark.operators.match import ITEM_KEY, open_invoices, with_items
from tallyspark.operators.queues import ITEM_NO, expand_queues, number_items
from tallyspark.operators.reconcile import contract_hits, prepared, reconcile
from tallyspark.schemas import QUEUE_COLUMNS, RESULT_COLUMNS, UPSERT_KEYS
from tallyspark.sources.registry import DEFAULT_PROCESSES, with_active
from tallyspark.streaming import cycle_stream
from tallyspark.streaming.queue_stream import run_available

ONLY = with_active(DEFAULT_PROCESSES, [fx.FIXO])


def content(df):
    return sorted(str(tuple(r)) for r in df.drop("DATA_EXECUCAO").collect())


def test_numbered_items_go_through_the_joins_without_their_queue_columns(spark):
    rows = [fx.qrow(1, "12", "4500451189", "123490|5")] * 3 + [fx.qrow(None, "12", "4500756534", "123492")]
    q, erp = fx.build(spark, queues={fx.FIXO: rows})
    items = number_items(expand_queues({fx.FIXO: q[fx.FIXO].repartition(3)}, ONLY), by_content=False)
    assert items.select(ITEM_NO).distinct().count() == items.count() == 7
    hits = contract_hits(items, erp)
    assert {c for c in hits.columns if c in QUEUE_COLUMNS} == {"id"} and not set(ITEM_KEY) & set(hits.columns)
    back = Counter((r.id, r.numero_cockpit) for r in with_items(hits, items).collect())
    assert back == {(1, "123490"): 3, (None, "123492"): 2}


def test_only_invoices_of_the_looked_for_quantities_are_read_on(spark):
    xml = fx.invoice("90", "12345678", 19205.0, nfnum="000000090")
    q, erp = fx.build(spark, queues={fx.FIXO: [fx.qrow(1, "12", "4500451189", "123490")]}, xml_rec=[xml],
                      nfeit=[fx.item("90", 7682.0), fx.item("90", 7683.0)])
    hits = contract_hits(number_items(expand_queues(q, ONLY), by_content=False), erp)
    assert open_invoices(erp, [2026]).count() == 2
    assert [float(r.VTIN_QTDE) for r in open_invoices(erp, [2026], hits).collect()] == [7682.0]


def test_prepared_tables_give_the_same_rows(spark):
    q, erp = fx.build(spark)
    ready = prepared(erp, [2026])
    assert prepared(ready, [2026]) is ready
    want = content(reconcile(q, erp, [2026]))
    assert content(reconcile(q, ready, [2026])) == want
    assert content(reconcile(q, ready, [2025, 2026])) == content(reconcile(q, erp, [2025, 2026]))


def test_a_drain_makes_the_blocks_once(spark, tmp_out, monkeypatch):
    q, erp = fx.build(spark)
    q[fx.FIXO] = q[fx.FIXO].where("id < 4")
    made, plain = [], rec.contract_blocks

    def counted(erp, contracts=None):
        made.append(contracts is None)
        return plain(erp, contracts)

    for module in ("reconcile", "match"):
        monkeypatch.setattr(f"tallyspark.operators.{module}.contract_blocks", counted)
    out = cycle_stream.run_cycle_stream(spark, q, erp, [2026], f"{tmp_out}/all", files=2, processes=ONLY)
    assert made == [True] and out.count() > 0
    process = next(p for p in DEFAULT_PROCESSES if p.process_name == fx.FIXO)
    alone = run_available(spark, q[fx.FIXO], process, erp, [2026], f"{tmp_out}/one", files=2)
    assert made == [True, True] and content(alone) == content(out)


def test_columns_that_nothing_reads_are_not_written(spark):
    """The rows are those of the whole result; the tables on the way hold what
    the routes and checks read, what is wanted, and NULLs."""
    q, erp = fx.build(spark)
    whole = reconcile(q, erp, [2026])
    assert whole.where("STATUS_EXECUCAO = 'SUCESSO'").count() > 0
    for wanted in (["PROCESS_NAME", "STATUS_EXECUCAO", "DOCNUM"], UPSERT_KEYS, ["ID", "RESULTADO", "NAME", "VTIN_SERIE", "CFOP", "ZMMT_TIPO", "MENSAGEM_ERRO"],
                   RESULT_COLUMNS):
        got = reconcile(q, erp, [2026], columns=wanted)
        assert got.columns == [c for c in RESULT_COLUMNS if c in wanted]
        assert content(got) == content(whole.select(got.columns))
    items = number_items(expand_queues(q), by_content=False)
    hits = contract_hits(items, erp, years=[2026], columns=["NAME"])
    assert hits.columns == contract_hits(items, erp, years=[2026]).columns
    held = {c for c in hits.columns if hits.where(hits[c].isNotNull()).count()}
    assert {"NAME", "CPF_CNPJ", "ZMMT_VALOR"} <= held and not {"LIFNR", "NAME1_TEXT", "ZMMT_MIRO_HORA", "BUKRS"} & held
    lines = open_invoices(erp, [2026], hits, columns=["VTIN_SERIE"])
    held = {c for c in lines.columns if lines.where(lines[c].isNotNull()).count()}
    assert {"VTIN_SERIE", "_tax_key", "VTIN_VLR_NF"} <= held and not {"VTIN_MODELO", "N_LOG", "CFOP"} & held
