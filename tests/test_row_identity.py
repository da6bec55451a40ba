"""Queue rows whose id is missing or repeated, and rows that repeat,
keep one verdict each."""

from __future__ import annotations

import random
from collections import Counter

import erp_fixture as fx
from tallyspark.operators.audit import audit_booked, audit_items
from tallyspark.operators.queues import expand_queues, number_items
from tallyspark.operators.reconcile import reconcile
from tallyspark.sources.registry import DEFAULT_PROCESSES, with_active

ONLY = with_active(DEFAULT_PROCESSES, [fx.FIXO])


def golden(rows):
    return {fx.FIXO: rows}


def verdicts(spark, rows, **tables):
    q, erp = fx.build(spark, queues=golden(rows), **tables)
    return Counter((r.ID, r.DOC_COMPRA, r.NUMERO_COCKPIT, r.STATUS_EXECUCAO) for r in reconcile(q, erp, [2026], ONLY).collect())


def test_missing_and_shared_ids_have_their_own_verdict(spark):
    got = verdicts(spark, [
        fx.qrow(None, "12", "4500451189", "123490"),  # matches
        fx.qrow(None, "12", "9999999999", "1"),  # no ledger row
        fx.qrow(7, "12", "4500756534", "123492"),  # two invoices
        fx.qrow(7, "12", "4500725349", "122253"),  # nothing
    ])
    assert got == {(None, "4500451189", "123490", "SUCESSO"): 1, (None, "9999999999", "1", "SEM_RETORNO"): 1,
                   (7, "4500756534", "123492", "SUCESSO"): 2, (7, "4500725349", "122253", "SEM_RETORNO"): 1}


def test_rows_that_repeat_keep_a_verdict_each(spark):
    hit, miss = fx.qrow(1, "12", "4500451189", "123490|5"), fx.qrow(None, "12", "9999999999", "1")
    got = verdicts(spark, [hit, miss, hit, miss, miss])
    assert got == {(1, "4500451189", "123490", "SUCESSO"): 2, (1, "4500451189", "5", "SEM_RETORNO"): 2,
                   (None, "9999999999", "1", "SEM_RETORNO"): 3}


def test_an_error_item_with_a_missing_id_errs_alone(spark):
    bad, good = fx.vrow(None, "01", "4500451189", "123490"), fx.vrow(None, "01", "4500756534", "123492")
    led = [fx.ledger("4500451189", "123490", 1.0, 2.0, data="00000000"), *fx.GOLDEN["zmmt0022"][1:]]
    q, erp = fx.build(spark, queues={fx.VALOR: [bad, bad, good]}, zmmt0022=led)
    rec = reconcile(q, erp, [2026], with_active(DEFAULT_PROCESSES, [fx.VALOR])).collect()
    assert Counter((r.DOC_COMPRA, r.STATUS_EXECUCAO) for r in rec) == {("4500451189", "ERRO"): 2, ("4500756534", "SUCESSO"): 2}


def test_identity_does_not_depend_on_the_partitions(spark):
    rng = random.Random(3)
    rows = [fx.qrow(rng.choice([None, 1, 2]), "12", rng.choice(["", None, "45"]), rng.choice(["1|2", "3", "1|2|2"])) for _ in range(300)]
    rows += [fx.qrow(9, "13", "46", "1")] * 400  # one row holds more than half
    seen = []
    for parts in (1, 7):
        q, _ = fx.build(spark, queues=golden(rows))
        items = number_items(expand_queues({fx.FIXO: q[fx.FIXO].repartition(parts)}, ONLY)).collect()
        seen.append(Counter(tuple(str(v) for v in r) for r in items))
        ids = Counter((r.queue_row_id, r.numero_cockpit) for r in items)
        assert max(ids.values()) == 1
        # the cockpits of a row share its identity
        assert len({r.queue_row_id for r in items}) == len(rows)
    assert seen[0] == seen[1]


def test_null_and_empty_text_are_different_rows(spark):
    q, _ = fx.build(spark, queues=golden([fx.qrow(1, "12", None, "1"), fx.qrow(1, "12", "", "1")]))
    ids = {r.queue_row_id for r in number_items(expand_queues(q, ONLY)).collect()}
    assert len(ids) == 2 and all(i.endswith("-1") for i in ids)


def test_audit_items_without_an_id_are_judged(spark):
    rows = [fx.qrow(None, "15", "4500451189", "123490"), fx.qrow(None, "15", "4500451189", "123490"), fx.qrow(None, "15", "4500725349", "1")]
    q, erp = fx.build(spark, queues=golden(rows), nfe_active=[fx.active_for(fx.GOLDEN["xml_rec"][0], "3038001")])
    got = audit_booked(audit_items(q), erp, 2026).collect()
    assert Counter((r.doc_compra, r.classe, r.n_match_oficial) for r in got) == {
        ("4500451189", "ESCRITURADO", 1): 2, ("4500725349", "SEM_ZMMT_COCKPIT", 0): 1}
