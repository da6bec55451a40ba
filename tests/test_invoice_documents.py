"""Documents of the whole invoice block: what they meet, and what they move."""

from __future__ import annotations

import erp_fixture as fx
from tallyspark.operators.blocks import invoice_block


def rows(spark, numbers, docs):
    xml = [fx.invoice(f"X{n}", "12345678", 19205.0, nfnum=f"00000009{n}") for n in range(4)]
    lines = [fx.item(f"X{n}", 10.0 + n) for n in range(4)] + [fx.item("X1", 99.0)]
    active = [fx.active_for(xml[n], number) for n, number in numbers]
    _, erp = fx.build(spark, xml_rec=xml, nfeit=lines, nfe_active=active, nfdoc=docs)
    block = invoice_block(erp)
    plan = block._jdf.queryExecution().executedPlan().toString()
    got = block.selectExpr("VTIN_XML", "cast(VTIN_QTDE as int) q", "LOCAL", "DOCNUM", "CRENAM", "cast(PESO_LIQUIDO as int) w")
    return sorted(map(tuple, got.collect()), key=str), plan


def doc(number, who, weight):
    return (number, f"B{who}", "2026", "1", fx.D(weight), fx.D(10), who)


DOCS = [doc("D1", "U", 1), doc("D1", "V", 2), doc("D2", "W", 3), doc("", "X", 4), doc(None, "Y", 5), doc("D9", "Z", 6)]


def test_lines_meet_the_documents_of_their_nfe_and_are_not_moved_for_them(spark):
    # X0 has two NF-e, X1 two documents and two lines, X2 no number, X3 no NF-e
    got, plan = rows(spark, [(0, "D2"), (0, "D7"), (1, "D1"), (2, None)], DOCS)
    assert got == sorted([
        ("X0", 10, "0001", "D2", "W", 3), ("X0", 10, "0001", "D7", None, None),
        *[("X1", q, "0001", "D1", who, w) for q in (11, 99) for who, w in (("U", 1), ("V", 2))],
        ("X2", 12, "0001", None, None, None), ("X3", 13, None, None, None, None),
    ], key=str)
    assert "explode" not in plan  # nothing is dealt by a line's document number


def test_blank_numbers_still_meet_blank_documents(spark):
    got, plan = rows(spark, [(0, ""), (1, "D1"), (2, None)], DOCS)
    assert got == sorted([
        ("X0", 10, "0001", "", "X", 4), *[("X1", q, "0001", "D1", who, w) for q in (11, 99) for who, w in (("U", 1), ("V", 2))],
        ("X2", 12, "0001", None, None, None), ("X3", 13, None, None, None, None),
    ], key=str)
    assert "explode" in plan
