"""Tiny hand-written ERP + queue tables for semantic tests.

``build(spark, **overrides)`` returns (queues, erp) where every table is a
small DataFrame; pass a list of row tuples to replace a table.
"""

from __future__ import annotations

from tallyspark.schemas import ERP_SCHEMAS, QUANTITY_QUEUE_SCHEMA, VALUE_QUEUE_SCHEMA
from tallyspark.sources.erp import ErpTables

SCHEMAS = ERP_SCHEMAS

FIXO = "V2_Consulta_Comp_CTRFIXO"
ARMAZEN = "V2_Consulta_Comp_ARMAZEN"
VALOR = "V2_Consulta_Comp_VALOR"
S_FIX = "V2_Consulta_Comp_CTR_S_FIXACAO"
C_FIX = "V2_Consulta_Comp_CTR_C_FIXACAO"


def D(x):
    from decimal import Decimal

    return None if x is None else Decimal(str(x))


def qrow(id_, status, doc, cockpit, n_contrato=None):
    """Quantity queue row (only the columns the tests care about)."""
    vals = {"id": id_, "status": status, "doc_compra": doc, "numero_cockpit": cockpit, "n_contrato": n_contrato,
            "centro": "0001"}
    return tuple(vals.get(f.name) for f in QUANTITY_QUEUE_SCHEMA.fields)


def vrow(id_, status, doc, cockpit):
    vals = {"id": id_, "ctr_status": status, "documento_compras": doc, "id_cockpit": cockpit}
    return tuple(vals.get(f.name) for f in VALUE_QUEUE_SCHEMA.fields)


def ledger(contrato, id_, qtde, valor, miro_doc="", miro_data="20260110", data="20260110"):
    return ("300", id_, contrato, data, D(qtde), D(valor), miro_data, "100000", miro_doc, "2026", "F")


def invoice(id_, stcd1, v_nf, d_emi="20260115", codesta="100", mansta="01", nfnum="000000001", cdv="1"):
    return (id_, mansta, codesta, "L1", d_emi, "080000", d_emi, stcd1, "55", "1000", "0001", nfnum, "1", cdv,
            "000000001", "A1", d_emi[:4], d_emi[4:6], D(v_nf))


def item(nfeid, qcom, ponumber=""):
    return (nfeid, "000010", "12019000", "1101", D(qcom), ponumber)


def active_for(inv_row, docnum, cancel="", direct="1"):
    (_id, _m, _c, _l, _dc, _t, d_emi, stcd1, model, _b, _br, nfnum, _s, cdv, docnum9, *_rest) = inv_row
    return (d_emi[:4], d_emi[4:6], stcd1, model, nfnum, docnum9, cdv, direct, cancel, "P1", "0001", d_emi, docnum)


GOLDEN = {
    "queues": {
        FIXO: [
            qrow(1, "12", "4500451189", "123490"),
            qrow(2, "12", "4500725349", "122253"),
            qrow(3, "13", "4500756534", "123492"),
            qrow(4, "12", "9999999999", "000000"),
        ],
    },
    "zmmt0022": [
        ledger("4500451189", "00123490", 7682.0, 19205.0),
        ledger("4500756534", "123492", 70000.0, 126000.0),
        ledger("4500756534", "123492", 73159.0, 131724.68),
    ],
    "ekko": [("300", "1000", "4500451189", "K1", "P1"), ("300", "1000", "4500756534", "K3", "P2")],
    "ekpo": [("300", "4500451189", "M1"), ("300", "4500756534", "M1")],
    "mara": [("M1", "01")],
    "bp_fiscal": [("P1", "PROD A", "00012345678", "IE1", "A"), ("P2", "PROD B", "98765432100", "IE2", "B")],
    "xml_rec": [
        invoice("X1", "12345678", 19205.00, nfnum="000000001"),
        invoice("X2", "98765432100", 126000.00, nfnum="000000002"),
        invoice("X3", "98765432100", 131724.68, nfnum="000000003"),
    ],
    "nfeit": [item("X1", 7682.0), item("X2", 70000.0), item("X3", 73159.0)],
}


def build(spark, **overrides):
    spec = {k: v for k, v in GOLDEN.items()}
    spec.update(overrides)
    queues = {}
    for p in (FIXO, S_FIX, C_FIX, ARMAZEN):
        queues[p] = spark.createDataFrame(spec["queues"].get(p, []), QUANTITY_QUEUE_SCHEMA)
    queues[VALOR] = spark.createDataFrame(spec["queues"].get(VALOR, []), VALUE_QUEUE_SCHEMA)
    tables = {name: spark.createDataFrame(spec.get(name, []), ddl) for name, ddl in SCHEMAS.items()}
    return queues, ErpTables(**tables)
