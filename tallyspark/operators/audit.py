"""Audit of queue items that claim to be done.

For every exploded queue item in status '15' of the fixed-price and unfixed
purchase queues, decide whether the matching invoice already carries a
fiscal document number, and if not, why.  Classes by priority:

ESCRITURADO -> LIGADO_SEM_DOCNUM -> SEM_ZMMT_COCKPIT -> SEM_CPF ->
SEM_NF_DO_CPF -> NF_DIVERGE.

Everything is joins and partial aggregates: per-order facts (tax ids, the
invoices linked by order number) are aggregated per order before they meet
the items; the tax-id match is two equi-joins (rounded value; 0.1-wide value
bucket with the exact tolerance check) against the distinct values of a tax id
and quantity, so no tax id ever pairs all its invoices with all its items.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.keys import (
    ltrim0_or_empty,
    nonblank_docnum,
    split_cockpits_keep_empty,
    strip_ws,
    zfill10,
)
from tallyspark.functions.rounding import py_round
from tallyspark.operators.blocks import ACTIVE_KEYS_7, active_nfe
from tallyspark.session import cut_lineage
from tallyspark.sources.erp import ErpTables

# --- fixed values: audited queues, status, classes and their texts -----------
AUDIT_PROCS = {"FIXO": "V2_Consulta_Comp_CTRFIXO", "SEM_FIXACAO": "V2_Consulta_Comp_CTR_S_FIXACAO"}
AUDIT_STATUS = "15"
CLASSES = ["ESCRITURADO", "LIGADO_SEM_DOCNUM", "NF_DIVERGE", "SEM_NF_DO_CPF", "SEM_CPF", "SEM_ZMMT_COCKPIT"]
SITUATION_TEXT = {
    "ESCRITURADO": "ESCRITURADO",
    "LIGADO_SEM_DOCNUM": "NAO ESCRITURADO - NF do pedido sem DOCNUM",
    "NF_DIVERGE": "NAO ESCRITURADO - NF do CPF nao casa qtde/valor",
    "SEM_NF_DO_CPF": "NAO ESCRITURADO - sem NF do CPF no VTIN",
    "SEM_CPF": "NAO ESCRITURADO - sem CPF do fornecedor",
    "SEM_ZMMT_COCKPIT": "NAO ESCRITURADO - cockpit sem ZMMT",
}
VALUE_TOLERANCE = 0.10

# What an item's facts depend on.  Ids may be missing or repeated, so an item is
# looked up by its content, and items that agree in it are looked up once.
ITEM = ["dc", "cockpit"]


def audit_items(queues: Mapping[str, DataFrame], procs: Mapping[str, str] = AUDIT_PROCS) -> DataFrame:
    """Items: one per cockpit of each status-15 queue row (not distinct;
    a row without cockpits gives one item with an empty cockpit)."""
    parts = []
    for label, pname in procs.items():
        raw = queues[pname].where(F.col("status") == AUDIT_STATUS)
        doc = strip_ws(F.coalesce(F.col("doc_compra").cast("string"), F.lit("")))
        parts.append(
            raw.select(
                F.lit(label).alias("proc"),
                F.col("id").alias("qid"),
                doc.alias("doc_compra"),
                F.posexplode(split_cockpits_keep_empty("numero_cockpit")).alias("pos", "cockpit"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("dc", ltrim0_or_empty("doc_compra"))


def _order_numbers(items: DataFrame) -> DataFrame:
    """Order numbers as fetched: raw and zero-filled to 10 (one column k)."""
    known = items.where(F.col("doc_compra") != "")  # an item without an order has no key and links to nothing
    return known.select(F.col("doc_compra").alias("k")).unionByName(
        known.select(zfill10(F.col("doc_compra")).alias("k"))
    ).distinct()


def _invoices_with_active(erp: ErpTables, headers: DataFrame, lines: DataFrame) -> DataFrame:
    """The given invoice headers x items, active NF-e LEFT joined on 7 keys."""
    vxr = headers.alias("vxr")
    it = lines.select("NFEID", "QCOM", "PONUMBER").alias("it")
    act = active_nfe(erp).select(*ACTIVE_KEYS_7, F.col("DOCNUM").alias("ACT_DOCNUM")).alias("act")
    j = vxr.join(it, F.col("it.NFEID") == F.col("vxr.ID"), "inner").join(
        act, [F.col(f"act.{k}") == F.col(f"vxr.{k}") for k in ACTIVE_KEYS_7], "left"
    )
    return j.select(
        F.col("it.PONUMBER").alias("PONUMBER"),
        F.col("vxr.STCD1").alias("STCD1"),
        F.col("vxr.DATECR").alias("DATECR"),
        F.col("it.QCOM").cast("double").alias("qcom"),
        F.col("vxr.V_NF").cast("double").alias("v_nf"),
        F.coalesce(F.col("vxr.NFNUM9"), F.lit("")).alias("nf"),
        strip_ws(F.col("act.ACT_DOCNUM")).alias("docnum"),
    )


def _best(priority: int) -> Column:
    """Struct ordering candidates for 'first filled DOCNUM'."""
    return F.when(
        nonblank_docnum("docnum"),
        F.struct(F.lit(priority).alias("p"), F.col("docnum").alias("d"), F.col("nf").alias("nf")),
    )


def audit_booked(items: DataFrame, erp: ErpTables, year: int, materialize: bool = True) -> DataFrame:
    """C11: per item, expected quantity/value, tax ids, linked and matching
    invoices, and the class.

    The items feed the key lists and five joins, the expected amounts two and
    the tax ids' invoices three, so by default each is written once to the
    shared checkpoint folder and read back: an invoice table is read twice,
    for the order numbers and for the tax ids."""
    if materialize:
        items = cut_lineage(items, "audit-items")
    keys = _order_numbers(items)
    wanted = items.select(*ITEM).distinct()

    # expected amounts: first ledger row of (contract, cockpit); empty cockpit never matches
    zmm = erp.zmmt0022.join(keys.withColumnRenamed("k", "CONTRATO"), "CONTRATO", "left_semi").select(
        ltrim0_or_empty("CONTRATO").alias("dc"),
        ltrim0_or_empty("ID").alias("idk"),
        F.col("ID").cast("string").alias("zid"),
        F.col("QTDE").cast("double").alias("q"),
        F.col("VALOR").cast("double").alias("v"),
    )
    with_ck = wanted.where(F.col("cockpit") != "").withColumn("idk", ltrim0_or_empty("cockpit"))
    zrow = with_ck.join(zmm, ["dc", "idk"], "inner").groupBy(*ITEM).agg(
        F.min(F.struct("zid", "q", "v")).alias("z")
    )

    # partner tax ids and name per order
    ko = erp.ekko.join(keys.withColumnRenamed("k", "EBELN"), "EBELN", "left_semi")
    bp = ko.join(erp.bp_fiscal, ko["LIFNR"] == erp.bp_fiscal["PARTNER"]).select(
        "EBELN", "CPF_CNPJ", "NAME"
    ).distinct().where(F.col("CPF_CNPJ").isNotNull() & (F.col("CPF_CNPJ") != ""))
    cpf_rows = bp.select(
        ltrim0_or_empty("EBELN").alias("dc"),
        strip_ws(F.col("CPF_CNPJ")).alias("cpf"),
        F.coalesce(F.col("NAME").cast("string"), F.lit("")).alias("NAME"),
    )
    cpf_by_dc = cpf_rows.groupBy("dc").agg(
        F.sort_array(F.collect_set("cpf")).alias("cpfs"), F.max("NAME").alias("nome")
    )
    dc_cpf = cpf_rows.select("dc", "cpf").distinct().withColumn("tk", ltrim0_or_empty("cpf"))

    # invoices linked to the order number; most items have none, and a blank
    # number is no key, so those rows go before the shuffle
    ordered = erp.nfeit.where(F.col("PONUMBER") != "").join(
        keys.withColumnRenamed("k", "PONUMBER"), "PONUMBER", "left_semi"
    )
    po = _invoices_with_active(erp, erp.xml_rec, ordered).withColumn("dc", ltrim0_or_empty("PONUMBER"))
    po_by_dc = po.groupBy("dc").agg(
        F.count(F.lit(1)).alias("n_po_nfs"),
        F.coalesce(F.bool_or(nonblank_docnum("docnum")), F.lit(False)).alias("escrit_po"),
        F.min(_best(0)).alias("best_po"),
    )

    # invoices of the partner tax ids, created in the year
    tks = dc_cpf.where(F.col("tk") != "").select("tk").distinct()
    created = erp.xml_rec.where(F.col("DATECR").startswith(str(int(year))))
    headers = created.withColumn("tk", ltrim0_or_empty("STCD1")).join(tks, "tk", "left_semi").drop("tk")
    by_cpf = _invoices_with_active(erp, headers, erp.nfeit).withColumn("tk", ltrim0_or_empty("STCD1"))
    if materialize:
        zrow, by_cpf = cut_lineage(zrow, "audit-ledger"), cut_lineage(by_cpf, "audit-candidates")
    n_by_tk = by_cpf.groupBy("tk").agg(F.count(F.lit(1)).alias("n"))
    n_cand = dc_cpf.join(n_by_tk, "tk", "inner").groupBy("dc").agg(F.sum("n").alias("n_cand"))

    # tax-id match: quantity to 3 places and value within 0.10 or equal rounded.
    # Invoices that agree in tax id, quantity and value are one candidate, so a
    # hot tax id gives an item as many pairs as it has values in reach, not invoices.
    exp = zrow.join(dc_cpf, "dc", "inner").select(
        *ITEM, "tk", F.col("z.q").alias("qexp"), F.col("z.v").alias("vexp")
    ).where(F.col("qexp").isNotNull() & F.col("vexp").isNotNull())
    cand = by_cpf.where(F.col("qcom").isNotNull() & F.col("v_nf").isNotNull())
    cand = cand.groupBy("tk", py_round("qcom", 3).alias("q3"), "v_nf").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bool_or(nonblank_docnum("docnum")), F.lit(False)).alias("filled"),
        F.min(_best(1)).alias("best"),
    ).select("*", py_round("v_nf", 0).alias("r0"), F.floor(F.col("v_nf") * 10).alias("bucket"))
    e = exp.select(*ITEM, "tk", py_round("qexp", 3).alias("q3"), "vexp")
    by_round = e.withColumn("r0", py_round("vexp", 0)).join(cand, ["tk", "q3", "r0"], "inner")
    near = e.select(
        "*", F.explode(F.sequence(F.floor(F.col("vexp") * 10) - 2, F.floor(F.col("vexp") * 10) + 2)).alias("bucket")
    ).join(cand, ["tk", "q3", "bucket"], "inner").where(
        (F.abs(F.col("v_nf") - F.col("vexp")) <= VALUE_TOLERANCE) & (F.col("r0") != py_round("vexp", 0))
    )
    found = [*ITEM, "n", "filled", "best"]
    matches = by_round.select(*found).unionByName(near.select(*found))
    m_by_item = matches.groupBy(*ITEM).agg(
        F.sum("n").alias("n_match_oficial"),
        F.bool_or("filled").alias("escrit_oficial"),
        F.min("best").alias("best_m"),
    )

    d = (
        items.join(zrow, ITEM, "left")
        .join(cpf_by_dc, "dc", "left")
        .join(po_by_dc, "dc", "left")
        .join(n_cand, "dc", "left")
        .join(m_by_item, ITEM, "left")
    )
    n_po = F.coalesce(F.col("n_po_nfs"), F.lit(0))
    escrit_po = F.coalesce(F.col("escrit_po"), F.lit(False))
    escrit_of = F.coalesce(F.col("escrit_oficial"), F.lit(False))
    n_cpfs = F.coalesce(F.size("cpfs"), F.lit(0))
    classe = (
        F.when(escrit_po | escrit_of, "ESCRITURADO")
        .when(n_po > 0, "LIGADO_SEM_DOCNUM")
        .when(F.col("z").isNull(), "SEM_ZMMT_COCKPIT")
        .when(n_cpfs <= 0, "SEM_CPF")
        .when(F.coalesce(F.col("n_cand"), F.lit(0)) == 0, "SEM_NF_DO_CPF")
        .otherwise("NF_DIVERGE")
    )
    best = F.least(F.col("best_po"), F.col("best_m"))
    return d.select(
        "proc",
        "qid",
        "pos",
        "doc_compra",
        "cockpit",
        F.col("z.q").alias("qexp"),
        F.col("z.v").alias("vexp"),
        F.array_join(F.coalesce(F.col("cpfs"), F.array().cast("array<string>")), ", ").alias("cpf"),
        F.coalesce(F.col("nome"), F.lit("")).alias("nome"),
        F.coalesce(best.getField("d"), F.lit("")).alias("docnum"),
        F.coalesce(best.getField("nf"), F.lit("")).alias("nf_casada"),
        n_po.cast("long").alias("n_po_nfs"),
        escrit_po.alias("escrit_po"),
        F.coalesce(F.col("n_match_oficial"), F.lit(0)).cast("long").alias("n_match_oficial"),
        escrit_of.alias("escrit_oficial"),
        classe.alias("classe"),
    )


def situation(c: Column) -> Column:
    """SF19: class -> situation text (unknown class -> itself)."""
    out = c
    for k, v in reversed(list(SITUATION_TEXT.items())):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def audit_list(detail: DataFrame) -> DataFrame:
    """The list for the business (ordering applied at the sink)."""
    return detail.select(
        F.col("proc").alias("PROCESSO"),
        F.col("doc_compra").alias("PEDIDO"),
        F.col("cockpit").alias("COCKPIT"),
        F.col("cpf").alias("CPF"),
        F.col("nome").alias("FORNECEDOR"),
        F.col("qexp").alias("QTDE"),
        F.col("vexp").alias("VALOR"),
        F.split(F.col("docnum"), r"\.").getItem(0).alias("DOCNUM"),
        F.when(F.col("classe") == "ESCRITURADO", "SIM").otherwise("NAO").alias("ESCRITURADO"),
        situation(F.col("classe")).alias("SITUACAO"),
    )


LIST_ORDER = ["ESCRITURADO", "PROCESSO", "PEDIDO", "COCKPIT"]


def audit_distribution(detail: DataFrame, procs: Sequence[str] = tuple(AUDIT_PROCS)) -> DataFrame:
    """G-A5 + G-A6: items, distinct orders, booked share and class counts per
    process plus a TOTAL row, in one ``rollup`` over the detail."""
    aggs = [
        F.count(F.lit(1)).alias("itens"),
        F.countDistinct("doc_compra").alias("doc_compras"),
    ] + [F.count_if(F.col("classe") == c).alias(c.lower()) for c in CLASSES]
    out = detail.rollup("proc").agg(*aggs, F.grouping("proc").alias("_total"))
    out = out.withColumn("proc", F.when(F.col("_total") == 1, F.lit("TOTAL")).otherwise(F.col("proc"))).drop("_total")
    counts = ["itens", "doc_compras", *[c.lower() for c in CLASSES]]
    # every process and the total have a row, also without items
    labels = detail.sparkSession.createDataFrame([(p,) for p in [*procs, "TOTAL"]], "proc string")
    out = labels.join(out, "proc", "left").fillna(0, counts)
    pct = F.coalesce(F.bround(F.try_divide(F.col("escriturado") * 100.0, F.col("itens")), 0), F.lit(0.0)).cast("long")
    return out.select(
        "proc", *counts,
        F.format_string("%d%%", pct).alias("pct_escriturado"),
    )


def audit_flags(listing: DataFrame) -> DataFrame:
    """G-A13: SIM / NAO totals of the list."""
    return listing.agg(
        F.count_if(F.col("ESCRITURADO") == "SIM").alias("sim"),
        F.count_if(F.col("ESCRITURADO") == "NAO").alias("nao"),
        F.count(F.lit(1)).alias("linhas"),
    )
