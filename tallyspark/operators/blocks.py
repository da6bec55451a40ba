"""Reusable ERP blocks: contract/partner blocks (J3, J4) and the received
invoice block (J8-J11, F2, F3).

Each block is built once for all work items instead of once per queue row.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.keys import amount, ltrim0, round_amount, ymd_year_in
from tallyspark.operators.pruning import blanked, marked, may_meet
from tallyspark.schemas import AMOUNT
from tallyspark.session import cut_lineage
from tallyspark.sources.layout import EMISSION_YEAR
from tallyspark.sources.erp import ErpTables

def purchase_contract_block(erp: ErpTables, contracts: DataFrame | None = None) -> DataFrame:
    """Purchase header x partner tax ids, for headers having at least one
    item of grain material (SPART '01'); DISTINCT without item columns.

    ``contracts`` (one column ``EBELN``) leaves most other contracts out
    before anything moves; the join with the hits decides.
    """
    grain = erp.mara.where(F.col("SPART") == "01").select("MATNR")
    items = erp.ekpo.select("MANDT", "EBELN", "MATNR")
    head = erp.ekko
    if contracts is not None:
        items = may_meet(items, ["EBELN"], contracts, ["EBELN"])
        head = may_meet(head, ["EBELN"], contracts, ["EBELN"])
    grain_items = items.join(grain, "MATNR", "left_semi").select("MANDT", "EBELN")
    head = head.join(grain_items, ["EBELN", "MANDT"], "left_semi")
    block = head.join(erp.bp_fiscal, head["LIFNR"] == erp.bp_fiscal["PARTNER"], "inner").select(
        head["MANDT"].alias("CTR_MANDT"),
        head["BUKRS"],
        head["EBELN"],
        head["KONNR"],
        head["LIFNR"],
        F.col("NAME"),
        F.col("CPF_CNPJ"),
        F.col("IE"),
        F.col("NAME1_TEXT"),
    )
    return block.distinct()


def storage_contract_block(erp: ErpTables, contracts: DataFrame | None = None) -> DataFrame:
    """Sales header x items (same client), customer LEFT joined; the
    tax id falls back from STCD1 to STCD2 when STCD1 is blank.  Keeps the
    item columns, so a contract fans out per item.  ``contracts`` as for the
    purchase block."""
    head = erp.vbak
    items = erp.vbap
    if contracts is not None:
        head = may_meet(head, ["VBELN"], contracts, ["EBELN"])
        items = may_meet(items, ["VBELN"], contracts, ["EBELN"])
    hi = head.join(items, ["MANDT", "VBELN"], "inner")
    cust = erp.kna1.select(
        "MANDT", "KUNNR", F.col("NAME1"), F.col("STCD1"), F.col("STCD2")
    )
    full = hi.join(cust, ["MANDT", "KUNNR"], "left")
    block = full.select(
        F.col("MANDT").alias("CTR_MANDT"),
        F.col("VKORG").alias("BUKRS"),
        F.col("VBELN").alias("EBELN"),
        F.col("VBELN").alias("KONNR"),
        F.col("KUNNR").alias("LIFNR"),
        F.col("NAME1").alias("NAME"),
        F.coalesce(F.nullif(F.col("STCD1"), F.lit("")), F.col("STCD2")).alias("CPF_CNPJ"),
        F.col("STCD2").alias("IE"),
        F.col("NAME1").alias("NAME1_TEXT"),
        F.col("AUART").alias("TIPO_DOCUMENTO"),
        F.col("VTWEG").alias("CANAL_DISTRIBUICAO"),
        F.col("SPART").alias("DIVISAO"),
        F.col("POSNR").alias("ITEM_CONTRATO"),
        F.col("MATNR").alias("CTR_MATERIAL"),
        F.col("ARKTX").alias("CTR_DESCRICAO_ITEM"),
        amount("KWMENG").alias("CTR_QTD_PREVISTA"),
        F.col("VRKME").alias("CTR_UM"),
    )
    return block.distinct()


ACTIVE_KEYS_7 = ["NFYEAR", "NFMONTH", "STCD1", "MODEL", "NFNUM9", "DOCNUM9", "CDV"]
ACTIVE_KEYS_5 = ["NFYEAR", "NFMONTH", "NFNUM9", "STCD1", "CDV"]


def active_nfe(erp: ErpTables) -> DataFrame:
    """only outgoing-direction, not cancelled NF-e rows take part in joins."""
    return erp.nfe_active.where((F.col("DIRECT") == "1") & (F.col("CANCEL") == ""))


VTIN_SOURCES = {  # invoice header columns by their name in the result
    "VTIN_STATUS": "MANSTA", "VTIN_COD_STATUS_SEFAZ": "CODESTA", "VTIN_XML": "ID", "VTIN_COD_PARCEIRO": "LIFNR",
    "VTIN_DT_CRIACAO": "DATECR", "VTIN_HR_CRIACAO": "TIMECR", "VTIN_DT_EMISSAO": "D_EMI", "VTIN_CPF_CNPJ": "STCD1",
    "VTIN_MODELO": "MODEL", "VTIN_EMPRESA": "BUKRS", "VTIN_CENTRO": "BRANCH", "VTIN_NF_NUM": "NFNUM9", "VTIN_SERIE": "SERIE",
    "DIG_VER": "CDV", "NUM_ALEATORIO": "DOCNUM9", "N_LOG": "AUTHCOD", "VTIN_ANO": "NFYEAR", "VTIN_MES": "NFMONTH",
}


def vtin_columns(vxr_prefix: str = "") -> list:
    """Invoice header columns as named in the result."""
    def c(n):
        return F.col(f"{vxr_prefix}{n}")

    return [
        *[c(source).alias(name) for name, source in VTIN_SOURCES.items()],
        amount(c("V_NF")).alias("VTIN_VLR_NF"),
        round_amount(c("V_NF"), 0).alias("A_VTIN_VLR_NF"),
    ]


DOC_SALTS = 64


def has_blank_active(erp: ErpTables) -> bool:
    """Whether any active NF-e has a blank document number.  Normally none
    has, and then no blank document can be met: the joins that would look for
    it are left out of the plans.  One narrow scan that ends at the first."""
    return not active_nfe(erp).where(F.col("DOCNUM") == "").select("DOCNUM").isEmpty()


def _documents(erp: ErpTables, blank_too: bool, blank_only: bool) -> DataFrame:
    """Fiscal documents by (DOCNUM, salt); blank numbers, a constant key, are
    spread over ``DOC_SALTS`` salts."""
    doc = erp.nfdoc.where(F.col("DOCNUM").isNotNull())
    if not blank_too:
        doc = doc.where(F.col("DOCNUM") != "")
    elif blank_only:
        doc = doc.where(F.col("DOCNUM") == "")
    salt = F.pmod(F.xxhash64("BELNR", "NTGEW", "NFTOT", "CRENAM"), F.lit(DOC_SALTS))
    salt = F.when(F.col("DOCNUM") == "", salt).otherwise(F.lit(0).cast("long"))
    return doc.select(F.col("DOCNUM").alias("_doc"), "NTGEW", "NFTOT", "CRENAM", salt.alias("_salt"))


def _own_salt(number: Column, *columns: str) -> Column:
    """0, or without a number a salt of the row's own that no document has."""
    return F.when(number.isNull(), -1 - F.pmod(F.xxhash64(*columns), F.lit(1 << 20))).otherwise(F.lit(0)).cast("long")


def _numbered(act: DataFrame, doc: DataFrame) -> DataFrame:
    """Active NF-e of which none has a blank number, with their documents."""
    own = act.withColumn("_j_salt", _own_salt(F.col("DOCNUM"), *ACTIVE_KEYS_7))
    both = own.join(doc, (F.col("DOCNUM") == F.col("_doc")) & (F.col("_j_salt") == F.col("_salt")), "left")
    return both.drop("_j_salt", "_doc", "_salt")


HEADER_COLUMNS = ["MANSTA", "CODESTA", "ID", "LIFNR", "DATECR", "TIMECR", "D_EMI", "STCD1", "MODEL", "BUKRS", "BRANCH",
                  "NFNUM9", "SERIE", "CDV", "DOCNUM9", "AUTHCOD", "NFYEAR", "NFMONTH", "V_NF"]
NUMBER_KEYS = [k for k in ACTIVE_KEYS_7 if k != "STCD1"]  # what numbers an NF-e, whoever issued it


def value_keys(v: Column | str) -> tuple[Column, Column]:
    """The two candidate keys of an invoice value for the tax-id route."""
    return round_amount(v, 2), round_amount(F.round(amount(v), 0), 2)


@dataclass
class WantedKeys:
    """What written hits look for in the invoices: by tax id and quantity
    (``_tax``, ``_qty``), and by tax id, quantity and value (``_val`` too)."""

    quantities: DataFrame
    values: DataFrame

    def keep(self, rows: DataFrame, tax: Column, value: str, qty: Column | None = None) -> DataFrame:
        """The invoice rows that a hit may meet: all that one does and few
        others.  Without ``qty`` (headers) the tax id and the value decide."""
        some, names = ([tax], ["_tax"]) if qty is None else ([tax, qty], ["_tax", "_qty"])
        exact, whole = value_keys(value)
        rows = marked(rows, "_by_qty", some, self.quantities, names)
        rows = marked(rows, "_by_value", [*some, exact], self.values, [*names, "_val"])
        rows = marked(rows, "_by_whole", [*some, whole], self.values, [*names, "_val"])
        marks = ["_by_qty", "_by_value", "_by_whole"]
        return rows.where(" OR ".join(marks)).drop(*marks)


def invoice_block(erp: ErpTables, open_only: bool = False, years=None, wanted: WantedKeys | None = None,
                  blank_active: bool | None = None, columns: Collection[str] | None = None) -> DataFrame:
    """Authorised received invoices with their item, the matching active
    NF-e (7 keys) and its fiscal document, as one flat block.

    CODESTA must be '100' and MANSTA not '03'/'04' (a NULL MANSTA drops the
    row, as ``NOT IN`` does in SQL).

    Every table is read and joined once.  The document key is (DOCNUM, salt):
    a row without a number has a salt of its own, so NULLs spread over the
    partitions; a row with a blank number meets the documents of every salt,
    so no task holds all of them (a blank number without any document keeps
    one row).  ``blank_active`` says whether there is a blank active number at
    all (:func:`has_blank_active`, measured if not given); without one blank
    documents are not read, the others are joined to their active NF-e before
    these meet the lines, and with ``open_only`` no document is read.

    With ``open_only`` only invoices that can still be booked are kept (no
    active NF-e, or one with a blank DOCNUM) before the document join,
    ``years`` restricts the emission year up front, and ``wanted`` leaves most
    lines out that no hit can meet; those left are written before their
    active NF-e are looked up, which are cut to their numbers.  Of these lines
    columns that are neither keys nor among ``columns`` are not written.
    """
    blank = has_blank_active(erp) if blank_active is None else blank_active
    vxr = erp.xml_rec.where((F.col("CODESTA") == "100") & ~F.col("MANSTA").isin("03", "04"))
    if years is not None:
        vxr = vxr.where(ymd_year_in("D_EMI", years))
        if EMISSION_YEAR in vxr.columns:  # stored by year: the other folders are not read
            vxr = vxr.where(F.col(EMISSION_YEAR).isin(*[int(y) for y in years]))
    active = active_nfe(erp).withColumnRenamed("BRANCH", "ACT_BRANCH")
    payload = ["PARID", "ACT_BRANCH", "CREDAT"]
    if open_only:
        # a numbered NF-e only drops its invoice: it is moved with its keys and a mark
        numbered = F.coalesce(F.col("DOCNUM") != "", F.lit(False))
        active = active.select(
            *ACTIVE_KEYS_7,
            *[F.when(~numbered, F.col(c)).alias(c) for c in payload],
            F.when(numbered, F.lit("*")).otherwise(F.col("DOCNUM")).alias("DOCNUM"),
        )
    act = active.select(*ACTIVE_KEYS_7, *payload, "DOCNUM")
    if not open_only and not blank:
        # an NF-e brings its documents: the invoice lines are not moved again for them
        act = _numbered(act, _documents(erp, False, False))
    item = erp.nfeit.select("NFEID", "NFITEM", "NCM", "CFOP", "QCOM")
    vxr = vxr.select(*HEADER_COLUMNS)
    if wanted is None:
        j = vxr.join(item, vxr["ID"] == item["NFEID"], "inner")
    else:
        # headers by tax id and value before they move, lines by quantity too
        vxr = wanted.keep(vxr, ltrim0("STCD1"), "V_NF")
        j = wanted.keep(vxr.join(item, vxr["ID"] == item["NFEID"], "inner"), ltrim0("STCD1"), "V_NF", round_amount("QCOM", 3))
        if columns is not None:
            read = {"ITEM": "NFITEM", "NCM": "NCM", "CFOP": "CFOP", **VTIN_SOURCES}
            j = blanked(j, [*ACTIVE_KEYS_7, "ID", "V_NF", "QCOM", *[source for name, source in read.items() if name in columns]])
        j = cut_lineage(j, "wanted-lines")
        act = may_meet(act, NUMBER_KEYS, j, NUMBER_KEYS)
    j, act = j.alias("vxr"), act.alias("act")
    cond7 = [F.col(f"vxr.{k}") == F.col(f"act.{k}") for k in ACTIVE_KEYS_7]
    j = j.join(act, cond7, "left")
    if open_only:
        j = j.where(F.col("act.DOCNUM").isNull() | (F.col("act.DOCNUM") == ""))
    if open_only and not blank:
        # no number is left to look a document up by
        j = j.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("NTGEW", AMOUNT), ("NFTOT", AMOUNT), ("CRENAM", "string"))])
    elif blank:
        number = F.col("act.DOCNUM")
        # the first salt keeps the row if there is no blank document at all
        salts = F.when(number == "", F.sequence(F.lit(0).cast("long"), F.lit(DOC_SALTS - 1).cast("long"))).otherwise(F.array(_own_salt(number, "vxr.ID")))
        j = j.withColumn("_j_salt", F.explode(salts))
        doc = _documents(erp, blank, open_only).alias("doc")
        j = j.join(doc, (number == F.col("doc._doc")) & (F.col("_j_salt") == F.col("doc._salt")), "left")
        # a salt without a document is a row only where no salt has one
        some = erp.nfdoc.where(F.col("DOCNUM") == "").select(F.lit("").alias("_any")).limit(1)
        j = j.join(F.broadcast(some), number == F.col("_any"), "left")  # one row at most
        missing = (number == "") & F.col("doc._doc").isNull()
        j = j.where(~F.coalesce(missing, F.lit(False)) | (F.col("_any").isNull() & (F.col("_j_salt") == 0)))
    return j.select(
        F.col("act.PARID").alias("PARCEIRO"),
        F.col("act.ACT_BRANCH").alias("LOCAL"),
        F.col("act.CREDAT").alias("DT_CRIACAO"),
        F.col("act.DOCNUM").alias("DOCNUM"),
        amount(F.col("NTGEW")).alias("PESO_LIQUIDO"),
        amount(F.col("NFTOT")).alias("VLR_NF"),
        F.col("CRENAM").alias("CRENAM"),
        *vtin_columns("vxr."),
        F.col("vxr.NFITEM").alias("ITEM"),
        F.col("vxr.NCM").alias("NCM"),
        F.col("vxr.CFOP").alias("CFOP"),
        amount(F.col("vxr.QCOM")).alias("VTIN_QTDE"),
    )
