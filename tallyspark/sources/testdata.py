"""Domain views derived from the driver's TPC-H-like test tables.

The reconciliation works on queue tables, an expected-amounts ledger,
contract/partner tables and received-invoice tables.  The test data is a
TPC-H-like star schema, so every domain table is *derived* from the whole
of one test table (plus an orders lookup where a customer is needed).  No
row is dropped to make anything cheaper: the five queues partition the
``orders`` table by ``o_orderpriority`` and every ledger / invoice view has
one row per ``lineitem`` row (the active-NF-e view keeps the lines whose
status says the invoice was registered).

Every rule here has a SQL twin in :mod:`tallyspark.plans.oracle_views`;
keep the two in step.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.keys import amount, ymd
from tallyspark.sources.erp import ErpTables
from tallyspark.sources.registry import DEFAULT_PROCESSES, KIND_VALUE, ProcessDef

# --- fixed values of the derivation ------------------------------------------
# orders.o_orderpriority -> process (each order lands in exactly one queue)
PRIORITY_TO_PROCESS = {
    "1-URGENT": "V2_Consulta_Comp_CTRFIXO",
    "2-HIGH": "V2_Consulta_Comp_CTR_S_FIXACAO",
    "3-MEDIUM": "V2_Consulta_Comp_CTR_C_FIXACAO",
    "4-NOT SPECIFIED": "V2_Consulta_Comp_ARMAZEN",
    "5-LOW": "V2_Consulta_Comp_VALOR",
}
CONTRACT_BASE = 40000000  # contract number = CONTRACT_BASE + orderkey
MIRO_BASE = 5100000000  # posting document = MIRO_BASE + orderkey*10 + linenumber
DOCNUM_BASE = 6000000000  # fiscal document number, same rule
MANDT = "300"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _contract_padded(orderkey: Column) -> Column:
    return F.lpad((F.lit(CONTRACT_BASE) + orderkey).cast("string"), 10, "0")


def _contract_plain(orderkey: Column) -> Column:
    return (F.lit(CONTRACT_BASE) + orderkey).cast("string")


def _line_id(orderkey: Column, linenumber: Column) -> Column:
    return orderkey * 10 + linenumber


def _cockpit_text(orderkey: Column) -> Column:
    """Composite cockpit ids with a duplicate, a blank, zero padding and
    spaces; NULL for some rows and all-blank for others."""
    return (
        F.when(orderkey % 17 == 0, F.lit(None).cast("string"))
        .when(orderkey % 17 == 1, F.lit(" | "))
        .otherwise(
            F.concat(
                F.lit("1| 2|1||0003|"), (orderkey % 7 + 1).cast("string"),
                F.when(orderkey % 59 == 0, F.lit("|A1")).otherwise(F.lit("")),  # not a number
            )
        )
    )


def _queue_status(orderkey: Column) -> Column:
    return (
        F.when(orderkey % 6 == 0, "12")
        .when(orderkey % 6 == 1, "13")
        .when(orderkey % 6 == 2, "9")
        .when(orderkey % 6 == 3, "15")
        .when(orderkey % 6 == 4, "12")
        .otherwise("10")
    )


def _queue_id(orderkey: Column) -> Column:
    """Queue ids as they come: some missing, some shared by different rows."""
    return F.when(orderkey % 41 == 0, F.lit(None).cast("long")).when(orderkey % 43 == 0, F.lit(7).cast("long")).otherwise(orderkey)


def _queue_orders(orders: DataFrame, process: ProcessDef) -> DataFrame:
    """The orders of a queue; some stand in it twice, equal in every column."""
    priority = next(k for k, v in PRIORITY_TO_PROCESS.items() if v == process.process_name)
    copies = F.when(F.col("o_orderkey") % 47 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return orders.where(F.col("o_orderpriority") == priority).withColumn("_copy", F.explode(copies))


def quantity_queue(orders: DataFrame, process: ProcessDef) -> DataFrame:
    """One quantity queue table (raw, before the status filter)."""
    k = F.col("o_orderkey")
    return _queue_orders(orders, process).select(
        _queue_id(k).alias("id"),
        _queue_status(k).alias("status"),
        F.col("o_orderstatus").alias("status_complemento_fixo"),
        F.lit("QUANTIDADE").alias("tipo"),
        F.when(k % 53 != 0, _contract_plain(k)).alias("n_contrato"),
        F.when(k % 53 != 0, _contract_padded(k)).alias("doc_compra"),
        _cockpit_text(k).alias("numero_cockpit"),
        F.lpad(F.substring("o_orderpriority", 1, 1), 4, "0").alias("centro"),
        F.year("o_orderdate").cast("string").alias("safra"),
        F.lit("SOJA").alias("material"),
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cod_parceiro"),
        ymd("o_orderdate").alias("data_hora_ultima_atualizacao"),
        F.lit(None).cast("string").alias("msg_rpa"),
        F.concat(F.lit("NFE"), k.cast("string")).alias("chave_acesso"),
        ymd("o_orderdate").alias("data_processamento"),
        F.lit("08:00:00").alias("hora_processamento"),
        F.col("o_totalprice").cast("string").alias("valor"),
        F.lit(None).cast("string").alias("qtd_contratado"),
        F.lit(None).cast("string").alias("qtde_liquidada"),
        F.lit(None).cast("string").alias("num_nota_fiscal"),
    )


def value_queue(orders: DataFrame, process: ProcessDef) -> DataFrame:
    """The value-complement queue table, in its own column vocabulary."""
    k = F.col("o_orderkey")
    return _queue_orders(orders, process).select(
        _queue_id(k).alias("id"),
        F.when(k % 3 == 2, "02").otherwise("01").alias("ctr_status"),
        F.col("o_orderstatus").alias("ctr_description"),
        F.lit("VALOR").alias("tipo_complemento"),
        _contract_plain(k).alias("n_contrato"),
        _contract_padded(k).alias("documento_compras"),
        _cockpit_text(k).alias("id_cockpit"),
        F.lpad(F.substring("o_orderpriority", 1, 1), 4, "0").alias("centro"),
        F.year("o_orderdate").cast("string").alias("safra"),
        F.lit("SOJA").alias("material"),
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("codigo_parceiro"),
        ymd("o_orderdate").alias("ctr_last_updated"),
        F.lit(None).cast("string").alias("msg_sap"),
    )


def ledger(lineitem: DataFrame) -> DataFrame:
    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return lineitem.select(
        F.lit(MANDT).alias("MANDT"),
        F.lpad(ln.cast("string"), 6, "0").alias("ID"),
        _contract_padded(lk).alias("CONTRATO"),
        F.when(lk % 23 == 0, F.lit("00000000")).otherwise(ymd("l_shipdate")).alias("DATA"),
        F.when(lk % 61 != 0, amount("l_quantity")).alias("QTDE"),
        amount("l_extendedprice").alias("VALOR"),
        F.when(lk % 11 == 0, F.lit("00000000")).otherwise(ymd("l_shipdate")).alias("MIRO_DATA"),
        F.lit("120000").alias("MIRO_HORA"),
        F.when(F.col("l_returnflag") == "R", F.lit(""))
        .otherwise((F.lit(MIRO_BASE) + _line_id(lk, ln)).cast("string"))
        .alias("MIRO_DOC"),
        F.year("l_shipdate").cast("string").alias("MIRO_ANO"),
        F.lit("F").alias("TIPO"),
    )


def _partner_key(custkey: Column) -> Column:
    return F.lpad(custkey.cast("string"), 10, "0")


def erp_tables(spark: SparkSession, sf_dir: str) -> ErpTables:
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    part = read_table(spark, sf_dir, "part")

    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    ok = F.col("o_orderkey")

    ekko = orders.select(
        F.lit(MANDT).alias("MANDT"),
        F.lit("1000").alias("BUKRS"),
        _contract_padded(ok).alias("EBELN"),
        F.concat(F.lit("K"), ok.cast("string")).alias("KONNR"),
        _partner_key(F.col("o_custkey")).alias("LIFNR"),
    )
    ekpo = lineitem.select(
        F.lit(MANDT).alias("MANDT"),
        _contract_padded(lk).alias("EBELN"),
        F.col("l_partkey").cast("string").alias("MATNR"),
    )
    mara = part.select(
        F.col("p_partkey").cast("string").alias("MATNR"),
        F.when(F.col("p_size") <= 40, "01").otherwise("02").alias("SPART"),
    )
    ck = F.col("c_custkey")
    # every partner has a personal tax id; nation-0 partners also carry a
    # company id, so a contract can fan out over two fiscal ids
    bp_main = customer.select(
        _partner_key(ck).alias("PARTNER"),
        F.col("c_name").alias("NAME"),
        F.lpad((ck + 1).cast("string"), 11, "0").alias("CPF_CNPJ"),
        F.col("c_nationkey").cast("string").alias("IE"),
        F.col("c_mktsegment").alias("NAME1_TEXT"),
    )
    bp_company = customer.where(F.col("c_nationkey") == 0).select(
        _partner_key(ck).alias("PARTNER"),
        F.col("c_name").alias("NAME"),
        F.lpad((ck + 1000000).cast("string"), 14, "0").alias("CPF_CNPJ"),
        F.col("c_nationkey").cast("string").alias("IE"),
        F.col("c_mktsegment").alias("NAME1_TEXT"),
    )
    bp_fiscal = bp_main.unionByName(bp_company)

    vbak = orders.select(
        F.lit(MANDT).alias("MANDT"),
        F.lit("2000").alias("VKORG"),
        _contract_padded(ok).alias("VBELN"),
        _partner_key(F.col("o_custkey")).alias("KUNNR"),
        F.lit("ZARM").alias("AUART"),
        F.lit("10").alias("VTWEG"),
        F.lit("01").alias("SPART"),
    )
    vbap = lineitem.select(
        F.lit(MANDT).alias("MANDT"),
        _contract_padded(lk).alias("VBELN"),
        F.lpad(ln.cast("string"), 6, "0").alias("POSNR"),
        F.col("l_partkey").cast("string").alias("MATNR"),
        F.concat(F.lit("ITEM "), F.col("l_partkey").cast("string")).alias("ARKTX"),
        amount("l_quantity").alias("KWMENG"),
        F.lit("KG").alias("VRKME"),
    )
    kna1 = customer.select(
        F.lit(MANDT).alias("MANDT"),
        _partner_key(ck).alias("KUNNR"),
        F.col("c_name").alias("NAME1"),
        F.when(ck % 3 == 0, F.lit("")).otherwise((ck + 1).cast("string")).alias("STCD1"),
        F.lpad((ck + 1).cast("string"), 11, "0").alias("STCD2"),
    )

    # invoices need the order's customer (the issuer's tax id)
    inv = lineitem.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    )
    line_id = _line_id(lk, ln)
    xml_rec = inv.select(
        line_id.cast("string").alias("ID"),
        F.when(ln == 7, "03").otherwise("01").alias("MANSTA"),
        F.when(lk % 13 == 0, "101").otherwise("100").alias("CODESTA"),
        _partner_key(F.col("o_custkey")).alias("LIFNR"),
        ymd("l_shipdate").alias("DATECR"),
        F.lit("080000").alias("TIMECR"),
        ymd("l_shipdate").alias("D_EMI"),
        (F.col("o_custkey") + 1).cast("string").alias("STCD1"),
        F.lit("55").alias("MODEL"),
        F.lit("1000").alias("BUKRS"),
        F.lit("0001").alias("BRANCH"),
        F.lpad(lk.cast("string"), 9, "0").alias("NFNUM9"),
        F.lit("1").alias("SERIE"),
        ln.cast("string").alias("CDV"),
        F.lpad(ln.cast("string"), 9, "0").alias("DOCNUM9"),
        F.concat(F.lit("1"), lk.cast("string")).alias("AUTHCOD"),
        F.year("l_shipdate").cast("string").alias("NFYEAR"),
        F.lpad(F.month("l_shipdate").cast("string"), 2, "0").alias("NFMONTH"),
        F.when(lk % 7 == 0, F.round(amount("l_extendedprice"), 0))
        .when(lk % 7 == 1, amount("l_extendedprice") + F.lit(5))
        .otherwise(amount("l_extendedprice"))
        .cast("decimal(18,6)")
        .alias("V_NF"),
    )
    nfeit = lineitem.select(
        line_id.cast("string").alias("NFEID"),
        F.lpad(ln.cast("string"), 6, "0").alias("NFITEM"),
        F.lit("12019000").alias("NCM"),
        F.lit("1101").alias("CFOP"),
        amount("l_quantity").alias("QCOM"),
        F.when(F.col("l_returnflag") == "A", _contract_padded(lk))
        .when(F.col("l_returnflag") == "N", _contract_plain(lk))
        .otherwise(F.lit(""))
        .alias("PONUMBER"),
    )
    nfe_active = inv.where(F.col("l_linestatus") == "F").select(
        F.year("l_shipdate").cast("string").alias("NFYEAR"),
        F.lpad(F.month("l_shipdate").cast("string"), 2, "0").alias("NFMONTH"),
        (F.col("o_custkey") + 1).cast("string").alias("STCD1"),
        F.lit("55").alias("MODEL"),
        F.lpad(lk.cast("string"), 9, "0").alias("NFNUM9"),
        F.lpad(ln.cast("string"), 9, "0").alias("DOCNUM9"),
        ln.cast("string").alias("CDV"),
        F.lit("1").alias("DIRECT"),
        F.when(ln == 6, "X").otherwise("").alias("CANCEL"),
        _partner_key(F.col("o_custkey")).alias("PARID"),
        F.lit("0001").alias("BRANCH"),
        ymd("l_shipdate").alias("CREDAT"),
        (F.lit(DOCNUM_BASE) + line_id).cast("string").alias("DOCNUM"),
    )
    nfdoc = lineitem.select(
        F.when(lk % 3 == 0, F.lit(""))
        .otherwise((F.lit(DOCNUM_BASE) + line_id).cast("string"))
        .alias("DOCNUM"),
        (F.lit(MIRO_BASE) + line_id).cast("string").alias("BELNR"),
        F.year("l_shipdate").cast("string").alias("GJAHR"),
        F.lit("1").alias("DIRECT"),
        (amount("l_quantity") + F.when(ln == 5, F.lit(1)).otherwise(F.lit(0)))
        .cast("decimal(18,6)")
        .alias("NTGEW"),
        amount("l_extendedprice").alias("NFTOT"),
        F.lit("FISCAL01").alias("CRENAM"),
    )
    return ErpTables(
        zmmt0022=ledger(lineitem),
        ekko=ekko,
        ekpo=ekpo,
        mara=mara,
        bp_fiscal=bp_fiscal,
        vbak=vbak,
        vbap=vbap,
        kna1=kna1,
        xml_rec=xml_rec,
        nfeit=nfeit,
        nfe_active=nfe_active,
        nfdoc=nfdoc,
    )


def with_blank_active(erp: ErpTables, spark: SparkSession, sf_dir: str) -> ErpTables:
    """The tables with one registered invoice (the first line of the smallest
    such order) that has no document number yet, and some documents whose
    number is missing rather than blank."""
    lines = read_table(spark, sf_dir, "lineitem")
    first = lines.where((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 13 != 0))
    number = first.agg(F.min("l_orderkey").alias("k")).select((F.lit(DOCNUM_BASE) + F.col("k") * 10 + 1).cast("string").alias("_first"))
    active = erp.nfe_active.join(F.broadcast(number), F.col("DOCNUM") == F.col("_first"), "left")  # one row
    active = active.withColumn("DOCNUM", F.when(F.col("_first").isNotNull(), F.lit("")).otherwise(F.col("DOCNUM"))).drop("_first")
    posted = F.col("BELNR").cast("long") - F.lit(MIRO_BASE)
    docs = erp.nfdoc.withColumn("DOCNUM", F.when((posted / 10).cast("long") % 15 == 0, F.lit(None)).otherwise(F.col("DOCNUM")))
    return replace(erp, nfe_active=active, nfdoc=docs)


def queue_tables(
    spark: SparkSession, sf_dir: str, processes=DEFAULT_PROCESSES
) -> dict[str, DataFrame]:
    """Raw queue tables by process name (value queue in its own vocabulary)."""
    orders = read_table(spark, sf_dir, "orders")
    out = {}
    for p in processes:
        out[p.process_name] = value_queue(orders, p) if p.kind == KIND_VALUE else quantity_queue(orders, p)
    return out


# --- fixed values: events.event_type -> bot activity status ------------------
EVENT_TO_STATUS = {
    "click": "RUNNING",
    "view": "QUEUED",
    "error": "RUN_FAILED",
    "purchase": "RUN_COMPLETED",
    "signup": "WAITING_APPROVAL",  # not a known status (falls in OTHER)
}
DEPARTMENTS = ["Fiscal", "Compras", "Logistica"]


def activity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bot activity records derived from ``events`` (one per event)."""
    ev = read_table(spark, sf_dir, "events")
    status = F.lit(None).cast("string")
    for etype, st in EVENT_TO_STATUS.items():
        status = F.when(F.col("event_type") == etype, F.lit(st)).otherwise(status)
    uid = F.col("user_id")
    dept = F.element_at(F.array(*[F.lit(d) for d in DEPARTMENTS]), (uid % 3 + 1).cast("int"))
    path = (
        F.when(uid % 4 == 0, F.concat(F.lit("RPA Repository\\Bots\\"), dept, F.lit("\\bot_"), uid.cast("string")))
        .when(uid % 4 == 1, F.concat(F.lit("/RPA Repository/Bots/"), dept, F.lit("/sub/bot")))
        .when(uid % 4 == 2, F.lit("RPA Repository\\Bots"))
        .otherwise(F.concat(F.lit("Private\\"), dept))
    )
    return ev.select(
        F.col("event_id").cast("string").alias("deploymentId"),
        (F.lit(1211400) + uid % 5).cast("string").alias("fileId"),
        (F.lit(900) + uid % 3).cast("string").alias("runAsUserId"),
        status.alias("status"),
        path.alias("path"),
        F.col("ts").cast("string").alias("startDateTime"),
    )
