"""SQL twin (DuckDB dialect) of :mod:`tallyspark.sources.testdata`.

Used only by the correctness oracle: each domain view as a CTE over the
driver's raw tables.  Keep every rule in step with the DataFrame version.
"""

from __future__ import annotations

from tallyspark.sources.registry import DEFAULT_PROCESSES, KIND_VALUE
from tallyspark.sources.testdata import (
    CONTRACT_BASE,
    DOCNUM_BASE,
    EVENT_TO_STATUS,
    MANDT,
    MIRO_BASE,
    PRIORITY_TO_PROCESS,
)


def ymd(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS VARCHAR)"


def padded(k: str) -> str:
    return f"lpad(CAST({CONTRACT_BASE} + {k} AS VARCHAR), 10, '0')"


def plain(k: str) -> str:
    return f"CAST({CONTRACT_BASE} + {k} AS VARCHAR)"


def cockpit(k: str) -> str:
    return (
        f"CASE WHEN {k} % 17 = 0 THEN NULL WHEN {k} % 17 = 1 THEN ' | ' "
        f"ELSE '1| 2|1||0003|' || CAST({k} % 7 + 1 AS VARCHAR) || CASE WHEN {k} % 59 = 0 THEN '|A1' ELSE '' END END"
    )


def status(k: str) -> str:
    return (
        f"CASE {k} % 6 WHEN 0 THEN '12' WHEN 1 THEN '13' WHEN 2 THEN '9' "
        f"WHEN 3 THEN '15' WHEN 4 THEN '12' ELSE '10' END"
    )


def _priority(process_name: str) -> str:
    return next(k for k, v in PRIORITY_TO_PROCESS.items() if v == process_name)


def queue_id(k: str) -> str:
    return f"CASE WHEN {k} % 41 = 0 THEN NULL WHEN {k} % 43 = 0 THEN 7 ELSE {k} END"


def queue_orders(process_name: str) -> str:
    return (
        "FROM orders JOIN (VALUES (1), (2)) twice(copy) ON copy = 1 OR o_orderkey % 47 = 0 "
        f"WHERE o_orderpriority = '{_priority(process_name)}'"
    )


def quantity_queue_sql(process_name: str) -> str:
    k = "o_orderkey"
    return f"""SELECT {queue_id(k)} AS id, {status(k)} AS status,
  o_orderstatus AS status_complemento_fixo, 'QUANTIDADE' AS tipo,
  CASE WHEN {k} % 53 <> 0 THEN {plain(k)} END AS n_contrato, CASE WHEN {k} % 53 <> 0 THEN {padded(k)} END AS doc_compra,
  {cockpit(k)} AS numero_cockpit,
  lpad(substr(o_orderpriority, 1, 1), 4, '0') AS centro,
  CAST(year(o_orderdate) AS VARCHAR) AS safra, 'SOJA' AS material,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cod_parceiro,
  {ymd('o_orderdate')} AS data_hora_ultima_atualizacao, CAST(NULL AS VARCHAR) AS msg_rpa,
  'NFE' || CAST({k} AS VARCHAR) AS chave_acesso, {ymd('o_orderdate')} AS data_processamento,
  '08:00:00' AS hora_processamento
{queue_orders(process_name)}"""


def value_queue_sql(process_name: str) -> str:
    k = "o_orderkey"
    return f"""SELECT {queue_id(k)} AS id, CASE WHEN {k} % 3 = 2 THEN '02' ELSE '01' END AS ctr_status,
  o_orderstatus AS ctr_description, 'VALOR' AS tipo_complemento,
  {plain(k)} AS n_contrato, {padded(k)} AS documento_compras, {cockpit(k)} AS id_cockpit,
  lpad(substr(o_orderpriority, 1, 1), 4, '0') AS centro,
  CAST(year(o_orderdate) AS VARCHAR) AS safra, 'SOJA' AS material,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS codigo_parceiro,
  {ymd('o_orderdate')} AS ctr_last_updated, CAST(NULL AS VARCHAR) AS msg_sap
{queue_orders(process_name)}"""


def queue_view_name(process_name: str) -> str:
    return "q_" + process_name.lower()


def _line_id(lk: str = "l_orderkey", ln: str = "l_linenumber") -> str:
    return f"({lk} * 10 + {ln})"


def erp_view_ctes() -> list[tuple[str, str]]:
    """(name, body) pairs of the twelve ERP views and the five queues."""
    li = _line_id()
    views = []
    for p in DEFAULT_PROCESSES:
        body = value_queue_sql(p.process_name) if p.kind == KIND_VALUE else quantity_queue_sql(p.process_name)
        views.append((queue_view_name(p.process_name), body))
    views += [
        ("zmmt0022", f"""SELECT '{MANDT}' AS MANDT, lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS ID,
  {padded('l_orderkey')} AS CONTRATO,
  CASE WHEN l_orderkey % 23 = 0 THEN '00000000' ELSE {ymd('l_shipdate')} END AS DATA,
  CASE WHEN l_orderkey % 61 <> 0 THEN CAST(l_quantity AS DECIMAL(18,6)) END AS QTDE, CAST(l_extendedprice AS DECIMAL(18,6)) AS VALOR,
  CASE WHEN l_orderkey % 11 = 0 THEN '00000000' ELSE {ymd('l_shipdate')} END AS MIRO_DATA,
  '120000' AS MIRO_HORA,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST({MIRO_BASE} + {li} AS VARCHAR) END AS MIRO_DOC,
  CAST(year(l_shipdate) AS VARCHAR) AS MIRO_ANO, 'F' AS TIPO
FROM lineitem"""),
        ("ekko", f"""SELECT '{MANDT}' AS MANDT, '1000' AS BUKRS, {padded('o_orderkey')} AS EBELN,
  'K' || CAST(o_orderkey AS VARCHAR) AS KONNR, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS LIFNR
FROM orders"""),
        ("ekpo", f"""SELECT '{MANDT}' AS MANDT, {padded('l_orderkey')} AS EBELN, CAST(l_partkey AS VARCHAR) AS MATNR
FROM lineitem"""),
        ("mara", """SELECT CAST(p_partkey AS VARCHAR) AS MATNR, CASE WHEN p_size <= 40 THEN '01' ELSE '02' END AS SPART
FROM part"""),
        ("bp_fiscal", """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS PARTNER, c_name AS NAME,
  lpad(CAST(c_custkey + 1 AS VARCHAR), 11, '0') AS CPF_CNPJ, CAST(c_nationkey AS VARCHAR) AS IE,
  c_mktsegment AS NAME1_TEXT
FROM customer
UNION ALL
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0'), c_name,
  lpad(CAST(c_custkey + 1000000 AS VARCHAR), 14, '0'), CAST(c_nationkey AS VARCHAR), c_mktsegment
FROM customer WHERE c_nationkey = 0"""),
        ("vbak", f"""SELECT '{MANDT}' AS MANDT, '2000' AS VKORG, {padded('o_orderkey')} AS VBELN,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS KUNNR, 'ZARM' AS AUART, '10' AS VTWEG, '01' AS SPART
FROM orders"""),
        ("vbap", f"""SELECT '{MANDT}' AS MANDT, {padded('l_orderkey')} AS VBELN,
  lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS POSNR, CAST(l_partkey AS VARCHAR) AS MATNR,
  'ITEM ' || CAST(l_partkey AS VARCHAR) AS ARKTX, CAST(l_quantity AS DECIMAL(18,6)) AS KWMENG,
  'KG' AS VRKME
FROM lineitem"""),
        ("kna1", f"""SELECT '{MANDT}' AS MANDT, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS KUNNR, c_name AS NAME1,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey + 1 AS VARCHAR) END AS STCD1,
  lpad(CAST(c_custkey + 1 AS VARCHAR), 11, '0') AS STCD2
FROM customer"""),
        ("inv_base", """SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
        ("xml_rec", f"""SELECT CAST({li} AS VARCHAR) AS ID,
  CASE WHEN l_linenumber = 7 THEN '03' ELSE '01' END AS MANSTA,
  CASE WHEN l_orderkey % 13 = 0 THEN '101' ELSE '100' END AS CODESTA,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS LIFNR, {ymd('l_shipdate')} AS DATECR, '080000' AS TIMECR,
  {ymd('l_shipdate')} AS D_EMI, CAST(o_custkey + 1 AS VARCHAR) AS STCD1, '55' AS MODEL, '1000' AS BUKRS,
  '0001' AS BRANCH, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS NFNUM9, '1' AS SERIE,
  CAST(l_linenumber AS VARCHAR) AS CDV, lpad(CAST(l_linenumber AS VARCHAR), 9, '0') AS DOCNUM9,
  '1' || CAST(l_orderkey AS VARCHAR) AS AUTHCOD, CAST(year(l_shipdate) AS VARCHAR) AS NFYEAR,
  lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS NFMONTH,
  CAST(CASE WHEN l_orderkey % 7 = 0 THEN round(CAST(l_extendedprice AS DECIMAL(18,6)), 0)
            WHEN l_orderkey % 7 = 1 THEN CAST(l_extendedprice AS DECIMAL(18,6)) + 5
            ELSE CAST(l_extendedprice AS DECIMAL(18,6)) END AS DECIMAL(18,6)) AS V_NF
FROM inv_base"""),
        ("nfeit", f"""SELECT CAST({li} AS VARCHAR) AS NFEID, lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS NFITEM,
  '12019000' AS NCM, '1101' AS CFOP, CAST(l_quantity AS DECIMAL(18,6)) AS QCOM,
  CASE WHEN l_returnflag = 'A' THEN {padded('l_orderkey')}
       WHEN l_returnflag = 'N' THEN {plain('l_orderkey')} ELSE '' END AS PONUMBER
FROM lineitem"""),
        ("nfe_active", f"""SELECT CAST(year(l_shipdate) AS VARCHAR) AS NFYEAR,
  lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS NFMONTH, CAST(o_custkey + 1 AS VARCHAR) AS STCD1,
  '55' AS MODEL, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS NFNUM9,
  lpad(CAST(l_linenumber AS VARCHAR), 9, '0') AS DOCNUM9, CAST(l_linenumber AS VARCHAR) AS CDV,
  '1' AS DIRECT, CASE WHEN l_linenumber = 6 THEN 'X' ELSE '' END AS CANCEL,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS PARID, '0001' AS BRANCH, {ymd('l_shipdate')} AS CREDAT,
  CAST({DOCNUM_BASE} + {li} AS VARCHAR) AS DOCNUM
FROM inv_base WHERE l_linestatus = 'F'"""),
        ("nfdoc", f"""SELECT CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE CAST({DOCNUM_BASE} + {li} AS VARCHAR) END AS DOCNUM,
  CAST({MIRO_BASE} + {li} AS VARCHAR) AS BELNR, CAST(year(l_shipdate) AS VARCHAR) AS GJAHR,
  '1' AS DIRECT,
  CAST(CAST(l_quantity AS DECIMAL(18,6)) + CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END AS DECIMAL(18,6)) AS NTGEW,
  CAST(l_extendedprice AS DECIMAL(18,6)) AS NFTOT, 'FISCAL01' AS CRENAM
FROM lineitem"""),
    ]
    return views


def activity_view_cte() -> tuple[str, str]:
    status = "CAST(NULL AS VARCHAR)"
    for etype, st in EVENT_TO_STATUS.items():
        status = f"CASE WHEN event_type = '{etype}' THEN '{st}' ELSE {status} END"
    dept = "(['Fiscal', 'Compras', 'Logistica'])[CAST(user_id % 3 + 1 AS INTEGER)]"
    path = (
        f"CASE WHEN user_id % 4 = 0 THEN 'RPA Repository\\Bots\\' || {dept} || '\\bot_' || CAST(user_id AS VARCHAR) "
        f"WHEN user_id % 4 = 1 THEN '/RPA Repository/Bots/' || {dept} || '/sub/bot' "
        f"WHEN user_id % 4 = 2 THEN 'RPA Repository\\Bots' "
        f"ELSE 'Private\\' || {dept} END"
    )
    return (
        "activity",
        f"""SELECT CAST(event_id AS VARCHAR) AS deploymentId, CAST(1211400 + user_id % 5 AS VARCHAR) AS fileId,
  CAST(900 + user_id % 3 AS VARCHAR) AS runAsUserId, {status} AS status, {path} AS path,
  CAST(ts AS VARCHAR) AS startDateTime
FROM events""",
    )
