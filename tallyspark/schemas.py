"""Fixed schemas of the domain: queue rows, result table, activity records.

The result table has a fixed 84-column layout (BIGINT / TEXT / TIMESTAMP /
NUMERIC(18,6)); NUMERIC(18,6) maps to ``DecimalType(18, 6)``.
"""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 6)
TEXT = T.StringType()

# --- fixed values: process names, status vocabularies -----------------------
ROW_SUCESSO = "SUCESSO"
ROW_SEM_RETORNO = "SEM_RETORNO"
ROW_ERRO = "ERRO"
PROC_SEM_DADOS = "SEM_DADOS"
RUN_SUCESSO = "SUCESSO"
RUN_PARCIAL = "PARCIAL"
RUN_ERRO = "ERRO"

ROUTE_DOCUMENT = "VIA_MIRO"
ROUTE_TAX_ID = "VIA_CPF_MATCH"

# Queue columns after the queue scan (S1/S2), in output order.
QUEUE_COLUMNS = [
    "id",
    "tipo_processo",
    "status",
    "status_complemento_fixo",
    "tipo",
    "n_contrato",
    "doc_compra",
    "numero_cockpit_original",
    "centro",
    "safra",
    "material",
    "cod_parceiro",
    "data_hora_ultima_atualizacao",
    "numero_cockpit",
    "msg_rpa",
    "chave_acesso",
    "data_processamento",
    "hora_processamento",
]

# Raw quantity-queue table (the four quantity queues share it).
QUANTITY_QUEUE_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [
        T.StructField(c, TEXT)
        for c in [
            "status",
            "status_complemento_fixo",
            "tipo",
            "n_contrato",
            "doc_compra",
            "numero_cockpit",
            "centro",
            "safra",
            "material",
            "cod_parceiro",
            "data_hora_ultima_atualizacao",
            "msg_rpa",
            "chave_acesso",
            "data_processamento",
            "hora_processamento",
            "valor",
            "qtd_contratado",
            "qtde_liquidada",
            "num_nota_fiscal",
        ]
    ]
)

# Raw value-queue table: a different vocabulary renamed onto the common one.
VALUE_QUEUE_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [
        T.StructField(c, TEXT)
        for c in [
            "ctr_status",
            "ctr_description",
            "tipo_complemento",
            "n_contrato",
            "documento_compras",
            "id_cockpit",
            "centro",
            "safra",
            "material",
            "codigo_parceiro",
            "ctr_last_updated",
            "msg_sap",
        ]
    ]
)

# --- fixed values: 84-column result table, in table order -------------------
RESULT_DDL: list[tuple[str, T.DataType]] = [
    ("ID", T.LongType()),
    ("TIPO_PROCESSO", TEXT),
    ("STATUS", TEXT),
    ("STATUS_COMPLEMENTO_FIXO", TEXT),
    ("TIPO", TEXT),
    ("N_CONTRATO", TEXT),
    ("DOC_COMPRA", TEXT),
    ("NUMERO_COCKPIT_ORIGINAL", TEXT),
    ("CENTRO", TEXT),
    ("SAFRA", TEXT),
    ("MATERIAL", TEXT),
    ("COD_PARCEIRO", TEXT),
    ("DATA_HORA_ULTIMA_ATUALIZACAO", TEXT),
    ("NUMERO_COCKPIT", TEXT),
    ("MSG_RPA", TEXT),
    ("VTIN_CHAVE_ACESSO", TEXT),
    ("VTIN_DT_PROC", TEXT),
    ("VTIN_HR_PROC", TEXT),
    ("PROCESS_NAME", TEXT),
    ("DATA_EXECUCAO", T.TimestampType()),
    ("STATUS_EXECUCAO", TEXT),
    ("TEMPO_EXECUCAO", AMOUNT),
    ("MENSAGEM_ERRO", TEXT),
    ("ZMMT_MANDT", TEXT),
    ("ZMMT_ID", TEXT),
    ("ZMMT_CONTRATO", TEXT),
    ("ZMMT_DATA", TEXT),
    ("ZMMT_QTDE", AMOUNT),
    ("ZMMT_VALOR", AMOUNT),
    ("ZMMT_MIRO_DATA", TEXT),
    ("ZMMT_MIRO_HORA", TEXT),
    ("ZMMT_MIRO_DOC", TEXT),
    ("ZMMT_MIRO_ANO", TEXT),
    ("ZMMT_TIPO", TEXT),
    ("CTR_MANDT", TEXT),
    ("BUKRS", TEXT),
    ("EBELN", TEXT),
    ("KONNR", TEXT),
    ("LIFNR", TEXT),
    ("NAME", TEXT),
    ("CPF_CNPJ", TEXT),
    ("IE", TEXT),
    ("NAME1_TEXT", TEXT),
    ("TIPO_DOCUMENTO", TEXT),
    ("CANAL_DISTRIBUICAO", TEXT),
    ("DIVISAO", TEXT),
    ("ITEM_CONTRATO", TEXT),
    ("CTR_MATERIAL", TEXT),
    ("CTR_DESCRICAO_ITEM", TEXT),
    ("CTR_QTD_PREVISTA", AMOUNT),
    ("CTR_UM", TEXT),
    ("PARCEIRO", TEXT),
    ("LOCAL", TEXT),
    ("DT_CRIACAO", TEXT),
    ("DOCNUM", TEXT),
    ("CRENAM", TEXT),
    ("PESO_LIQUIDO", AMOUNT),
    ("VLR_NF", AMOUNT),
    ("VTIN_STATUS", TEXT),
    ("VTIN_COD_STATUS_SEFAZ", TEXT),
    ("VTIN_XML", TEXT),
    ("ITEM", TEXT),
    ("NCM", TEXT),
    ("CFOP", TEXT),
    ("VTIN_COD_PARCEIRO", TEXT),
    ("VTIN_DT_CRIACAO", TEXT),
    ("VTIN_HR_CRIACAO", TEXT),
    ("VTIN_DT_EMISSAO", TEXT),
    ("VTIN_CPF_CNPJ", TEXT),
    ("VTIN_MODELO", TEXT),
    ("VTIN_EMPRESA", TEXT),
    ("VTIN_CENTRO", TEXT),
    ("VTIN_NF_NUM", TEXT),
    ("VTIN_SERIE", TEXT),
    ("DIG_VER", TEXT),
    ("NUM_ALEATORIO", TEXT),
    ("N_LOG", TEXT),
    ("VTIN_ANO", TEXT),
    ("VTIN_MES", TEXT),
    ("VTIN_QTDE", AMOUNT),
    ("VTIN_VLR_NF", AMOUNT),
    ("A_VTIN_VLR_NF", AMOUNT),
    ("RESULTADO", AMOUNT),
    ("ORIGEM_MATCH", TEXT),
]

RESULT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in RESULT_DDL])
RESULT_COLUMNS = [n for n, _ in RESULT_DDL]

# Storage-only contract columns (the purchase block has no item columns).
STORAGE_ONLY_COLUMNS = [
    "TIPO_DOCUMENTO",
    "CANAL_DISTRIBUICAO",
    "DIVISAO",
    "ITEM_CONTRATO",
    "CTR_MATERIAL",
    "CTR_DESCRICAO_ITEM",
    "CTR_QTD_PREVISTA",
    "CTR_UM",
]

# Natural key of the result table; NULL parts compare as '' except the
# first and the last one.
UPSERT_KEYS = [
    "PROCESS_NAME",
    "DOC_COMPRA",
    "N_CONTRATO",
    "NUMERO_COCKPIT",
    "DOCNUM",
    "STATUS_EXECUCAO",
]
UPSERT_NULL_AS_EMPTY = ["DOC_COMPRA", "N_CONTRATO", "NUMERO_COCKPIT", "DOCNUM"]

# Activity (bot run) records.
ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("deploymentId", TEXT),
        T.StructField("fileId", TEXT),
        T.StructField("runAsUserId", TEXT),
        T.StructField("status", TEXT),
        T.StructField("path", TEXT),
        T.StructField("startDateTime", TEXT),
    ]
)


# --- fixed values: ERP source tables (columns the matching reads) -----------------
ERP_SCHEMAS = {
    "zmmt0022": "MANDT string, ID string, CONTRATO string, DATA string, QTDE decimal(18,6), VALOR decimal(18,6), "
    "MIRO_DATA string, MIRO_HORA string, MIRO_DOC string, MIRO_ANO string, TIPO string",
    "ekko": "MANDT string, BUKRS string, EBELN string, KONNR string, LIFNR string",
    "ekpo": "MANDT string, EBELN string, MATNR string",
    "mara": "MATNR string, SPART string",
    "bp_fiscal": "PARTNER string, NAME string, CPF_CNPJ string, IE string, NAME1_TEXT string",
    "vbak": "MANDT string, VKORG string, VBELN string, KUNNR string, AUART string, VTWEG string, SPART string",
    "vbap": "MANDT string, VBELN string, POSNR string, MATNR string, ARKTX string, KWMENG decimal(18,6), VRKME string",
    "kna1": "MANDT string, KUNNR string, NAME1 string, STCD1 string, STCD2 string",
    "xml_rec": "ID string, MANSTA string, CODESTA string, LIFNR string, DATECR string, TIMECR string, D_EMI string, "
    "STCD1 string, MODEL string, BUKRS string, BRANCH string, NFNUM9 string, SERIE string, CDV string, "
    "DOCNUM9 string, AUTHCOD string, NFYEAR string, NFMONTH string, V_NF decimal(18,6)",
    "nfeit": "NFEID string, NFITEM string, NCM string, CFOP string, QCOM decimal(18,6), PONUMBER string",
    "nfe_active": "NFYEAR string, NFMONTH string, STCD1 string, MODEL string, NFNUM9 string, DOCNUM9 string, "
    "CDV string, DIRECT string, CANCEL string, PARID string, BRANCH string, CREDAT string, DOCNUM string",
    "nfdoc": "DOCNUM string, BELNR string, GJAHR string, DIRECT string, NTGEW decimal(18,6), NFTOT decimal(18,6), "
    "CRENAM string",
}
