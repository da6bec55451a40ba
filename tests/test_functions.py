"""Column helpers, name normaliser, type mapping, registry parameters."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions import keys as K
from tallyspark.functions.names import inferred_schema, normalize_column_name
from tallyspark.sinks.writers import save_strategy
from tallyspark.sources.registry import DEFAULT_PROCESSES, active_processes, get_process, parse_years


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col.alias("r")).first()["r"]


def test_ltrim0_all_zero_becomes_empty(spark):
    assert one(spark, K.ltrim0("x"), "0000") == ""
    assert one(spark, K.ltrim0("x"), "000123") == "123"
    assert one(spark, K.ltrim0("x"), None) is None
    assert one(spark, K.ltrim0_or_empty("x"), None) == ""


def test_lpad_truncates_but_zfill_does_not(spark):
    assert one(spark, K.lpad10("x"), "123") == "0000000123"
    assert one(spark, K.lpad10("x"), "123456789012") == "1234567890"
    assert one(spark, K.zfill10("x"), "123456789012") == "123456789012"
    assert one(spark, K.zfill10("x"), "12") == "0000000012"


def test_strip_ws_cuts_tabs_and_spaces(spark):
    assert one(spark, K.strip_ws("x"), "\t a b \n") == "a b"
    assert one(spark, K.is_blank("x"), " \t") is True
    assert one(spark, K.is_blank("x"), None) is True
    assert one(spark, K.is_blank("x"), " 1") is False


def test_split_cockpits_distinct_trimmed_no_blanks(spark):
    assert one(spark, K.split_cockpits("x"), "1| 2|1||0003|") == ["1", "2", "0003"]
    assert one(spark, K.split_cockpits("x"), " | ") == []
    assert one(spark, K.split_cockpits("x"), None) == []


def test_split_cockpits_audit_keeps_duplicates_and_one_empty(spark):
    assert one(spark, K.split_cockpits_keep_empty("x"), "1|1| 2") == ["1", "1", "2"]
    assert one(spark, K.split_cockpits_keep_empty("x"), " | ") == [""]
    assert one(spark, K.split_cockpits_keep_empty("x"), None) == [""]


def test_docnum_filled_rule(spark):
    assert one(spark, K.nonblank_docnum("x"), "000") is False
    assert one(spark, K.nonblank_docnum("x"), " 0 ") is True  # zeros cut first, then blanks: '0 ' -> ' 0 ' is not all zeros
    assert one(spark, K.nonblank_docnum("x"), "0012300") is True
    assert one(spark, K.nonblank_docnum("x"), None) is False
    assert one(spark, K.nonblank_docnum("x"), "") is False


def test_dates(spark):
    assert one(spark, K.parse_ymd("x"), "00000000") is None
    assert one(spark, K.parse_ymd("x"), "20260131") == dt.date(2026, 1, 31)
    assert one(spark, K.ymd_year_in("x", [2026]), "20260131") is True


@pytest.mark.parametrize("secs,text", [(0.0, "00:00:00"), (30.0, "00:00:30"), (3661.0, "01:01:01"), (None, "00:00:00"), (2.5, "00:00:02")])
def test_hhmmss(spark, secs, text):
    assert one(spark, K.hhmmss("x"), secs, "double") == text


def test_safe_text(spark):
    assert one(spark, K.safe_text("x"), None) == "-"
    assert one(spark, K.safe_text("x"), "  ") == "-"
    assert one(spark, K.safe_text("x"), " ok ") == "ok"


def test_round_half_away_from_zero_on_decimals(spark):
    df = spark.createDataFrame([("2.5",), ("-2.5",), ("1.0005",)], "x string")
    got = [r[0] for r in df.select(K.round_amount(F.col("x"), 0)).collect()]
    assert [float(g) for g in got] == [3.0, -3.0, 1.0]


@pytest.mark.parametrize(
    "raw,norm",
    [
        ("DOC Compra", "DOC_COMPRA"),
        ("Situação Geral (%)", "SITUACAO_GERAL_PERC"),
        ("Qtde-Líquida/NF", "QTDE_LIQUIDA_NF"),
        ("Número.Cockpit", "NUMERO_COCKPIT"),
        ("CTR_DESCRIÇÃO_ITEM", "CTR_DESCRICAO_ITEM"),
        ("Endereço\\Caminho", "ENDERECO_CAMINHO"),
        ("  id ", "ID"),
    ],
)
def test_normalize_column_name(raw, norm):
    assert normalize_column_name(raw) == norm


def test_dynamic_type_mapping(spark):
    df = spark.createDataFrame([(1, 1.5, True, dt.datetime(2026, 1, 1), "a")], "a int, b double, c boolean, d timestamp, e string")
    types = [f.dataType for f in inferred_schema(df).fields]
    assert types == [T.LongType(), T.DecimalType(18, 6), T.BooleanType(), T.TimestampType(), T.StringType()]


def test_registry_order_and_lookup():
    names = [p.process_name for p in active_processes()]
    assert names == [p.process_name for p in DEFAULT_PROCESSES]
    assert len(names) == 5
    assert get_process("V2_Consulta_Comp_CTR_S_FIXACAO").statuses == ("12", "13", "9")
    with pytest.raises(KeyError):
        get_process("nope")


def test_parse_years():
    assert parse_years("2025,2026") == (2025, 2026)
    assert parse_years(" 2024 , x, 20a5") == (2024,)
    assert parse_years("", today=dt.date(2030, 5, 1)) == (2030,)


def test_save_strategy_precedence():
    assert save_strategy(True, True) == "DROP_CREATE"
    assert save_strategy(False, True) == "TRUNCATE"
    assert save_strategy(False, False) == "APPEND"


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.5, "b")], "v double, s string")
    assert [tuple(r) for r in K.nan_to_null(df).collect()] == [(None, "a"), (1.5, "b")]
