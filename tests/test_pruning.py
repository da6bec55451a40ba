"""The emission years reach the scan, as a text range and as folders."""

from __future__ import annotations

import os
from dataclasses import replace

import erp_fixture as fx
from pyspark.sql import functions as F

from tallyspark.functions.keys import parse_ymd, ymd_year_in
from tallyspark.operators.match import open_invoices
from tallyspark.operators.reconcile import reconcile
from tallyspark.schemas import ERP_SCHEMAS
from tallyspark.sources.layout import read_stored_invoices, store_invoices
from tallyspark.sources.readers import read_location

DATES = ["20260101", "20261231", "20251231", "20270101", "00000000", "", None, "2026010", "202601011", " 20260101", "20260101 ",
         "20261301", "-20260101", "+20260101", "2026-01-01", "20260230", "19991231", "99991231", "２０２６0101", "20260101x"]


def plan(df):
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "4000")  # else the list of pushed filters is cut
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")


def test_the_text_range_takes_nothing_away(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d string")
    for years in ([2026], [2025, 2027], [1999, 9999], [], [12026], [0, 2026]):
        want = df.where(F.year(parse_ymd("d")).isin(*years))
        got = df.where(ymd_year_in("d", years))
        key = lambda x: sorted(str(r.d) for r in x.collect())
        assert key(got) == key(want), years


def test_the_years_are_pushed_to_the_invoice_scan(spark, tmp_out):
    _, erp = fx.build(spark)
    erp.xml_rec.write.parquet(f"{tmp_out}/xml")
    stored = replace(erp, xml_rec=read_location(spark, f"{tmp_out}/xml", ERP_SCHEMAS["xml_rec"]))
    p = plan(open_invoices(stored, [2025, 2026]))
    assert "GreaterThanOrEqual(D_EMI,20250101)" in p and "LessThanOrEqual(D_EMI,20261231)" in p


def test_other_years_are_not_read(spark, tmp_out):
    years = {2024: "20240301", 2025: "20250301", 2026: "20260301"}
    xml = [fx.invoice(f"Y{y}-{i}", "12345678", 19205.0, d_emi=d, nfnum=f"{i:09d}") for y, d in years.items() for i in range(20)]
    xml += [fx.invoice("bad", "12345678", 1.0, d_emi="00000000")]
    _, erp = fx.build(spark, xml_rec=xml, nfeit=[fx.item(x[0], 7682.0) for x in xml])
    store_invoices(erp.xml_rec, f"{tmp_out}/xml", files_per_year=3)
    folders = sorted(f for f in os.listdir(f"{tmp_out}/xml") if "=" in f)
    assert folders == [f"EMISSION_YEAR={y}" for y in (0, 2024, 2025, 2026)]
    assert 1 <= len([f for f in os.listdir(f"{tmp_out}/xml/EMISSION_YEAR=2025") if f.endswith(".parquet")]) <= 3
    stored = replace(erp, xml_rec=read_stored_invoices(spark, f"{tmp_out}/xml"))
    inv = open_invoices(stored, [2025])
    assert "PartitionFilters: [isnotnull(EMISSION_YEAR" in plan(inv) or "EMISSION_YEAR#" in plan(inv).split("PartitionFilters")[1][:120]
    # were another year's files read, these would fail the query
    for y in (0, 2024, 2026):
        folder = f"{tmp_out}/xml/EMISSION_YEAR={y}"
        for name in os.listdir(folder):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"not parquet")
    assert inv.count() == 20
    assert {r.VTIN_DT_EMISSAO for r in inv.collect()} == {"20250301"}


def test_reconcile_over_stored_invoices_equals_the_plain_tables(spark, tmp_out):
    q, erp = fx.build(spark)
    store_invoices(erp.xml_rec, f"{tmp_out}/xml")
    stored = replace(erp, xml_rec=read_stored_invoices(spark, f"{tmp_out}/xml"))
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert key(reconcile(q, stored, [2026])) == key(reconcile(q, erp, [2026]))


def test_blank_numbers_on_both_sides_are_joined(spark):
    """An active NF-e without a number meets every document without one, and
    keeps its invoice where there is none."""
    xml = fx.GOLDEN["xml_rec"]
    active = [fx.active_for(xml[0], ""), fx.active_for(xml[1], "D7")]
    docs = [("", "B1", "2026", "1", fx.D(1), fx.D(10), "U"), ("", "B2", "2026", "1", fx.D(2), fx.D(20), "V"), ("D7", "B3", "2026", "1", fx.D(3), fx.D(30), "W")]
    for nfdoc, want in ((docs, [(None, None), ("U", "1.000000"), ("V", "2.000000")]), (docs[2:], [(None, None), (None, None)])):
        _, erp = fx.build(spark, nfe_active=active, nfdoc=nfdoc)
        got = open_invoices(erp, [2026]).select("CRENAM", F.col("PESO_LIQUIDO").cast("string").alias("p")).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
