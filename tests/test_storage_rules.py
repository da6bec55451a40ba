"""Rules of sinks, queues and counts that hold outside the sample data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.names import normalize_column_name
from tallyspark.operators.activity import BUCKETS, bucket_counts, clamp_pct
from tallyspark.operators.audit import CLASSES, audit_distribution
from tallyspark.operators.queues import expand_queues
from tallyspark.schemas import RESULT_SCHEMA, UPSERT_KEYS
from tallyspark.sinks.writers import APPEND, save_to_targets, upsert_path


def result_rows(spark, ids, **extra):
    base = spark.createDataFrame([(str(i),) for i in ids], "ID string")
    cols = [F.col("ID") if f.name == "ID" else F.lit("k" if f.name in UPSERT_KEYS else None).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA]
    return base.select(*cols, *[F.lit(v).alias(k) for k, v in extra.items()])


def test_append_reaches_each_target_once(spark, tmp_out):
    targets = [f"{tmp_out}/dev", f"{tmp_out}/prod"]
    for i in (1, 2):
        save_to_targets(result_rows(spark, [i]), targets, APPEND)
    for t in targets:
        assert spark.read.parquet(t).count() == 2


def test_upsert_keeps_columns_outside_the_schema_and_adds_missing_keys(spark, tmp_out):
    first = upsert_path(spark, None, result_rows(spark, [1], NOTE="a"), tmp_out)
    assert [r.NOTE for r in spark.read.parquet(first).collect()] == ["a"]
    lacking = result_rows(spark, [2]).drop(UPSERT_KEYS[-1])
    second = spark.read.parquet(upsert_path(spark, first, lacking, tmp_out))
    assert "NOTE" in second.columns and second.filter("NOTE = 'a'").count() == 1


def test_missing_queue_raises(spark):
    with pytest.raises(ValueError, match="without a queue"):
        expand_queues({})


def test_counts_of_nothing(spark):
    assert spark.range(1).select(clamp_pct(F.lit(None).cast("double")).alias("p")).first().p is None
    row = bucket_counts(spark.createDataFrame([], "status string, fileId string")).first()
    assert [row[b] for b in BUCKETS] == [0] * len(BUCKETS) and row.pct_completed == 0.0


def test_distribution_has_every_process(spark):
    out = audit_distribution(spark.createDataFrame([], "proc string, doc_compra string, classe string"), ["A", "B"]).collect()
    assert {r.proc for r in out} == {"A", "B", "TOTAL"}
    assert all(r.itens == 0 and r[CLASSES[0].lower()] == 0 and r.pct_escriturado == "0%" for r in out)


@pytest.mark.parametrize("raw, name", [(" Preço (R$) ", "PRECO_R$"), ("a-b/c.d", "A_B_C_D"), ("% é\\x", "PERC_E_X")])
def test_column_names(raw, name):
    assert normalize_column_name(raw) == name
