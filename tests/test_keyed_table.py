"""The bucketed result table - untouched files, names, versions."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.upsert import dedup_last, upsert
from tallyspark.schemas import RESULT_SCHEMA
from tallyspark.sinks import keyed_table
from tallyspark.sinks.keyed_table import KeyedTable, StaleVersion


def rows(spark, keys, **cols):
    """Result rows by (DOC_COMPRA, ID), other columns constant."""
    base = {"PROCESS_NAME": "P", "STATUS_EXECUCAO": "SUCESSO", "N_CONTRATO": "C", "NUMERO_COCKPIT": "1", "DOCNUM": None, **cols}
    data = [(i, doc, *base.values()) for doc, i in keys]
    return spark.createDataFrame(data, "ID long, DOC_COMPRA string, " + ", ".join(f"{c} string" for c in base))


def content(df):
    cols = sorted(df.columns)
    return sorted(str([r[c] for c in cols]) for r in df.collect())


def files(root):
    out = {}
    for folder, _, names in os.walk(f"{root}/data"):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(folder, n)
                out[path] = os.stat(path).st_mtime_ns
    return out


def test_only_touched_buckets_are_rewritten(spark, tmp_out):
    table = KeyedTable(spark, tmp_out, buckets=8)
    table.merge(rows(spark, [(f"D{i}", i) for i in range(200)]))
    first, before = table.manifest(), files(tmp_out)
    second = table.merge(rows(spark, [("D5", 999)], MSG_RPA="new"))
    changed = {b for b in first.folders if first.folders[b] != second.folders[b]}
    assert len(changed) == 1 and len(first.folders) == 8
    after = files(tmp_out)
    assert {p: t for p, t in after.items() if p in before} == before  # nothing is overwritten
    assert all(second.folders[b] in p for p in set(after) - set(before) for b in changed)
    got = {r.DOC_COMPRA: (r.ID, r.MSG_RPA) for r in table.read().collect()}
    assert len(got) == 200 and got["D5"] == (999, "new") and got["D6"] == (6, None)
    # the version before is still there
    assert {r.ID for r in table.read(1).collect()} == set(range(200))


def test_merge_equals_the_upsert_of_whole_frames(spark, tmp_out):
    rng = random.Random(2)
    table, plain = KeyedTable(spark, tmp_out, buckets=5), spark.createDataFrame([], RESULT_SCHEMA)
    for k in range(3):
        keys = [(f"D{rng.randrange(30)}", rng.randrange(100)) for _ in range(25)]
        batch = rows(spark, sorted(set(keys)), **({"MSG_RPA": f"v{k}"} if k % 2 else {}))
        table.merge(batch)
        plain = upsert(plain, batch)
    assert content(table.read()) == content(plain.select(*RESULT_SCHEMA.names))


def test_lower_case_columns_apply_and_unknown_ones_stay(spark, tmp_out):
    table = KeyedTable(spark, tmp_out, buckets=4)
    table.merge(rows(spark, [("A", 1), ("B", 2)], MSG_RPA="old"))
    batch = rows(spark, [("A", 1)], MSG_RPA="new", note="n")
    table.merge(batch.select(*[F.col(c).alias(c.lower()) for c in batch.columns]))
    got = {r.DOC_COMPRA: (r.MSG_RPA, r.NOTE) for r in table.read().collect()}
    assert got == {"A": ("new", "n"), "B": ("old", None)}
    with pytest.raises(ValueError, match="collide"):
        table.merge(batch.withColumn("NOTE2", F.lit("x")).toDF(*[c if c != "NOTE2" else "note2" for c in [*batch.columns, "NOTE2"]]).selectExpr("*", "'y' AS Note3", "'z' AS nOTE3"))
    assert len(table.versions()) == 2


def test_upsert_of_frames_knows_names_in_any_case(spark):
    target = rows(spark, [("A", 1)], MSG_RPA="old")
    batch = rows(spark, [("A", 1)], MSG_RPA="new").withColumnRenamed("MSG_RPA", "msg_rpa")
    assert [r.MSG_RPA for r in upsert(target, batch).collect()] == ["new"]


def test_last_row_wins_whatever_the_order_of_the_merges(spark, tmp_out):
    rng = random.Random(4)
    batches = [rows(spark, [(f"D{rng.randrange(8)}", rng.randrange(100)) for _ in range(15)]) for _ in range(3)]
    want = content(dedup_last(batches[0].union(batches[1]).union(batches[2])))
    for k, order in enumerate(([0, 1, 2], [2, 0, 1])):
        table = KeyedTable(spark, f"{tmp_out}/{k}", buckets=3)
        for b in order:
            table.merge(batches[b], prefer="last")
        got = table.read().select(*batches[0].columns)
        assert content(got) == want


def test_a_merge_that_dies_leaves_the_last_version(spark, tmp_out, monkeypatch):
    table = KeyedTable(spark, tmp_out, buckets=4)
    table.merge(rows(spark, [("A", 1)]))

    def dies(self, m):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed_table.KeyedTable, "_publish", dies)
        with pytest.raises(RuntimeError, match="lost"):
            table.merge(rows(spark, [("A", 2)]))
    assert [r.ID for r in KeyedTable(spark, tmp_out).read().collect()] == [1]
    table.merge(rows(spark, [("A", 3)]))
    assert [r.ID for r in table.read().collect()] == [3] and table.versions() == [1, 2]


def test_the_second_of_two_merges_from_one_version_is_refused(spark, tmp_out, monkeypatch):
    table = KeyedTable(spark, tmp_out, buckets=4)
    table.merge(rows(spark, [("A", 1)]))
    stale = table.manifest()
    table.merge(rows(spark, [("A", 2)]))
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "manifest", lambda self, version=None: stale)
        with pytest.raises(StaleVersion):
            table.merge(rows(spark, [("A", 9)]))
    assert [r.ID for r in table.read().collect()] == [2]
    # a claim without a manifest: refused until recovered
    open(f"{tmp_out}/_manifest/.0000000003.claim", "w").close()
    with pytest.raises(StaleVersion):
        table.merge(rows(spark, [("A", 9)]))
    table.recover()
    assert table.merge(rows(spark, [("A", 9)])).version == 3


def test_empty_batches_null_keys_and_vacuum(spark, tmp_out):
    table = KeyedTable(spark, tmp_out, buckets=4)
    assert table.read().count() == 0 and table.read().columns == RESULT_SCHEMA.names
    table.merge(spark.createDataFrame([], RESULT_SCHEMA))
    assert table.versions() == [1] and table.read().count() == 0
    table.merge(rows(spark, [(None, 1), (None, 2), ("", 3)]))  # a null part counts as empty
    assert [r.ID for r in table.read().collect()] == [3]
    table.merge(rows(spark, [("A", 4)], PROCESS_NAME=None))
    table.merge(rows(spark, [("A", 4)], PROCESS_NAME=None))  # no key: rows never collide
    assert table.read().where("PROCESS_NAME IS NULL").count() == 2
    before = content(table.read())
    assert table.vacuum(keep=1) and content(table.read()) == before and len(table.versions()) == 1
