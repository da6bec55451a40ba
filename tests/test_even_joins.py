"""A key that holds a third of both sides is dealt over cells."""

from __future__ import annotations

import random

import erp_fixture as fx
from pyspark.sql import functions as F

from tallyspark.operators.audit import audit_booked, audit_items
from tallyspark.operators.reconcile import reconcile
from tallyspark.operators.skew import CellBudget, even_join, frequent_keys, hot_grid
from tallyspark.sources.registry import DEFAULT_PROCESSES, with_active

BUDGET = CellBudget(rows=100, pairs=2000)


def sides(spark):
    """Two tables whose key (7, 'x') holds a third of the rows; one key is hot
    on the left alone, NULL keys join nothing."""
    rng = random.Random(1)
    left = [(i, 7, "x") for i in range(300)] + [(i, 8, "y") for i in range(300, 700)] + [
        (i, rng.randrange(20), rng.choice("xyz")) for i in range(700, 900)] + [(i, None, "x") for i in range(900, 1000)]
    right = [(i, 7, "x") for i in range(200)] + [(200, 8, "y"), (201, 8, "y")] + [
        (i, rng.randrange(20), rng.choice("xyz")) for i in range(202, 400)] + [(i, 7, None) for i in range(400, 600)]
    return (spark.createDataFrame(left, "l long, a int, b string").repartition(6),
            spark.createDataFrame(right, "r long, c int, d string").repartition(5))


def test_grid_is_bounded_and_small_keys_are_left_alone():
    for left, right in ((1, 1), (99, 20), (300, 200), (10**9, 3), (3, 10**9), (10**6, 10**6)):
        a, b = BUDGET.grid(left, right)
        assert -(-left // a) <= BUDGET.rows and -(-left // a) * -(-right // b) <= BUDGET.pairs
    assert BUDGET.grid(50, 40) == (1, 1)


def test_frequent_keys_come_from_a_bounded_sketch(spark):
    left, _ = sides(spark)
    top = frequent_keys(left, ["a", "b"])
    assert len(top) <= 1000 and frequent_keys(left.limit(0), ["a", "b"]) == []
    known = {r.h for r in left.where("a IN (7, 8)").select(F.xxhash64("a", "b").alias("h")).distinct().collect()}
    assert known <= set(top)


def test_even_join_gives_the_pairs_of_a_join_in_bounded_cells(spark):
    left, right = sides(spark)
    assert len(hot_grid(left, right, ["a", "b"], ["c", "d"], BUDGET)) == 2
    condition = F.col("l") % 5 != F.col("r") % 5
    got = even_join(left, right, ["a", "b"], ["c", "d"], ["l"], ["r"], BUDGET, condition)
    want = left.join(right, (F.col("a") == F.col("c")) & (F.col("b") == F.col("d")) & condition)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(map(tuple, want.collect()), key=str) and len(rows) > 40000
    # no task holds much more than its share of the hot key's pairs
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = even_join(left, right, ["a", "b"], ["c", "d"], ["l"], ["r"], BUDGET)
        dealt = got.where("a = 7 AND b = 'x'").groupBy(F.spark_partition_id()).count()
        per_task = [r["count"] for r in dealt.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) >= 60000 and max(per_task) <= 0.25 * sum(per_task)


def test_without_hot_keys_the_join_is_plain(spark):
    left, right = sides(spark)
    got = even_join(left, right, ["a", "b"], ["c", "d"], ["l"], ["r"], CellBudget())
    assert got.columns == ["l", "a", "b", "r", "c", "d"]


def hot_tables(n):
    """One (tax id, quantity, value) with a third of hits and invoices."""
    docs = [f"45{i:08d}" for i in range(n)]
    hot = [i % 3 == 0 for i in range(n)]
    return {
        "queues": {fx.FIXO: [fx.qrow(i, "12", d, "1") for i, d in enumerate(docs)], fx.VALOR: [fx.vrow(i, "01", d, "1") for i, d in enumerate(docs)]},
        "zmmt0022": [fx.ledger(d, "1", 5.0 if h else i, 10.0 if h else i) for i, (d, h) in enumerate(zip(docs, hot, strict=True))],
        "ekko": [("300", "1000", d, "K", "P1" if h else "P2") for d, h in zip(docs, hot, strict=True)],
        "ekpo": [("300", d, "M1") for d in docs],
        "bp_fiscal": [("P1", "A", "111", "IE", "A"), ("P2", "B", "222", "IE", "B")],
        "xml_rec": [fx.invoice(f"X{i}", "111" if h else "222", 10.0 if h else i, nfnum=f"{i:09d}") for i, h in enumerate(hot)],
        "nfeit": [fx.item(f"X{i}", 5.0 if h else i) for i, h in enumerate(hot)],
    }


def test_reconcile_with_a_hot_tax_id_equals_the_plain_plan(spark):
    t = hot_tables(45)
    q, erp = fx.build(spark, **t)
    ps = with_active(DEFAULT_PROCESSES, [fx.FIXO, fx.VALOR])
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    plain = key(reconcile(q, erp, [2026], ps, materialize=False))
    even = key(reconcile(q, erp, [2026], ps, budget=CellBudget(rows=5, pairs=20)))
    assert even == plain and len(plain) >= 2 * 15 * 15


def test_audit_counts_all_invoices_of_a_hot_value(spark):
    t = hot_tables(45)
    t["queues"] = {fx.FIXO: [fx.qrow(i, "15", f"45{i:08d}", "1") for i in range(45)]}
    q, erp = fx.build(spark, **t)
    got = audit_booked(audit_items(q), erp, 2026).collect()
    assert [r.n_match_oficial for r in sorted(got, key=lambda r: r.qid) if r.qid % 3 == 0] == [15] * 15
