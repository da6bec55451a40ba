"""Plan shape: no nested-loop / cartesian joins, no Python on the data
path, filters and column pruning reaching the parquet scans."""

from __future__ import annotations

from tallyspark.operators.audit import audit_booked, audit_items
from tallyspark.operators.match import match_value_complement, match_via_document, match_via_tax_id, open_invoices
from tallyspark.operators.queues import expand_queues
from tallyspark.operators.reconcile import prepare, reconcile
from tallyspark.sources.testdata import erp_tables, queue_tables

YEARS = (1996, 1997, 1998, 1999, 2000)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_clean(df):
    p = plan_of(df)
    for bad in FORBIDDEN:
        assert bad not in p, f"{bad} in plan:\n{p}"
    return p


def test_reconcile_and_routes_are_equi_joins(spark, small_dir):
    q, erp = queue_tables(spark, small_dir), erp_tables(spark, small_dir)
    assert_clean(reconcile(q, erp, YEARS, materialize=False))
    hc, inv = prepare(expand_queues(q), erp, YEARS, materialize=False)
    for df in (match_via_document(hc, erp, YEARS), match_via_tax_id(hc, erp, YEARS, inv),
               match_value_complement(hc, erp, YEARS, inv)):
        assert_clean(df)


def test_tax_route_value_rule_is_a_join_key(spark, small_dir):
    q, erp = queue_tables(spark, small_dir), erp_tables(spark, small_dir)
    hc, inv = prepare(expand_queues(q), erp, YEARS, materialize=False)
    p = plan_of(match_via_tax_id(hc, erp, YEARS, inv))
    # three keys (tax id, quantity, value) and no OR left as a join condition
    assert "_val_key" in p and " OR " not in p.split("Join")[1][:400]


def test_eligibility_and_upsert_plans_clean(spark, small_dir):
    from tallyspark.operators.reconcile import eligible
    from tallyspark.operators.upsert import dedup_last, upsert

    q, erp = queue_tables(spark, small_dir), erp_tables(spark, small_dir)
    rec = reconcile(q, erp, YEARS, materialize=False)
    p = assert_clean(eligible(rec, "reference"))
    assert "BroadcastHashJoin" in p
    assert_clean(upsert(dedup_last(eligible(rec, "strict")), eligible(rec, "reference")))


def test_audit_plan_clean(spark, small_dir):
    q, erp = queue_tables(spark, small_dir), erp_tables(spark, small_dir)
    assert_clean(audit_booked(audit_items(q), erp, 1998))


def test_queue_scan_pushes_filter_and_prunes_columns(spark, small_dir):
    q = queue_tables(spark, small_dir)
    p = plan_of(expand_queues(q))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p
    assert "o_totalprice" not in p  # the queue value column is not needed by the scan


def test_invoice_scan_prunes_columns(spark, small_dir):
    erp = erp_tables(spark, small_dir)
    p = plan_of(open_invoices(erp, YEARS))
    assert "l_discount" not in p and "l_tax" not in p
