"""ST1: one stream over all queues, keyed state and deltas."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import erp_fixture as fx
from tallyspark.operators.reconcile import eligible, reconcile
from tallyspark.operators.upsert import dedup_last
from tallyspark.schemas import RESULT_COLUMNS
from tallyspark.sinks.keyed_table import KeyedTable
from tallyspark.streaming import cycle_stream
from tallyspark.streaming.cycle_stream import advance, delta, fold, land, last_epoch, result, start_cycle_stream

QUEUES = {
    fx.FIXO: fx.GOLDEN["queues"][fx.FIXO] + [fx.qrow(None, "12", "4500451189", "123490")],
    fx.S_FIX: [fx.qrow(11, "9", "4500756534", "123492"), fx.qrow(12, "9", "9999999999", "1")],
    fx.C_FIX: [fx.qrow(21, "12", "9999999999", "1"), fx.qrow(22, "13", "9999999999", "2")],  # never matches
    fx.VALOR: [fx.vrow(31, "01", "4500756534", "123492"), fx.vrow(32, "01", "9999999999", "8")],
}


def content(df):
    return sorted(str(tuple(r)) for r in df.select(*RESULT_COLUMNS).collect())


def whole(q, erp):
    return content(dedup_last(eligible(reconcile(q, erp, [2026]))))


def pieces(landed, n, order):
    """The landed rows dealt over n parts, in an order of their ids."""
    rows = landed.orderBy(F.desc_nulls_first("id") if order == "descending" else F.asc_nulls_last("id")).collect()
    return [landed.sparkSession.createDataFrame(rows[k::n] or [], landed.schema) for k in range(n)]


@pytest.fixture(scope="module")
def want(spark):
    return whole(*fx.build(spark, queues=QUEUES))


@pytest.mark.parametrize("n, order", [(1, "ascending"), (2, "descending"), (2, "ascending")])
def test_result_does_not_depend_on_the_split(spark, tmp_out, want, n, order):
    q, erp = fx.build(spark, queues=QUEUES)
    for e, part in enumerate(pieces(land(q), n, order)):
        advance(spark, part, e, erp, [2026], tmp_out)
    assert last_epoch(spark, tmp_out) == n - 1
    assert content(result(spark, tmp_out)) == want and len(want) > 5


def test_pending_rows_are_released_once_when_their_process_matches(spark, tmp_out):
    q, erp = fx.build(spark, queues=QUEUES)
    landed = land(q)
    steps = [landed.where("id IN (12, 21)"), landed.where("id IN (11, 22)"), landed.where("id = 11")]
    for e, part in enumerate(steps):
        advance(spark, part, e, erp, [2026], tmp_out)
    ids = [sorted(r.ID for r in delta(spark, tmp_out, e, e).collect()) for e in range(3)]
    # 12 waits for 11; the process of 21 and 22 never matches
    assert ids == [[], [11, 12], [11]]
    assert {r[0] for r in spark.read.parquet(f"{tmp_out}/state/epoch=0000000001").collect()} == {fx.S_FIX}


def test_an_epoch_reads_no_earlier_delta_and_a_replay_changes_nothing(spark, tmp_out, want):
    q, erp = fx.build(spark, queues=QUEUES)
    first, second = pieces(land(q), 2, "ascending")
    advance(spark, first, 0, erp, [2026], tmp_out)
    # were the first epoch's rows read again, this would fail
    os.rename(f"{tmp_out}/delta/epoch=0000000000", f"{tmp_out}/aside")
    advance(spark, second, 1, erp, [2026], tmp_out)
    advance(spark, second, 1, erp, [2026], tmp_out)
    os.rename(f"{tmp_out}/aside", f"{tmp_out}/delta/epoch=0000000000")
    assert content(result(spark, tmp_out)) == want


def test_a_missing_state_raises(spark, tmp_out):
    q, erp = fx.build(spark, queues=QUEUES)
    with pytest.raises(ValueError, match="state of the epoch before 2"):
        advance(spark, land(q), 2, erp, [2026], tmp_out)


def test_stream_restarts_folds_and_refuses_another_stream(spark, tmp_out, want):
    q, erp = fx.build(spark, queues=QUEUES)
    landing, out = f"{tmp_out}/landing", f"{tmp_out}/result"
    table, go_on = KeyedTable(spark, f"{tmp_out}/table", buckets=4), 0
    for part in pieces(land(q), 2, "descending"):  # two runs of one stream
        part.write.mode("append").parquet(landing)
        start_cycle_stream(spark, landing, erp, [2026], out, checkpoint=f"{tmp_out}/ckpt").awaitTermination()
        go_on = fold(spark, out, table, go_on)
    assert last_epoch(spark, out) == 1 and go_on == 2 and len(table.versions()) == 2
    assert content(result(spark, out)) == content(table.read()) == want
    assert fold(spark, out, table, go_on) == 2  # nothing new
    other = start_cycle_stream(spark, landing, erp, [2026], out, checkpoint=f"{tmp_out}/other")
    with pytest.raises(Exception, match="another stream"):
        other.awaitTermination()
    assert content(result(spark, out)) == want


def test_no_epoch_gives_an_empty_result(spark, tmp_out):
    assert result(spark, tmp_out).count() == 0 and cycle_stream.last_epoch(spark, tmp_out) == -1
