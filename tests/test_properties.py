"""Column helpers against brute-force Python statements of the row rules,
on generated strings (each example is one DataFrame of many values)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.functions import keys as K
from tallyspark.operators.activity import (
    COMPLETED_STATUSES,
    FAILED_STATUSES,
    RUNNING_STATUSES,
    WAITING_STATUSES,
    bucket,
    department,
)

ALPHABET = st.sampled_from(list("0012 \t|ab"))
TEXTS = st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=12)), min_size=1, max_size=40)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def run(spark, col, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(col.alias("r")).collect()]


@SETTINGS
@given(values=TEXTS)
def test_zero_strip_and_zfill(spark, values):
    assert run(spark, K.ltrim0_or_empty("x"), values) == [(v or "").lstrip("0") for v in values]
    assert run(spark, K.zfill10("x"), values) == [None if v is None else v.zfill(10) for v in values]


@SETTINGS
@given(values=TEXTS)
def test_strip_and_blank(spark, values):
    assert run(spark, K.strip_ws("x"), values) == [None if v is None else v.strip() for v in values]
    assert run(spark, K.is_blank("x"), values) == [v is None or v.strip() == "" for v in values]


@SETTINGS
@given(values=TEXTS)
def test_audit_cockpit_split(spark, values):
    def py(v):
        parts = [c.strip() for c in (v or "").split("|") if c.strip()]
        return parts or [""]

    assert run(spark, K.split_cockpits_keep_empty("x"), values) == [py(v) for v in values]


@SETTINGS
@given(values=TEXTS)
def test_queue_cockpit_split_is_distinct_trimmed(spark, values):
    def py(v):
        out = []
        for c in (v or "").split("|"):
            c = c.strip(" ")
            if c and c not in out:
                out.append(c)
        return out

    assert run(spark, K.split_cockpits("x"), values) == [py(v) for v in values]


@SETTINGS
@given(values=TEXTS)
def test_filled_docnum(spark, values):
    assert run(spark, K.nonblank_docnum("x"), values) == [bool(v and v.strip("0").strip()) for v in values]


PATH_PARTS = st.sampled_from(["Bots", "bots", "Fiscal", "Compras", "", "x y"])


@SETTINGS
@given(paths=st.lists(st.one_of(st.none(), st.lists(PATH_PARTS, max_size=5).flatmap(
    lambda parts: st.sampled_from(["/", "\\"]).map(lambda sep: sep.join(parts)))), min_size=1, max_size=30))
def test_department(spark, paths):
    def py(path):
        if not path:
            return None
        parts = [p for p in path.replace("/", "\\").split("\\") if p]
        if "Bots" not in parts:
            return None
        i = parts.index("Bots")
        return parts[i + 1] if i + 1 < len(parts) else None

    assert run(spark, department(F.col("x")), paths) == [py(p) for p in paths]


STATUSES = st.sampled_from(RUNNING_STATUSES + WAITING_STATUSES + FAILED_STATUSES + COMPLETED_STATUSES
                           + ["running", "Queued", "NEW", ""])


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), STATUSES), min_size=1, max_size=30))
def test_bucket(spark, values):
    def py(s):
        if not s:
            return "OTHER"
        u = s.upper()
        for name, group in (("RUNNING", RUNNING_STATUSES), ("WAITING", WAITING_STATUSES),
                            ("FAILED", FAILED_STATUSES), ("COMPLETED", COMPLETED_STATUSES)):
            if u in group:
                return name
        return "OTHER"

    assert run(spark, bucket(F.col("x")), values) == [py(v) for v in values]
