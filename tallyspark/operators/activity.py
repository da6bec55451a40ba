"""Bot activity metrics (C13) and run guards.

Activity records carry a status, the bot file id, the runner user id and
the bot's repository path.  Buckets, departments and counts are column
expressions plus one aggregate; the guards are a semi/anti join against a
short ordered id list given by the caller (bounded by configuration).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: status buckets ---------------------------------------------
RUNNING_STATUSES = ["RUNNING", "RUN_PAUSED", "UPDATE", "STARTED"]
WAITING_STATUSES = ["QUEUED", "PENDING_EXECUTION", "DEPLOYED"]
FAILED_STATUSES = [
    "RUN_FAILED", "RUN_TIMED_OUT", "RUN_ABORTED", "FAILED", "PENDING_FAILURE", "DEPLOY_FAILED",
    "FAILED_TO_DEPLOY",
]
COMPLETED_STATUSES = ["RUN_COMPLETED", "COMPLETED"]
KNOWN_STATUSES = RUNNING_STATUSES + WAITING_STATUSES + FAILED_STATUSES + COMPLETED_STATUSES
BUCKETS = ["RUNNING", "WAITING", "FAILED", "COMPLETED", "OTHER"]
# statuses that mean "this bot / runner is busy" (note: no UPDATE here)
ACTIVE_STATUSES = ["RUNNING", "RUN_PAUSED", "STARTED", "QUEUED", "PENDING_EXECUTION", "DEPLOYED"]
DEPARTMENT_ANCHOR = "Bots"


def bucket(status: Column) -> Column:
    """SF12: status -> bucket, case-insensitive; missing/unknown -> OTHER."""
    s = F.upper(status)
    return (
        F.when(status.isNull() | (status == ""), F.lit("OTHER"))
        .when(s.isin(*RUNNING_STATUSES), F.lit("RUNNING"))
        .when(s.isin(*WAITING_STATUSES), F.lit("WAITING"))
        .when(s.isin(*FAILED_STATUSES), F.lit("FAILED"))
        .when(s.isin(*COMPLETED_STATUSES), F.lit("COMPLETED"))
        .otherwise(F.lit("OTHER"))
    )


def department(path: Column) -> Column:
    """SF13: the path element right after 'Bots' ('/' or '\\' separators);
    NULL when there is none."""
    parts = F.filter(F.split(F.translate(path, "/", "\\"), r"\\"), lambda x: x != "")
    idx = F.array_position(parts, DEPARTMENT_ANCHOR)
    return F.when(
        path.isNotNull() & (path != "") & (idx > 0),
        F.try_element_at(parts, (idx + 1).cast("int")),
    )


def clamp_pct(c: Column) -> Column:
    """SF14: percentage rounded to one place (half-even) and held in [0, 100];
    NULL stays NULL (``least`` and ``greatest`` skip NULLs)."""
    held = F.least(F.greatest(F.bround(c.cast("double"), 1), F.lit(0.0)), F.lit(100.0))
    return F.when(c.isNotNull(), held)


def bucket_counts(activities: DataFrame, by: Sequence[str] = ("fileId",)) -> DataFrame:
    """G-A11: zero-filled counts per bucket plus TOTAL, per group and for all
    groups (group columns 'ALL'), with the completed share."""
    b = bucket(F.col("status"))
    aggs = [F.count_if(b == k).alias(k) for k in BUCKETS] + [F.count(F.lit(1)).alias("TOTAL")]
    per = activities.groupBy(*by).agg(*aggs)
    overall = activities.agg(*aggs).select(*[F.lit("ALL").alias(c) for c in by], *BUCKETS, "TOTAL")
    out = per.unionByName(overall)
    return out.withColumn("pct_completed", clamp_pct(F.coalesce(F.try_divide(F.col("COMPLETED") * 100.0, F.col("TOTAL")), F.lit(0.0))))


def department_counts(activities: DataFrame) -> DataFrame:
    return activities.groupBy(department(F.col("path")).alias("department")).agg(
        F.count(F.lit(1)).alias("n")
    )


def unknown_statuses(activities: DataFrame) -> DataFrame:
    """G-A12: distinct statuses that would fall into OTHER unnoticed."""
    s = F.col("status")
    return activities.where(s.isNotNull() & (s != "") & ~F.upper(s).isin(*KNOWN_STATUSES)).select(
        s.alias("status")
    ).distinct()


def _ordered_ids(spark: SparkSession, ids: Sequence, name: str) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()), T.StructField("pref", T.IntegerType())])
    return spark.createDataFrame([(str(v), i) for i, v in enumerate(ids)], schema)


def guard(activities: DataFrame, file_ids: Sequence) -> DataFrame:
    """C14: the first file id (in the given order) that has an active run;
    no row when every bot is idle.  The id list is broadcast (its size is
    the caller's configuration), the activity side is only filtered."""
    ids = _ordered_ids(activities.sparkSession, file_ids, "fileId")
    busy = (
        activities.where(F.col("status").isin(*ACTIVE_STATUSES))
        .join(F.broadcast(ids), "fileId", "inner")
        .groupBy("fileId")
        .agg(F.min("pref").alias("pref"))
    )
    return busy.agg(F.min_by("fileId", "pref").alias("fileId"), F.min("pref").alias("pref")).where(
        F.col("fileId").isNotNull()
    )


def pick_runner(activities: DataFrame, candidate_ids: Sequence) -> DataFrame:
    """The first candidate runner (in preference order) without an
    active run; no row when all are busy."""
    ids = _ordered_ids(activities.sparkSession, candidate_ids, "runAsUserId")
    busy = (
        activities.where(F.col("status").isin(*ACTIVE_STATUSES))
        .join(F.broadcast(ids), "runAsUserId", "left_semi")
        .select("runAsUserId")
        .distinct()
    )
    free = ids.join(F.broadcast(busy), "runAsUserId", "left_anti")  # busy has at most len(ids) rows
    return free.agg(F.min_by("runAsUserId", "pref").alias("runAsUserId"), F.min("pref").alias("pref")).where(
        F.col("runAsUserId").isNotNull()
    )
