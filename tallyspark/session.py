"""Spark session helpers.

Everything in the library takes a ``SparkSession``; this module only builds
one with sane defaults for tests / bench and resolves the shared checkpoint
folder.  On a cluster the session is created by the platform and the
settings below are left as they are.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the reconcile plans.  AQE re-plans joins at
# runtime (broadcast when a side turns out small, split skewed partitions
# of hot tax ids), and the runtime bloom filter prunes the invoice scan by
# the tax keys that actually occur in the ledger side.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tallyspark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and bench (the cluster brings its own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    (local tests) a fresh scratch folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if conf_dir:
        if current is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tallyspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


SCOPE_KEY = "tallyspark.stage.scope"


@contextmanager
def stage_scope(spark: SparkSession, name: str = "stage", keep: bool = False):
    """Intermediate tables written by :func:`cut_lineage` inside the block go
    to one folder under the checkpoint folder; it is removed at the end
    unless ``keep`` (use it around work whose results are written out, as
    the cycle does; lazy frames returned out of the block must not depend
    on the stage tables)."""
    scope = f"{name}-{uuid.uuid4().hex}"
    previous = spark.conf.get(SCOPE_KEY, None)
    spark.conf.set(SCOPE_KEY, scope)
    try:
        yield scope
    finally:
        if previous is None:
            spark.conf.unset(SCOPE_KEY)
        else:
            spark.conf.set(SCOPE_KEY, previous)
        if not keep:
            folder = f"{checkpoint_dir(spark).rstrip('/')}/tables/{scope}"
            jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
            fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
            if fs.exists(jpath):
                fs.delete(jpath, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the frame once as a parquet table under the shared checkpoint
    folder and read it back.

    This cuts the lineage (later stages and task retries after an executor
    loss read the written rows instead of recomputing the joins), runs the
    plan exactly once (an RDD checkpoint without caching runs it twice),
    and gives every consumer parquet column pruning and filter pushdown.
    """
    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    scope = spark.conf.get(SCOPE_KEY, None)
    base = f"{root}/tables/{scope}" if scope else f"{root}/tables"
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)  # written once, read soon: size counts
    return spark.read.schema(df.schema).parquet(path)
