"""Stateful streaming exact deduplication.

A streaming aggregation keyed by the SHA-256 digest keeps, in RocksDB state
without expiry, the stable identifier of the row that stays (the largest
doc_id), the number of copies and the content locator (hash of the file that
holds the kept row).  Hits, digests seen more than once, are then checked on
their full bytes: the smallest and the largest text of a digest must be the
same, both reduced map-side, so a hot text is one row per task.  Digests
that fail the check are grouped again by the text itself.

Only DataFrame operations and Structured Streaming run here.

Rows: null text counts as empty.  Rows that repeat a doc_id with the same
text each count as a copy and share the verdict.  A null doc_id sorts below
every other; if a group has no other, its keep_id is null and its rows stay.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# RocksDB on disk, small uploads, and no space set aside per state partition.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def digest_state(stream: DataFrame) -> DataFrame:
    """Streaming rows (digest, doc_id, locator) -> keyed state."""
    return stream.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"),
        F.count("*").alias("copies"),
        F.max_by("locator", "doc_id").alias("locator"),
    )


def run_state(rows: DataFrame, stages: Stages) -> DataFrame:
    """Feed the digest rows through the stateful stream until all are read;
    the state rows of the last epoch in which each digest changed."""
    spark = rows.sparkSession
    stages.write(rows, "digests")
    stream = spark.readStream.schema(rows.schema).parquet(stages.path("digests"))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{stages.path('state')}/e{epoch}")

    previous = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        query = (
            digest_state(stream)
            .writeStream.outputMode("update")
            .option("checkpointLocation", stages.path("stream"))
            .foreachBatch(keep)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in previous.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    kinds = "digest binary, keep_id long, copies long, locator long, epoch int"
    epochs = (query.lastProgress or {}).get("batchId", -1)
    if epochs < 0 or rows.sparkSession.read.parquet(stages.path("digests")).isEmpty():
        return spark.createDataFrame([], kinds).drop("epoch")
    state = spark.read.schema(kinds).parquet(f"{stages.path('state')}/*")
    if epochs == 0:
        return state.drop("epoch")
    last = F.max_by(F.struct("keep_id", "copies", "locator"), "epoch").alias("s")
    return state.groupBy("digest").agg(last).select("digest", "s.*")


def exact_dedup(docs: DataFrame, digest=None, stages: Stages | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256.  ``digest`` maps the text column to the state key (SHA-256
    unless a test asks for a weaker one)."""
    spark = docs.sparkSession
    stages = stages or Stages(spark, "exact_dedup")
    digest = digest or (lambda t: F.unhex(F.sha2(t, 256)))
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    rows = texts.select(
        digest(F.col("text")).alias("digest"),
        F.unhex(F.sha2("text", 256)).alias("sha"),
        "doc_id",
        F.xxhash64(F.input_file_name()).alias("locator"),
    )
    state = run_state(rows, stages)
    rows = spark.read.schema(rows.schema).parquet(stages.path("digests"))

    hits = stages.write(state.filter("copies > 1"), "hits")
    bad = rows.limit(0).select("digest")
    if not hits.isEmpty():
        hit_ids = rows.join(hits.select("digest"), "digest", "left_semi").select("doc_id").distinct()
        checked = (
            texts.join(hit_ids, texts.doc_id.eqNullSafe(hit_ids.doc_id), "left_semi")
            .groupBy(digest(F.col("text")).alias("digest"))
            .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        )
        bad = stages.write(checked.filter("low <> high").select("digest"), "bad")
    good = rows.join(state.select("digest", "keep_id", "copies"), "digest")
    if not bad.isEmpty():
        good = good.join(bad, "digest", "left_anti")
        clash = texts.withColumn("digest", digest(F.col("text"))).join(bad, "digest", "left_semi")
        groups = clash.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("copies"))
        again = clash.join(groups, "text").withColumn("sha", F.unhex(F.sha2("text", 256)))
        good = good.select("doc_id", "sha", "keep_id", "copies").union(again.select("doc_id", "sha", "keep_id", "copies"))
    return good.select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def keep_latest(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with all columns (of any
    name: a row travels as one column)."""
    judged = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("keep"), F.unhex("text_sha256").alias("sha")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col("doc_id").alias("id"), F.unhex(F.sha2(text_or_empty(), 256)).alias("own"))
    same = (F.col("own") == F.col("sha")) & F.col("id").eqNullSafe(F.col("keep"))
    return rows.join(judged, same, "left_semi").dropDuplicates(["id", "own"]).select("whole.*")
