"""Queue scans (S1, S2), the cockpit explode into work items and the identity
of the queue rows (C1)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.keys import lpad10, ltrim0, split_cockpits
from tallyspark.schemas import QUEUE_COLUMNS
from tallyspark.session import cut_lineage
from tallyspark.sources.registry import (
    DEFAULT_PROCESSES,
    KIND_STORAGE,
    KIND_VALUE,
    ProcessDef,
    active_processes,
)

# value queue column -> common queue column
VALUE_QUEUE_RENAMES = {
    "ctr_status": "status",
    "ctr_description": "status_complemento_fixo",
    "tipo_complemento": "tipo",
    "documento_compras": "doc_compra",
    "id_cockpit": "numero_cockpit",
    "codigo_parceiro": "cod_parceiro",
    "ctr_last_updated": "data_hora_ultima_atualizacao",
    "msg_sap": "msg_rpa",
}


def scan_queue(raw: DataFrame, process: ProcessDef) -> DataFrame:
    """Status filter, constant process type, common column names,
    cockpit list exploded (one row per distinct non-blank cockpit)."""
    df = raw
    if process.kind == KIND_VALUE:
        df = df.select(*[F.col(c).alias(VALUE_QUEUE_RENAMES.get(c, c)) for c in df.columns])
        df = df.select(
            "*", *[F.lit(None).cast("string").alias(c) for c in ("chave_acesso", "data_processamento", "hora_processamento")]
        )
    df = df.where(F.col("status").isin(*process.statuses))
    df = df.select(
        "*",
        F.lit(process.tipo_processo).alias("tipo_processo"),
        F.col("numero_cockpit").alias("numero_cockpit_original"),
        F.explode(split_cockpits("numero_cockpit")).alias("_cockpit"),
    ).drop("numero_cockpit")
    df = df.withColumnRenamed("_cockpit", "numero_cockpit")
    return df.select(*QUEUE_COLUMNS)


def row_digest(process_name: str) -> Column:
    """Content of a queue row (all columns but the exploded cockpit) and its
    process, as 128 bits of SHA-256 in hex; NULL and '' differ."""
    parts = [F.lit(process_name)]
    for c in QUEUE_COLUMNS:
        if c != "numero_cockpit":
            text = F.col(c).cast("string")
            parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def expand_queues(
    queues: Mapping[str, DataFrame], processes: Iterable[ProcessDef] = DEFAULT_PROCESSES
) -> DataFrame:
    """Every active queue scanned, exploded and unioned into work items.

    Adds ``PROCESS_NAME``, ``ordinal``, ``kind`` and the two join keys:
    ``ctr_key`` (the contract as the ledger holds it) and ``cockpit_key``
    (cockpit id without leading zeros), and ``row_digest``, the content of
    the queue row; :func:`number_items` makes it the row's identity.
    """
    active = list(active_processes(processes))
    absent = [p.process_name for p in active if p.process_name not in queues]
    if absent:
        raise ValueError(f"active processes without a queue: {absent}")
    parts = []
    for p in active:
        items = scan_queue(queues[p.process_name], p)
        ctr_key = lpad10(F.col("n_contrato")) if p.kind == KIND_STORAGE else F.col("doc_compra")
        parts.append(
            items.select(
                "*",
                F.lit(p.process_name).alias("PROCESS_NAME"),
                F.lit(p.ordinal).alias("ordinal"),
                F.lit(p.kind).alias("kind"),
                ctr_key.alias("ctr_key"),
                ltrim0(F.col("numero_cockpit")).alias("cockpit_key"),
                row_digest(p.process_name).alias("row_digest"),
            )
        )
    if not parts:
        raise ValueError("no active process has a queue")
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


ITEM_NO = "item_no"  # a number that no other item of the written table has


def number_items(items: DataFrame, by_content: bool = True) -> DataFrame:
    """The items with ``queue_row_id``, written once; with
    ``by_content`` off, with ``item_no`` instead.

    ``item_no`` is a long that is written with the item, so every reader sees
    the same one; it tells items apart (equal ones too) without moving any, but
    says nothing of them: it is for joins inside a run, not for results.

    A queue id may be NULL or repeated, so a row's identity is its content and,
    among rows of equal content, an occurrence number.  Cockpits are distinct
    within a row, so the n-th item of (content, cockpit) belongs to the n-th
    such row, and rows of equal content are interchangeable: the identity does
    not depend on how the queue is partitioned.

    Occurrences are numbered inside each written partition and moved by the
    counts of the partitions before, so a row repeated without bound is never
    one task's work; items that occur once only pay the (partial) count.
    """
    if not by_content:
        known = [c for c in items.columns if c != "row_digest"]
        return cut_lineage(items.select(*known, F.monotonically_increasing_id().alias(ITEM_NO)), "items")
    content = ["row_digest", "numero_cockpit"]
    staged = cut_lineage(items.withColumn("_part", F.spark_partition_id()), "items")
    per_part = staged.groupBy(*content, "_part").agg(F.count(F.lit(1)).alias("_n"))
    repeated = per_part.groupBy(*content).agg(F.sum("_n").alias("_total")).where("_total > 1").select(*content)
    repeated = cut_lineage(repeated, "repeated-items")

    def named(df: DataFrame, occurrence: Column) -> DataFrame:
        row_id = F.concat_ws("-", "row_digest", occurrence.cast("string")).alias("queue_row_id")
        return df.select(*[c for c in items.columns if c != "row_digest"], row_id)

    if repeated.isEmpty():
        return named(staged, F.lit(1))
    before = F.sum("_n").over(Window.partitionBy(*content).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_part.join(repeated, content, "left_semi").select(*content, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    # equal rows: their order inside a partition is of no account
    place = F.row_number().over(Window.partitionBy(*content, "_part").orderBy(F.lit(0)))
    many = named(staged.join(offsets, [*content, "_part"]).withColumn("_k", place), F.col("_before") + F.col("_k"))
    return cut_lineage(named(staged.join(repeated, content, "left_anti"), F.lit(1)).unionByName(many), "numbered-items")
