"""Reconcile all processes in one plan (C5), with ERRO rows for items that fail a
fatal check (C6, :mod:`tallyspark.operators.checks`),
conformance to the fixed result schema (K9, P2) and eligibility (C7)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.keys import is_blank
from tallyspark.operators.blocks import has_blank_active
from tallyspark.operators.checks import quarantine
from tallyspark.operators.match import (
    _NARROW,
    contract_blocks,
    contract_hits,
    item_key,
    match_routes,
    open_invoices,
    wanted_invoices,
    with_items,
)
from tallyspark.operators.pruning import cannot_meet, may_meet
from tallyspark.operators.skew import CellBudget
from tallyspark.session import cut_lineage
from tallyspark.operators.queues import expand_queues, number_items
from tallyspark.schemas import (
    RESULT_SCHEMA,
    ROW_ERRO,
    ROW_SEM_RETORNO,
    ROW_SUCESSO,
)
from tallyspark.sources.registry import DEFAULT_PROCESSES, ProcessDef, active_processes
from tallyspark.sources.erp import ErpBlocks, ErpTables

# queue column -> result column (then everything is upper-cased)
QUEUE_RENAMES = {
    "chave_acesso": "VTIN_CHAVE_ACESSO",
    "data_processamento": "VTIN_DT_PROC",
    "hora_processamento": "VTIN_HR_PROC",
}


# what the joins and the checks read of an item, whatever is wanted of the result
ITEM_READ = [*_NARROW, "PROCESS_NAME", "row_digest"]


def conform(df: DataFrame, schema=RESULT_SCHEMA, keep_extra: bool = False) -> DataFrame:
    """K9: the frame in the fixed schema: names upper-cased (after the three
    queue renames), declared types, missing columns as typed NULLs, extra
    columns dropped unless ``keep_extra`` (stored rows keep them).  Case-insensitive name collisions are an error."""
    by_upper: dict[str, str] = {}
    for c in df.columns:
        u = QUEUE_RENAMES.get(c, c).upper()
        if u in by_upper:
            raise ValueError(f"columns {by_upper[u]!r} and {c!r} collide as {u!r}")
        by_upper[u] = c
    cols = []
    for f in schema.fields:
        if f.name in by_upper:
            cols.append(F.col(f"`{by_upper[f.name]}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    fixed = set(schema.names)
    extra = [F.col(f"`{c}`").alias(u) for u, c in by_upper.items() if u not in fixed] if keep_extra else []
    return df.select(*cols, *extra)


def prepared(erp: ErpTables, years: Sequence[int]) -> ErpTables:
    """The tables with their blocks written, for several reconciles over the
    same tables and years (the micro-batches of a stream)."""
    if _blocks(erp, years) is not None:
        return erp
    blank = has_blank_active(erp)
    contracts = cut_lineage(contract_blocks(erp), "contract-blocks")
    invoices = cut_lineage(open_invoices(erp, years, blank_active=blank), "all-open-invoices")
    return replace(erp, blocks=ErpBlocks(frozenset(int(y) for y in years), contracts, invoices, blank))


def _blocks(erp: ErpTables, years: Sequence[int]) -> ErpBlocks | None:
    """The blocks of the tables, if they were made for these years."""
    return erp.blocks if erp.blocks is not None and erp.blocks.years == {int(y) for y in years} else None


def prepare(items: DataFrame, erp: ErpTables, years: Sequence[int], materialize: bool = True, blank_active: bool | None = None,
            columns: Collection[str] | None = None):
    """Shared inputs of the routes: ledger hits with their contract block
    (all items) and the open-invoice block.  Both feed several joins, so
    by default each is written once to the shared checkpoint folder (cuts
    the lineage: later stages and retries read the written rows).  The hits
    come first: the invoices are restricted to their tax ids and quantities.
    ``columns``: what is read of the result (see :func:`reconcile`)."""
    blocks = _blocks(erp, years)
    # the micro-batches of a stream have few hits: they are not cut by one more scan
    hc = contract_hits(items, erp, materialize, blocks and blocks.contracts, years if materialize and blocks is None else None,
                       columns=columns)
    if blocks is not None:
        inv = wanted_invoices(blocks.invoices, hc)
        return hc, cut_lineage(inv, "open-invoices") if materialize else inv
    if not materialize:
        return hc, open_invoices(erp, years, blank_active=blank_active)
    return hc, cut_lineage(open_invoices(erp, years, hc, blank_active, columns), "open-invoices")


def reconcile(
    queues: Mapping[str, DataFrame],
    erp: ErpTables,
    years: Sequence[int],
    processes: Iterable[ProcessDef] = DEFAULT_PROCESSES,
    run_ts: _dt.datetime | None = None,
    materialize: bool = True,
    budget: CellBudget = CellBudget(),
    columns: Collection[str] | None = None,
) -> DataFrame:
    """Every active process, every work item, in one plan.

    N matches of an item -> N SUCESSO rows; none -> one SEM_RETORNO row;
    quarantined items -> one ERRO row.  Output is in the 84-column schema.

    The items go through the joins by number.  The match rows are written
    once, without the queue columns; these come back by one join of the items
    with the matches, for which no item moves that has none.  Quarantined items lose their matches there, where both
    are dealt by item, so no hit is moved for it.  Tables with their blocks
    (:func:`prepared`) spare the work that no item decides.  ``columns`` names
    the result columns that are read: the rows are the same, and no other column
    goes through the written tables but those that the joins and checks read.
    """
    processes = list(processes)
    items = expand_queues(queues, processes)
    if columns is not None:
        unknown = set(columns) - set(RESULT_SCHEMA.names)
        if unknown:
            raise ValueError(f"not in the result: {sorted(unknown)}")
        items = items.select(*[c for c in items.columns if c in ITEM_READ or QUEUE_RENAMES.get(c, c).upper() in columns])
    items = number_items(items, by_content=False)
    blocks = _blocks(erp, years)
    blank = has_blank_active(erp) if blocks is None else blocks.blank_active
    hc, inv = prepare(items, erp, years, materialize, blank, columns)
    key = item_key(hc)
    bad = quarantine(hc)
    kinds = {p.kind for p in active_processes(processes)}
    matches = match_routes(hc, erp, years, inv, budget if materialize else None, blank, kinds)
    if columns is not None:
        matches = matches.select(*key, *[c for c in matches.columns if c in columns])
    if materialize:
        matches = cut_lineage(matches, "matches")
        bad = cut_lineage(bad, "quarantined")
    # items with no match are found against the *distinct* matched keys, so
    # a hot item with many matches never lands in a single join task
    found = matches.select(*key).distinct().join(bad.select(*key), key, "left_anti")
    seen = found.select(*key, F.lit(None).cast("string").alias("MENSAGEM_ERRO"), F.lit(True).alias("_ok"))
    seen = seen.unionByName(bad.select(*key, "MENSAGEM_ERRO", F.lit(False).alias("_ok")))
    items = items.where(F.col(key[0]).isNotNull())
    unseen = None
    if materialize:
        # most items are neither matched nor quarantined: these stay where they are
        named = matches.select(*key).unionByName(bad.select(*key))
        unseen = cannot_meet(items, key, named, key).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in seen.schema if f.name not in key])
        items = may_meet(items, key, named, key)
    # both joins deal the same item columns by number: one exchange serves both
    others = items.join(seen, key, "left").where(~F.coalesce("_ok", F.lit(False)))
    if unseen is not None:
        others = others.unionByName(unseen)
    status = F.when(F.col("_ok").isNull(), F.lit(ROW_SEM_RETORNO)).otherwise(F.lit(ROW_ERRO))
    good = with_items(matches.join(bad.select(*key), key, "left_anti"), items)
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.lit(None).cast("timestamp")
    out = conform(good.withColumn("STATUS_EXECUCAO", F.lit(ROW_SUCESSO))).unionByName(
        conform(others.withColumn("STATUS_EXECUCAO", status).drop("_ok"))
    )
    out = out.withColumn("DATA_EXECUCAO", ts)
    return out if columns is None else out.select(*[c for c in RESULT_SCHEMA.names if c in columns])


def eligible(df: DataFrame, mode: str = "reference") -> DataFrame:
    """Rows still to be booked (blank DOCNUM after whitespace strip).

    ``reference``: any status counts, but only in processes where at least
    one row matched (otherwise the process has no DOCNUM at all and nothing
    is eligible).  ``strict``: SUCESSO rows only.

    The per-process flag is a distinct over process names (at most one row
    per registered process, so broadcasting it is bounded by the registry);
    no window partitions a whole process into one task.
    """
    blank = is_blank("DOCNUM")
    if mode == "strict":
        return df.where(blank & (F.col("STATUS_EXECUCAO") == ROW_SUCESSO))
    if mode != "reference":
        raise ValueError(f"unknown eligibility mode: {mode}")
    ok_procs = df.where(F.col("STATUS_EXECUCAO") == ROW_SUCESSO).select("PROCESS_NAME").distinct()
    # an inner join with the distinct (unique) names is the semi-join; a
    # left_semi would be pushed into union branches where the name is a
    # literal and lose its equi-key (nested-loop join)
    return df.where(blank).join(F.broadcast(ok_procs), "PROCESS_NAME", "inner").select(*df.columns)
