"""Row checks (C6): what is wrong with a work item, as a list of reasons.

Each check is one row of :data:`CHECKS`: where it looks (the item itself or its
ledger rows), when it fails and how the reason reads.  All checks of a level are
evaluated in one pass; an item's reasons are one aggregate over its failing rows
only.  A *fatal* reason makes the item an ERRO row (the match itself would
fail); the others explain why an item cannot match and leave its verdict alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.keys import is_sql_blank, parse_ymd
from tallyspark.operators.match import item_key
from tallyspark.sources.registry import KIND_STORAGE, KIND_VALUE

ITEM, LEDGER = "item", "ledger"


@dataclass(frozen=True)
class Check:
    name: str
    level: str
    fails: Callable[[], Column]
    detail: Callable[[], Column]  # of a failing row; the smallest is shown
    text: str
    fatal: bool = False

    def reason(self) -> Column:
        """The reason on a failing row, NULL on others."""
        return F.when(self.fails(), F.concat(F.lit(f"{self.text}: "), F.coalesce(self.detail(), F.lit("NULL"))))


CHECKS: tuple[Check, ...] = (
    Check("missing_parameter", ITEM, lambda: is_sql_blank("ctr_key"),
          lambda: F.when(F.col("kind") == KIND_STORAGE, F.lit("n_contrato")).otherwise(F.lit("doc_compra")), "parametro ausente"),
    Check("bad_key", ITEM, lambda: ~F.col("cockpit_key").rlike("^[0-9]*$"), lambda: F.col("numero_cockpit"), "chave invalida"),
    Check("bad_date", LEDGER, lambda: (F.col("kind") == KIND_VALUE) & parse_ymd("ZMMT_DATA").isNull(),
          lambda: F.col("ZMMT_DATA"), "data invalida no razao", fatal=True),
    Check("no_quantity", LEDGER, lambda: F.col("ZMMT_QTDE").isNull(), lambda: F.col("ZMMT_ID"), "quantidade ausente no razao"),
)


def failing(df: DataFrame, level: str, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """Rows of a level that fail a check, with a column per check of all
    levels (NULL where it holds)."""
    none = F.lit(None).cast("string")
    cols = [(c.reason() if c.level == level else none).alias(c.name) for c in checks]
    return df.select(*item_key(df), "id", *cols).where(F.coalesce(*[F.col(c.name) for c in checks]).isNotNull())


def row_reasons(items: DataFrame, hits: DataFrame, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """Items with a reason: key (as the items have it), id, ``motivos`` (in the
    order of the checks) and ``MENSAGEM_ERRO`` (the fatal ones, NULL without any)."""
    rows, key = failing(items, ITEM, checks).unionByName(failing(hits, LEDGER, checks)), item_key(items)
    per_item = rows.groupBy(*key).agg(F.min("id").alias("id"), *[F.min(c.name).alias(c.name) for c in checks])
    fatal = [F.col(c.name) for c in checks if c.fatal]
    return per_item.select(
        *key,
        "id",
        F.filter(F.array(*[F.col(c.name) for c in checks]), lambda x: x.isNotNull()).alias("motivos"),
        F.nullif(F.concat_ws("; ", *fatal), F.lit("")).alias("MENSAGEM_ERRO"),
    )


def quarantine(hits: DataFrame, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """Items with a fatal reason in their ledger rows: key (as the hits have
    it) and ``MENSAGEM_ERRO``; they become ERRO rows."""
    fatal = [c for c in checks if c.fatal and c.level == LEDGER]
    rows, key = failing(hits, LEDGER, fatal), item_key(hits)
    per_item = rows.groupBy(*key).agg(*[F.min(c.name).alias(c.name) for c in fatal])
    return per_item.select(*key, F.concat_ws("; ", *[c.name for c in fatal]).alias("MENSAGEM_ERRO"))
