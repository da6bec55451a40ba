"""Leaving rows out before a shuffle that no key on the other side can meet.

A join moves all rows of both sides, also those without a partner.  Where one
side's keys are few beside the other's rows, their hashes are set in a bit map
of fixed size (``BITS``, as words of 64 bits, one ``bit_or`` a word), which is
broadcast; a row whose bit is not set has no partner and stays where it is.
What is broadcast does not grow with the data: with more keys than bits fewer
rows are left out, none is lost.  The join that follows decides on the keys.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # at most 2**20 words


def _place(columns: Sequence[str | Column]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITS))


def _word_and_bit(place: Column) -> tuple[Column, Column]:
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    return F.shiftright(place, 6), bit


def key_bits(keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The bit map of the keys; a key with a NULL part joins nothing."""
    word, bit = _word_and_bit(F.col("_place"))
    places = keys.dropna(subset=list(columns)).select(_place(columns).alias("_place"))
    return places.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _hash_alike(df: DataFrame, on: Sequence[str | Column], keys: DataFrame, columns: Sequence[str]) -> bool:
    """Whether equal keys have equal hashes: only those of one type do."""
    pairs = zip(df.select(*on).schema, keys.select(*columns).schema, strict=True)
    return all(a.dataType == b.dataType for a, b in pairs)


def _split(df: DataFrame, on: Sequence[str | Column], keys: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    word, bit = _word_and_bit(_place(on))
    bits = F.broadcast(key_bits(keys, columns))  # BITS / 64 rows at most
    return df.join(bits, (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), how)


def marked(df: DataFrame, mark: str, on: Sequence[str | Column], keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All rows, with a boolean ``mark``: false for those that
    :func:`may_meet` leaves out.  For rows that one of several keys keeps."""
    if not _hash_alike(df, on, keys, columns):
        return df.withColumn(mark, F.lit(True))
    word, bit = _word_and_bit(_place(on))
    bits = key_bits(keys, columns).select(F.col("_word").alias(f"{mark}_word"), F.col("_bits").alias(f"{mark}_bits"))
    held = df.join(F.broadcast(bits), word == F.col(f"{mark}_word"), "left")  # a word is there once; BITS / 64 rows at most
    there = F.coalesce(F.col(f"{mark}_bits").bitwiseAND(bit) != 0, F.lit(False))
    return held.withColumn(mark, there).drop(f"{mark}_word", f"{mark}_bits")


def may_meet(df: DataFrame, on: Sequence[str | Column], keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose ``on`` may be among the ``columns`` of ``keys``:
    all that are and few others.  ``keys`` is read once more: give a written
    table or a narrow scan.  Keys of unlike types leave nothing out."""
    if not _hash_alike(df, on, keys, columns):
        return df
    # a semi-join: the one that decides cannot be moved below it
    return _split(df, on, keys, columns, "left_semi")


def cannot_meet(df: DataFrame, on: Sequence[str | Column], keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``df`` that :func:`may_meet` leaves out: none of them is
    among ``keys``."""
    if not _hash_alike(df, on, keys, columns):
        return df.limit(0)
    return _split(df, on, keys, columns, "left_anti")


def blanked(df: DataFrame, columns: Collection[str] | None) -> DataFrame:
    """The frame with its columns but these as typed NULLs, which are neither
    moved nor stored: a plan cannot see through a written table that no reader
    wants the rest (all are kept without ``columns``)."""
    if columns is None:
        return df
    return df.select(*[
        F.col(f"`{f.name}`") if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields
    ])
