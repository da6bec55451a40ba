"""Column helpers for keys, dates, amounts and composite ids.

All of them return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.schemas import AMOUNT


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ltrim0(c: Column | str) -> Column:
    """Leading zeros stripped: '000123' -> '123', '0000' -> ''."""
    return F.ltrim(_c(c), F.lit("0"))


def ltrim0_or_empty(c: Column | str) -> Column:
    """Like :func:`ltrim0` with NULL mapped to '' (the audit's twin)."""
    return F.ltrim(F.coalesce(_c(c).cast("string"), F.lit("")), F.lit("0"))


def lpad10(c: Column | str) -> Column:
    """SQL LPAD to 10 with '0' (longer values are cut to 10)."""
    return F.lpad(_c(c), 10, "0")


def zfill10(c: Column | str) -> Column:
    """Python ``zfill(10)``: pads, never cuts."""
    c = _c(c)
    return F.when(F.length(c) >= 10, c).otherwise(F.lpad(c, 10, "0"))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: cuts any leading/trailing whitespace (tabs too)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def is_blank(c: Column | str) -> Column:
    """NULL, or empty after whitespace strip."""
    c = _c(c)
    return c.isNull() | (strip_ws(c.cast("string")) == "")


def is_sql_blank(c: Column | str) -> Column:
    """SQL form ``c IS NULL OR c = ''`` (no trimming)."""
    c = _c(c)
    return c.isNull() | (c == "")


def nonblank_docnum(c: Column | str) -> Column:
    """DOCNUM counts as filled when something is left after cutting zeros
    on both ends and then whitespace."""
    c = _c(c)
    return c.isNotNull() & (strip_ws(F.btrim(c.cast("string"), F.lit("0"))) != "")


def split_cockpits(c: Column | str) -> Column:
    """Composite cockpit id '1| 2|1||3' -> ['1', '2', '3'].

    Split on '|', trim spaces, drop blanks, distinct within the row.  An
    empty result makes the row vanish under ``explode``.
    """
    parts = F.split(F.coalesce(_c(c), F.lit("")), r"\|")
    trimmed = F.transform(parts, lambda x: F.trim(x))
    return F.array_distinct(F.filter(trimmed, lambda x: x != ""))


def split_cockpits_keep_empty(c: Column | str) -> Column:
    """Audit variant: not distinct, whitespace stripped, and one '' element
    when nothing is left (the row never vanishes)."""
    parts = F.split(F.coalesce(_c(c).cast("string"), F.lit("")), r"\|")
    stripped = F.filter(F.transform(parts, lambda x: strip_ws(x)), lambda x: x != "")
    return F.when(F.size(stripped) == 0, F.array(F.lit(""))).otherwise(stripped)


def ymd(c: Column | str) -> Column:
    """Date/timestamp -> 'YYYYMMDD' text (ERP date format)."""
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("string")


def parse_ymd(c: Column | str) -> Column:
    """'YYYYMMDD' -> DATE, NULL when not parseable ('00000000', '')."""
    return F.try_to_date(_c(c), "yyyyMMdd")


def amount(c: Column | str) -> Column:
    """Amounts are NUMERIC(18,6): cast before any rounding."""
    return _c(c).cast(AMOUNT)


def round_amount(c: Column | str, scale: int) -> Column:
    """SQL ROUND (half away from zero) on the decimal, kept as NUMERIC(18,6)."""
    return F.round(amount(c), scale).cast(AMOUNT)


def year_in(c: Column, years: Sequence[int]) -> Column:
    return c.isin(*[int(y) for y in years])


def text_year_in(c: Column | str, years: Sequence[int]) -> Column:
    """``TO_INTEGER(c) IN (years)`` for a year held as text."""
    return year_in(_c(c).try_cast("int"), years)


def ymd_year_in(c: Column | str, years: Sequence[int]) -> Column:
    """``YEAR(c) IN (years)`` for a 'YYYYMMDD' text date.

    Only eight digits are such a date, so the text range of the years takes
    nothing away; unlike the year itself it reaches the parquet scan.  (A year
    held as text has no such range: ' 2026' and '02026' are 2026 too.)"""
    known = sorted(int(y) for y in years)
    if not known or known[0] < 1 or known[-1] > 9999:
        return year_in(F.year(parse_ymd(c)), years)
    return _c(c).between(f"{known[0]:04d}0101", f"{known[-1]:04d}1231") & year_in(F.year(parse_ymd(c)), years)


def hhmmss(seconds: Column | str) -> Column:
    """Seconds -> 'HH:MM:SS' (half-even rounding to whole seconds, NULL -> 0)."""
    s = F.bround(F.coalesce(_c(seconds).cast("double"), F.lit(0.0)), 0).cast("long")
    return F.format_string(
        "%02d:%02d:%02d", (s / 3600).cast("long"), ((s % 3600) / 60).cast("long"), s % 60
    )


def safe_text(c: Column | str) -> Column:
    """NULL or blank -> '-', else the stripped text."""
    s = strip_ws(_c(c).cast("string"))
    return F.when(s.isNull() | (s == ""), F.lit("-")).otherwise(s)


def nan_to_null(df):
    """NaN in floating columns becomes NULL (other types are nullable
    already and stay as they are)."""
    from pyspark.sql import types as T

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
