"""Stored invoices by emission year.

The received-invoice headers are the largest table that every cycle reads, and
a cycle only wants the invoices of its years.  Stored in one folder per
emission year, the other years are never listed for reading; inside a folder
the text range of the date (see ``ymd_year_in``) still skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from tallyspark.functions.keys import parse_ymd
from tallyspark.schemas import ERP_SCHEMAS

EMISSION_YEAR = "EMISSION_YEAR"
NO_YEAR = 0  # the folder of dates that cannot be read


def store_invoices(headers: DataFrame, path: str, mode: str = "error", files_per_year: int = 8) -> None:
    """Write invoice headers by emission year, ordered by date inside a file.
    A year is dealt over ``files_per_year`` tasks, so a large year (a third of
    all rows, say) is not one task's work; give it by the table's size."""
    year = F.coalesce(F.year(parse_ymd("D_EMI")), F.lit(NO_YEAR))
    rows = headers.withColumn(EMISSION_YEAR, year).withColumn("_file", F.pmod(F.xxhash64("ID"), F.lit(files_per_year)))
    rows = rows.repartition(EMISSION_YEAR, "_file").sortWithinPartitions(EMISSION_YEAR, "D_EMI").drop("_file")
    rows.write.mode(mode).partitionBy(EMISSION_YEAR).parquet(path)


def read_stored_invoices(spark: SparkSession, path: str) -> DataFrame:
    """The stored headers with their year; ``invoice_block`` prunes by it."""
    schema = _parse_datatype_string(ERP_SCHEMAS["xml_rec"] + f", {EMISSION_YEAR} int")
    return spark.read.schema(schema).parquet(path)
