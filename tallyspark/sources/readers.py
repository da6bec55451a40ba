"""Readers for a deployment: queue and ERP tables from files, catalog
tables or JDBC, always with the declared schema (no inference) and only
the columns the matching reads (Catalyst prunes the rest at the scan)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyspark.schemas import ERP_SCHEMAS, QUANTITY_QUEUE_SCHEMA, VALUE_QUEUE_SCHEMA
from tallyspark.sources.registry import DEFAULT_PROCESSES, KIND_VALUE, ProcessDef
from tallyspark.sources.erp import ErpTables


def _columns(ddl: str) -> list[str]:
    from pyspark.sql.types import _parse_datatype_string

    return [f.name for f in _parse_datatype_string(ddl).fields]


def read_location(spark: SparkSession, location: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """A table by path (``fmt`` = parquet/orc/csv/json) or, with
    ``fmt='table'``, by catalog name; projected to the declared columns."""
    if fmt == "table":
        df = spark.read.table(location)
    else:
        reader = spark.read.format(fmt)
        if fmt in ("csv", "json"):
            reader = reader.schema(ddl)
        if fmt == "csv":
            reader = reader.option("header", "true")
        df = reader.load(location)
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _parse_datatype_string(ddl).fields])


def read_erp(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet") -> ErpTables:
    """The twelve ERP tables from ``locations`` (ERP_SCHEMAS name -> path or table)."""
    missing = set(ERP_SCHEMAS) - set(locations)
    if missing:
        raise KeyError(f"ERP tables without a location: {sorted(missing)}")
    return ErpTables(**{n: read_location(spark, locations[n], ddl, fmt) for n, ddl in ERP_SCHEMAS.items()})


def read_queues(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet",
                processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> dict[str, DataFrame]:
    """Queue tables by process name (value queue in its own vocabulary)."""
    out = {}
    for p in processes:
        if p.process_name in locations:
            schema = VALUE_QUEUE_SCHEMA if p.kind == KIND_VALUE else QUANTITY_QUEUE_SCHEMA
            out[p.process_name] = read_location(spark, locations[p.process_name], schema.simpleString()[7:-1], fmt)
    return out


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int = 64, fetchsize: int = 10000,
                 **extra: str) -> dict[str, str]:
    """Options for a parallel JDBC read (queues live in a relational
    database): ``partitionColumn``/bounds split the read over tasks instead
    of one connection pulling the whole table."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if partition_column is not None:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    opts.update(extra)
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str], ddl: str) -> DataFrame:
    """A JDBC table projected to the declared columns (needs the driver jar
    on the classpath; not exercised by the tests, which have no database)."""
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*_columns(ddl))
