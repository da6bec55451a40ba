"""Small marker and text files beside the tables, on any file system that
Spark can write (through Hadoop's API, driver side; never row data)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return bool(fs.exists(target))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder (none if it does not exist), sorted."""
    fs, target = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already (atomic)."""
    fs, target = _at(spark, path)
    try:
        return bool(fs.createNewFile(target))
    except Exception as e:  # some file systems raise instead of answering
        if "AlreadyExists" in str(e):
            return False
        raise


def rename(spark: SparkSession, path: str, to: str) -> bool:
    fs, target = _at(spark, path)
    return bool(fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to)))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a text file; it must not exist."""
    fs, target = _at(spark, path)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
