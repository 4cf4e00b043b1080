"""Landing-zone inventory as a Spark job: list, test and search file keys under a prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import regex_search
from strata.sources.fs import Fs


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None,
                   prefix: str | None = None) -> DataFrame:
    """path, length, modificationTime of every file under ``path`` (recursive).

    Only metadata columns are selected, so file contents are never read.  ``pattern`` keeps
    paths matching the regex anywhere; ``prefix`` keeps paths starting with ``path/prefix``.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
          .select("path", "length", "modificationTime"))
    if pattern:
        df = df.where(regex_search("path", pattern))
    if prefix:
        root = Fs(spark).qualify(path).rstrip("/")
        df = df.where(F.col("path").startswith(f"{root}/{prefix}"))
    return df


def item_exists(spark: SparkSession, path: str) -> bool:
    return Fs(spark).exists(path)


def find_one(spark: SparkSession, path: str, pattern: str) -> str | None:
    """Some file key under ``path`` matching ``pattern``, or None."""
    row = file_inventory(spark, path, pattern=pattern).select("path").head(1)
    return row[0]["path"] if row else None
