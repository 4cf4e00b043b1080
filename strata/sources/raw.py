"""Raw landing zone: scan (json / parquet, recursive) and the landing writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
FORMATS = ("json", "parquet")


def read_raw(spark: SparkSession, path: str, fmt: str = "json", schema: StructType | None = None,
             keep_corrupt: bool = False) -> DataFrame:
    """Every file under ``path``, sub-directories included.

    JSON: one object per line/file; without a schema every field is inferred (the landing
    records are all text).  ``keep_corrupt`` adds ``_corrupt_record`` holding the raw text of
    lines that are not valid JSON.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported raw format {fmt!r}; expected one of {FORMATS}")
    reader = spark.read.option("recursiveFileLookup", "true")
    if fmt == "json":
        if keep_corrupt:
            if schema is not None and CORRUPT not in schema.fieldNames():
                schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_landing(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Append rows as JSON objects (one per line) or parquet under ``path``.

    Many objects per file, not one file per object: at scale the landing zone stays listable.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported landing format {fmt!r}; expected one of {FORMATS}")
    writer = df.write.mode("append")
    if fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)
