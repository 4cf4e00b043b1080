"""Hand-made rows and word rules shared by the operator tests."""

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


def docs_frame(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(df):
    """Extra columns whose names operators use inside."""
    from pyspark.sql import functions as F

    for name in ("key", "pid", "run", "part", "size", "row_id", "words", "h", "length", "rank", "score", "start"):
        df = df.withColumn(name, F.lit("x"))
    return df


def documents(spark, sf=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
