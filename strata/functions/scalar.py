"""Scalar helpers. All of them are built-in Spark expressions (JVM side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: ISO-8601 text of a naive timestamp, seconds precision.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def key_list(keys) -> list[str]:
    """"a,b" / ["a", "b"] / ("a",) -> ["a", "b"]; blanks dropped."""
    if keys is None:
        return []
    if isinstance(keys, str):
        keys = keys.split(",")
    out = []
    for k in keys:
        for part in str(k).split(","):
            part = part.strip()
            if part and part not in out:
                out.append(part)
    return out


def row_to_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON object text (object -> JSON text)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def json_to_row(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """JSON object text -> typed columns (JSON text -> object)."""
    parsed = F.from_json(F.col(column), schema)
    return df.select(parsed.alias("_obj")).select("_obj.*")


def iso_text(col: str | Column) -> Column:
    """Naive timestamp -> 'yyyy-MM-ddTHH:mm:ss' text."""
    return F.date_format(col if isinstance(col, Column) else F.col(col), ISO_SECONDS)


def regex_search(col: str | Column, pattern: str) -> Column:
    """True where the pattern occurs anywhere in the text."""
    c = col if isinstance(col, Column) else F.col(col)
    return c.rlike(pattern)
