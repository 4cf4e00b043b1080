"""Helpers shared by the operators: table access, scratch tables, splitting, streaming batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing Python work) and
    lets Spark drop the shuffle files of the plan that made it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    before = spark.conf.get(CLEANUP, "false")
    try:
        spark.conf.set(CLEANUP, "true")
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: Column, sha: Column) -> Column:
    """One never-null text for an id and the hash of a text."""
    return F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("-")), F.lit(":"), sha)


def text_sha(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def rows_with_key(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (id, text) is one of ``keys`` (column ``key``, each once), one row per key.

    The row travels as one struct, so its columns may have any names.  The join and the choice among
    rows that repeat in id and text use the same key: the texts are shuffled once."""
    packed = docs.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), text_sha(F.col("text"))).alias("key"))
    return packed.join(keys.select("key"), "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: str | None, fold: bool = False) -> list[bytes]:
    """UTF-8 words between spaces, tabs and line ends (0x20, 0x09-0x0D); ``fold`` lower-cases A-Z.

    ``bytes.split`` / ``bytes.lower`` know exactly these six separators and only ASCII case.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if fold else raw).split()


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int, max_rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Regroup Arrow batches so that the texts of one piece hold about ``max_bytes``.

    Bounds the Python memory of a task however long single texts are: a text longer than
    ``max_bytes`` is a piece of its own.
    """
    held, size, rows = [], 0, 0
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = 0
        for i, n in enumerate(lengths):
            if (size + n > max_bytes or rows >= max_rows) and (i > start or held):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield _joined(held)
                held, size, rows, start = [], 0, 0, i
            size, rows = size + n, rows + 1
        if start < len(lengths):
            held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    return table.to_batches()[0]


def gather(batches: Iterable[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    """Whole long columns of a partition that is bounded by its shuffle."""
    parts = [[batch.column(name).to_numpy(zero_copy_only=False) for name in names] for batch in batches if batch.num_rows]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(names))]


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32 of the id as text, mod 5, equals ``remainder`` (a null id counts as empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5) == remainder
