"""New-files-only ingest on Structured Streaming (raw -> silver) and the streaming gold job.

A file source with a ``checkpointLocation`` remembers which files it consumed; with
``trigger(availableNow=True)`` each run processes exactly the files that arrived since the
previous run and stops.  The sink is ``foreachBatch``: the micro-batch becomes one table
commit, tagged with (stream id, batch id), so a retried batch finds its commit.  The
stream's own commit log advances only after the function returns (at-least-once delivery,
idempotent effect).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.join import GOLD_SQL
from strata.plans.gold import run_gold
from strata.sources.fs import Fs
from strata.sources.raw import CORRUPT, FORMATS
from strata.sources.table import KeyedTable
from strata.spec import COMMIT, DELETED
from strata.streaming import drift


def raw_stream(spark: SparkSession, landing: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """Streaming scan of every file under ``landing`` (sub-directories included)."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported raw format {fmt!r}; expected one of {FORMATS}")
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if fmt == "json":
        if CORRUPT not in schema.fieldNames():
            schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).format(fmt).load(landing)


def _run_available(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_silver(spark: SparkSession, landing: str, table: KeyedTable, schema: StructType | None, checkpoint: str,
               fmt: str = "json", method: str = "upsert", sql_transformer: str | None = None,
               quarantine: str | None = None, max_fields: int = drift.MAX_FIELDS) -> list[int]:
    """Ingest the files that are new since the last run into ``table``; returns the commits made.

    ``schema`` None (JSON): the fields may change from run to run; types are inferred per batch and merged into
    the table's schema, and what does not fit goes to the column ``_rescued`` (see ``strata.streaming.drift``).

    Lines that are not valid JSON go to ``<quarantine>/batch=<id>`` (JSON with the raw text as ``line``; default: the
    folder ``_quarantine`` of the table) instead of the table; none is dropped.
    """
    made: list[int] = []
    held_back = (quarantine or f"{table.root}/_quarantine").rstrip("/")
    if schema is None and fmt != "json":
        raise ValueError(f"{fmt} files need a schema")

    def batch_fn(df: DataFrame, batch_id: int) -> None:
        query = _stream_id(table.fs, checkpoint)
        if schema is None:
            df = drift.conform(df, _drifted(df, table, max_fields)).withColumnRenamed("_line", CORRUPT)
        has_corrupt = CORRUPT in df.columns
        good = df
        if has_corrupt:
            # two disjoint outputs of one input: compute it once
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if has_corrupt:
                bad = df.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))
                if not bad.isEmpty():
                    bad.write.mode("overwrite").json(f"{held_back}/stream={query}/batch={batch_id}")
                good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            n = table.write(good, method, sql_transformer=sql_transformer, tag=f"{query}#{batch_id}",
                            cached=has_corrupt and not sql_transformer)
        finally:
            if has_corrupt:
                df.unpersist()
        if n is not None:
            made.append(n)

    stream = raw_stream(spark, landing, schema, fmt) if schema is not None else (
        spark.readStream.option("recursiveFileLookup", "true").text(landing))
    _run_available(stream, batch_fn, checkpoint)
    return made


def _drifted(lines: DataFrame, table: KeyedTable, max_fields: int) -> StructType:
    """The table's fields and the new ones of this batch; key, time and partition columns always exist."""
    spec = table.spec
    stored = [f for f in (table.schema() or StructType()).fields if f.name not in (COMMIT, DELETED, drift.RESCUED)]
    fields = list(drift.infer(lines, StructType(stored), max_fields).fields)
    names = {f.name for f in fields}
    needed = [*spec.keys, *([spec.precombine] if spec.precombine else []), *spec.partition_by]
    return StructType(fields + [StructField(c, StringType(), True) for c in dict.fromkeys(needed) if c not in names])


def _stream_id(fs: Fs, checkpoint: str) -> str:
    """The id Spark gave this stream; a fresh checkpoint at the same path has another one."""
    return json.loads(fs.read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"]


def commit_stream(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """A table's commits as a stream: the markers, which exist only for visible commits."""
    return spark.readStream.schema("commit long, method string, time string").json(f"{table.meta}/commits")


def run_gold_stream(spark: SparkSession, orders: KeyedTable, customers: KeyedTable, gold: KeyedTable,
                    checkpoint: str, sql: str = GOLD_SQL) -> list[int]:
    """Streaming gold: new orders commits start a gold run over the commits that are visible.

    The rows come through the table (never from files of unfinished commits).  One more run
    follows the stream, so that orders waiting for a customer are released when only customers
    arrived.  Progress and waiting orders live under the checkpoint.
    """
    made: list[int] = []
    root = checkpoint.rstrip("/")

    def step(_df: DataFrame | None = None, _batch_id: int | None = None) -> None:
        done = run_gold(spark, orders, customers, gold, f"{root}/progress", consumer="gold_stream", sql=sql).commit
        if done is not None and done not in made:
            made.append(done)

    _run_available(commit_stream(spark, orders), step, f"{root}/stream")
    step()
    return made
