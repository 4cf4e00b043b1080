"""Exact de-duplication by content sort.

Sampled splitters range-partition the texts, an external sort inside each partition puts equal
texts next to each other, and each row is compared in full with its neighbour.

The sort order is (first 64 characters, 64-bit hash, whole text, id).  The first two only make
the sampled splitters small (a splitter never carries a whole text) and separate texts with a
common beginning; equality is decided on the whole text.  The id is the last sort key, so a
group of equal texts of any size spreads over as many partitions as it needs.  Only the first
and last run of a partition can continue in another one: those two are matched by whole text
in a second, tiny aggregation (two rows per partition).

Results for odd input: a null text counts as empty; a null id is smaller than any id and stays
only if every id of the group is null; of rows that repeat both text and id exactly one stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import load, row_key, rows_with_key, scratch_table, shuffle_width

_RUNS = "row_id long, pid int, run long, last boolean, edge boolean, run_id long, run_size long, sha string, edge_text string"


def _runs(keep_largest: bool):
    """Sorted (pid, row_id, text) batches -> one row per input row with the summary of its run."""
    fields = [("row_id", pa.int64()), ("pid", pa.int32()), ("run", pa.int64()), ("last", pa.bool_()), ("edge", pa.bool_()),
              ("run_id", pa.int64()), ("run_size", pa.int64()), ("sha", pa.string()), ("edge_text", pa.string())]
    schema = pa.schema(fields)

    def close(out, pid, number, ids, text, edge):
        real = [i for i in ids if i is not None]
        best = (max(real) if keep_largest else min(real)) if real else None
        # rows of a run come in id order with nulls first: the row that stays is the last one,
        # or the first one that has an id
        stays = len(ids) - 1 if keep_largest else (len(ids) - len(real) if real else 0)
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        for i, row_id in enumerate(ids):
            here = i == stays
            out.append((row_id, pid, number, here, edge, best, len(ids), sha, text if edge and here else None))

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, ids, number, pid, out = None, [], 0, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            pid = batch.column("pid")[0].as_py()
            texts, row_ids = batch.column("text"), batch.column("row_id").to_pylist()
            same = pa.compute.equal(texts.slice(1), texts.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            heads = [0, *(np.flatnonzero(~same.astype(bool)) + 1).tolist(), batch.num_rows]
            for a, b in zip(heads[:-1], heads[1:]):
                value = texts[a].as_py()
                if text is not None and value != text:
                    close(out, pid, number, ids, text, number == 0)
                    number, ids = number + 1, []
                text = value
                ids.extend(row_ids[a:b])
            if len(out) >= 20_000:
                yield batch_of(out)
                out = []
        if text is not None:
            close(out, pid, number, ids, text, True)
        if out:
            yield batch_of(out)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise: Callable[[Column], Column] | None = None, partitions: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    keep       "smallest" or "largest": the identifier that stays of equal texts
    normalise  text column -> text column compared instead (default: no change)
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    largest = keep == "largest"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    n = partitions or shuffle_width(docs.sparkSession)
    order = [F.substring("text", 1, 64), F.xxhash64("text")]
    rows = (docs.select(F.col(id_col).cast("long").alias("row_id"), (normalise(text) if normalise else text).alias("text"))
            .repartitionByRange(n, *order, F.col("row_id"))
            .sortWithinPartitions(*order, "text", "row_id")
            .withColumn("pid", F.spark_partition_id()))
    runs = scratch_table(rows.mapInArrow(_runs(largest), _RUNS), "exact-runs")
    pick = F.max if largest else F.min
    # runs at partition edges: at most two per partition; grouped by their whole text
    edges = runs.where("edge and edge_text is not null").select("pid", "run", "run_id", "run_size", "edge_text")
    groups = edges.groupBy("edge_text").agg(
        pick("run_id").alias("all_id"), F.sum("run_size").alias("all_size"),
        F.sort_array(F.collect_list(F.struct(
            (F.col("run_id") if largest else -F.col("run_id")).alias("o"), "pid", "run"))).alias("members"))
    merged = groups.select("all_id", "all_size", F.element_at("members", -1).alias("winner"), F.explode("members").alias("m")).select(
        F.col("m.pid").alias("pid"), F.col("m.run").alias("run"), "all_id", "all_size",
        F.expr("m = winner").alias("wins"))
    return (runs.join(F.broadcast(merged), ["pid", "run"], "left").select(
        F.col("row_id").alias("doc_id"),
        F.coalesce("all_id", "run_id").alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("last") & F.coalesce("wins", F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(load(spark, sf_dir, "documents"), keep="largest")


def keep_rows(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents that stay, all columns.

    Rows are chosen by (id, text hash); a row whose id and text both repeat is returned once.  Columns may have
    any names.
    """
    kept = exact_dedup(docs, keep=keep).where("kept")
    return rows_with_key(docs, kept.select(row_key(F.col("doc_id"), F.col("text_sha256")).alias("key")))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
