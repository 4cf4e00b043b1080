"""The corpus pipeline: toxicity filter, exact and near de-duplication, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet
and read back as the next stage's ``docs``.  All but the last return the columns of
``documents``.

Results for odd input: a null text counts as empty in every stage (kept by the toxicity stage, one of all
empty texts stays after exact dedup, never taken by the mix); null ids and repeated rows are ordinary
documents and are decided row by row; columns beside those of ``documents``, of any name, travel on
unchanged up to the last stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, mixing, packing, simhash, toxicity
from strata.llm.common import load, scratch_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay; the score is learned from the labelled rows of ``sf_dir``."""
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return exact_dedup.keep_rows(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays (three-word shingles, 3 bits)."""
    return simhash.keep_rows(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a cut document has its first words only."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# tokens, hashes of whole neighbourhoods and learned scores have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch_table(docs, f"pipeline-{name}")
    return docs
