"""Mixing sources to target weights.

Every document gets a hash-random key; within a source the documents are ordered by that key,
distributed prefix sums of their token counts are formed, and the source is cut at its exact
budget.  A budget above the source's size repeats whole epochs first.

The prefix sums have two levels: the key space of a source is divided into ranges of about
``RANGE_ROWS`` documents, the sums of the ranges are added up per source, and inside one range
a window adds up the documents.  A hot source simply has more ranges.  The key is a hash of id and
text: rows without id, or sharing one, spread like others, and only rows alike in both lie in one
range.  A task holds one range, or one row per range of one source.

Targets are the water-filling solution: a source of size ``S`` and weight ``w`` gets
``min(cap * S, level * w)`` with the level that makes the targets add up to the wanted total;
this equals resharing the excess by weight until no source is above its cap.

Results for odd input: a null text has size 0; a null source is a source of its own and sorts
last; null ids and repeated rows are ordinary documents (equal keys are ordered by id, then
size); an empty table gives an empty result; empty documents are never taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, load, scratch_table

RANGE_ROWS = 512
KEY_BITS = 62
SEED = 20240817


def _key(doc_id: Column, text: Column, seed: int) -> Column:
    """The text takes part, so that rows without id or with one shared id spread over the key space too."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id.cast("long"), text.cast("string")), 64 - KEY_BITS)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, cap: float = 3.0) -> DataFrame:
    """``source, source_size, source_rows`` -> the same with ``target``.

    One row per source: this is the mixture table, whose size is set by the number of weights
    to choose and not by the documents.  Weights repeat over the sources in code-point order.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (sources
              .withColumn("w", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
              .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
            .withColumn("at", F.col("limit") / F.col("w"))
              .withColumn("total", F.least(F.sum("source_size").over(everything) * F.lit(float(share)), F.sum("limit").over(everything))))
    # sources reach their cap in the order limit / weight; before each, what is left for the rest
    order = everything.orderBy(F.col("at").asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(after))
    return (ranked.withColumn("level", level).withColumn("turn", F.row_number().over(order))
            .withColumn("fits", F.col("level") * F.col("w") <= F.col("limit"))
            # the first source that stays below its cap fixes the level of all later ones
            .withColumn("fixed", F.min(F.struct(
                F.when(F.col("fits"), F.lit(0)).otherwise(1).alias("no"), "turn", "level")).over(everything))
            .select("source", "source_size", "source_rows",
                    F.when(F.col("fixed.no") == 1, F.col("limit"))
                    .otherwise(F.least(F.col("limit"), F.col("fixed.level") * F.col("w"))).alias("target")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, cap: float = 3.0, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source, source_size, target, epochs, cut, taken`` for every document.

    epochs  whole passes over the source;  cut: words of the following, partial pass that fall
    on this document (0 .. size);  taken = epochs * size + cut
    """
    sized = scratch_table(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        F.col(source_col).cast("string").alias("source"),
        _key(F.col(id_col), F.col(text_col), seed).alias("key")), "mix-sizes")
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")),
                   weights, share, cap)
    plan = scratch_table(plan.withColumn("ranges", F.ceil(F.col("source_rows") / RANGE_ROWS).cast("long")), "mix-plan")
    # the plan has one row per source; Spark broadcasts it when it is measured small
    keyed = sized.join(plan, sized.source.eqNullSafe(plan.source)).drop(plan.source).withColumn(
        "part", F.expr(f"CAST(floor(key / {float(2 ** KEY_BITS)}D * ranges) AS BIGINT)"))
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("o_source"), F.col("part").alias("o_part"),
                          F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")))
              .withColumn("budget", F.round("target").cast("long"))
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long"))
              .withColumn("left", F.col("budget") - F.col("epochs") * F.col("source_size"))
              .withColumn("cut", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("base") - F.col("inside"))).cast("long")))
    return placed.select("doc_id", "size", "source", "source_size", "target", "epochs", "cut", "key",
                         (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken"))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: each document once per whole epoch, once
    more if it lies before its source's cut, and the document that the cut falls on with its
    first ``cut`` words (``n_chars``, if there, follows).

    The cut of a source is one position in its order, so the texts are not shuffled: they meet
    a table with one row per source.  Rows that repeat in id and text and lie on a cut are all
    cut alike.
    """
    order = ["key", "doc_id", "size"]
    after = F.when(F.col("cut") > 0, F.struct(*order, "cut"))
    cuts = scratch_table(mix(docs, **options).groupBy("source").agg(F.max("epochs").alias("_epochs"), F.max(after).alias("_at")), "mix-cuts")
    cuts = cuts.select(F.col("source").alias("_source"), "_epochs", "_at")
    seed = options.get("seed", SEED)
    # the document travels as one struct beside the working columns: its own columns may have any names
    text = F.col("text").cast("string")
    mine = F.struct(_key(F.col("doc_id"), text, seed).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), word_count(text).alias("size"))
    rows = docs.select(F.struct("*").alias("_row"), mine.alias("_mine"), F.col("source").cast("string").alias("_of"))
    rows = rows.join(cuts, F.col("_of").eqNullSafe(F.col("_source")))
    at = F.struct(*[F.col(f"_at.{c}").alias(c) for c in order])
    extra = F.when(F.col("_at").isNull() | (F.col("_mine") > at), F.lit(0)).when(F.col("_mine") < at, F.col("_mine.size")).otherwise(F.col("_at.cut"))
    copies = F.concat(F.array_repeat(F.col("_mine.size"), F.col("_epochs").cast("int")), F.filter(F.array(extra.cast("long")), lambda c: c > 0))
    out = rows.where(F.col("_mine.size") > 0).withColumn("_take", F.explode(copies))
    part = F.col("_take") < F.col("_mine.size")
    # the end of the word number _take: the pattern is built from a bounded number per row
    whole = F.col("_row.text").cast("string")
    first = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), 1), 1, F.col("_take").cast("int")), "")
    out = out.withColumn("_text", F.when(part, first).otherwise(whole))

    def field(f):
        if f.name == "text":
            return F.col("_text").alias("text")
        column = F.col("_row").getField(f.name)
        if f.name == "n_chars":
            column = F.when(part, F.char_length("_text").cast(f.dataType)).otherwise(column)
        return column.alias(f.name)

    return out.select(*[field(f) for f in docs.schema.fields])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
