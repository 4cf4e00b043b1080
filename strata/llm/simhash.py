"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: 64 bits over word shingles hashed with XXH64, majority per bit.  Two of them are
linked at ``max_bits`` or fewer differing bits; documents are grouped by connected components.

Search.  Distinct fingerprints only (copies share one).  ``max_bits + 1`` bit blocks route a
fingerprint to one bucket per block: two linked fingerprints agree in at least one block.  A
bucket above ``SPLIT_ROWS`` is divided again by blocks of its free bits, which keeps the
guarantee, so no bucket grows without end.  Inside a task the fingerprints of a bucket are sorted by
their rank in the Gray code, where neighbours differ in few bits; runs of ``FANOUT`` nodes get
a parent that holds the bits all of them share (mask and pattern), level by level.  A search
walks down from the root, adds up the differences in the bits that each level contributes, and
drops a whole subtree as soon as the sum exceeds ``max_bits``.  A task returns spanning links
of what it found, not all pairs of a group.

Results for odd input: null and empty texts have fingerprint zero, which is linked like any
other; null ids get a fingerprint and pass links on, and a component's id is its smallest
non-null id; repeated rows are ordinary documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import gather, load, row_key, rows_with_key, scratch_table, shuffle_width, slices, text_sha, words_of
from strata.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
FANOUT = 8
FRONTIER = 2_000_000
SPLIT_ROWS = 20_000
SPLIT_ROUNDS = 3


# ------------------------------------------------------------------------------ fingerprints
def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of every text as uint64."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for at, text in enumerate(texts):
        words = words_of(text, fold=True)
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle:
            out[at] = digest(line, SEED)
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        first = [0, *(ends[:-shingle] + 1).tolist()]
        last = ends[shingle - 1:].tolist()
        set_bits = np.zeros(64, np.int64)
        for a in range(0, len(first), 1 << 16):
            h = np.array([digest(line[i:j], SEED) for i, j in zip(first[a:a + (1 << 16)], last[a:a + (1 << 16)])], np.uint64)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            set_bits += np.add.reduce(bits, axis=0, dtype=np.int64)
        out[at] = weights[set_bits * 2 > len(first)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long), and ``keep`` as ``key`` if given."""
    extra = [] if keep is None else [keep.alias("key")]
    kept = ["doc_id", "key"][:1 + len(extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            fps = fingerprints_of(batch.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(fps.view(np.int64))], names=[*kept, "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra).mapInArrow(
        run, "doc_id long, key string, fp long" if extra else "doc_id long, fp long")


# ------------------------------------------------------------------------------------- index
def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of a bit string in the reflected Gray code."""
    rank = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class GrayIndex:
    """Hierarchical index over fingerprints in several buckets, each with a root of its own.

    ``levels[0]`` are the leaves in (bucket, Gray rank) order; a node of a level covers
    ``FANOUT`` consecutive nodes below it in the same bucket.  A node stores only the bits that
    it shares beyond those its parent stores.
    """

    def __init__(self, bucket: np.ndarray, fp: np.ndarray):
        order = np.lexsort((gray_rank(fp), bucket))
        self.order, self.fp = order, fp[order]
        bucket = bucket[order]
        n = len(fp)
        mask, pattern = np.full(n, ~np.uint64(0)), self.fp
        first_leaf, last_leaf = np.arange(n), np.arange(n)
        self.levels = []  # (own mask, pattern, last leaf, first child, children), leaves first
        child_from = child_n = np.zeros(n, np.int64)
        while True:
            level = [mask, pattern, last_leaf, child_from, child_n]
            self.levels.append(level)
            heads = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[heads, len(bucket)])
            if not len(bucket) or sizes.max() == 1:
                break
            place = np.arange(len(bucket)) - np.repeat(heads, sizes)
            starts = np.flatnonzero(place % FANOUT == 0)
            child_n = np.diff(np.r_[starts, len(bucket)])
            parent = np.repeat(np.arange(len(starts)), child_n)
            differs = np.bitwise_or.reduceat(pattern ^ pattern[starts][parent], starts)
            up_mask = np.bitwise_and.reduceat(mask, starts) & ~differs
            level[0] = mask & ~up_mask[parent]
            mask, pattern = up_mask, pattern[starts] & up_mask
            bucket, first_leaf, last_leaf = bucket[starts], first_leaf[starts], last_leaf[starts + child_n - 1]
            child_from = starts
        self.roots = np.repeat(np.arange(len(bucket)), np.diff(np.r_[first_leaf, n])) if n else np.zeros(0, np.int64)

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaf positions (i < j) within ``max_bits``, for blocks of i."""
        block = max(1, FRONTIER // max(1, np.bincount(self.roots).max(initial=1)))
        for a in range(0, len(self.fp), block):
            q = np.arange(a, min(a + block, len(self.fp)))
            node, sums = self.roots[q], np.zeros(len(q), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                own, pattern, last_leaf, child_from, child_n = self.levels[depth]
                sums = sums + np.bitwise_count((self.fp[q] ^ pattern[node]) & own[node])
                # a subtree is dropped when its shared bits differ too much, or lies before i
                keep = (sums <= max_bits) & (last_leaf[node] > q)
                q, node, sums = q[keep], node[keep], sums[keep]
                if depth:
                    n = child_n[node]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    q, sums, node = np.repeat(q, n), np.repeat(sums, n), np.repeat(child_from[node], n) + step
            yield q, node


def _spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least position of each position's component."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low != high
            if not open_.any():
                break
            i, j = i[open_], j[open_]
            np.minimum.at(label, high[open_], low[open_])
            while True:  # every position points to its root
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, fp = gather(batches, "bucket", "fp")
        if not len(fp):
            return
        index = GrayIndex(bucket, fp.view(np.uint64))
        root = _spanning(len(fp), index.links(max_bits))
        at = np.flatnonzero(root != np.arange(len(root)))
        fp = index.fp.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[root[at]])], names=["u", "v"])

    return run


def _blocks(free: list[int], n: int) -> list[list[int]]:
    return [b for b in (free[i * len(free) // n:(i + 1) * len(free) // n] for i in range(n)) if b]


def _bits(bits: list[int]) -> int:
    return sum(1 << b for b in bits) - ((1 << 64) if 63 in bits else 0)


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, partitions: int | None = None) -> DataFrame:
    """Distinct ``fp`` -> spanning links ``u, v`` of everything within ``max_bits``."""
    n = partitions or shuffle_width(distinct.sparkSession)
    # (name of the bucket family, rows with their bucket, bits still free in that family)
    families = [(distinct.withColumn("bucket", F.lit(0).cast("long")), list(range(64)))]
    found = []
    for depth in range(SPLIT_ROUNDS + 1):
        finer = []
        for rows, free in families:
            for number, block in enumerate(_blocks(free, max_bits + 1)):
                value = F.col("fp").bitwiseAND(F.lit(_bits(block)))
                finer.append((rows.withColumn("bucket", F.xxhash64("bucket", F.lit(number), value)), [b for b in free if b not in block]))
        if depth == SPLIT_ROUNDS:
            found += [rows for rows, _ in finer]
            break
        families = []
        keyed = [rows.withColumn("family", F.lit(i)) for i, (rows, _) in enumerate(finer)]
        everything = keyed[0]
        for k in keyed[1:]:
            everything = everything.unionByName(k)
        large = scratch_table(everything.groupBy("family", "bucket").count().where(F.col("count") > SPLIT_ROWS).select("family", "bucket"), "hot-buckets")
        hot = {r["family"] for r in large.select("family").distinct().collect()}
        for i, (rows, free) in enumerate(finer):
            if i not in hot:
                found.append(rows)
                continue
            mine = large.where(F.col("family") == i).select("bucket")
            found.append(rows.join(mine, "bucket", "left_anti").select("fp", "bucket"))
            families.append((rows.join(mine, "bucket", "left_semi").select("fp", "bucket"), free))
        if not families:
            break
    rows = found[0].select("bucket", "fp")
    for more in found[1:]:
        rows = rows.unionByName(more.select("bucket", "fp"))
    return rows.repartition(n, "bucket").mapInArrow(_links(max_bits), "u long, v long")


def grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, least_id, root``: every distinct fingerprint with its least document and its group."""
    distinct = scratch_table(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fp")
    roots = connected_components(near_links(distinct.select("fp"), max_bits))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every document."""
    fps = scratch_table(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    rooted = grouped(fps, max_bits)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = scratch_table(rooted.join(least, "root").select("fp", "component_id"), "components")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_rows(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, the one with the smallest id (null last; equal ids: the least text hash); all
    columns, which may have any names.  Rows that repeat in id and text are one document."""
    sha = text_sha(F.col("text"))
    fps = scratch_table(fingerprints(docs, shingle, keep=row_key(F.col("doc_id"), sha)), "fingerprints")
    groups = grouped(fps, max_bits)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    kept = fps.join(groups, "fp").groupBy("root").agg(F.min(first).alias("first"))
    return rows_with_key(docs, kept.select("first.key"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(load(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
