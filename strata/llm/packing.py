"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

1. Each document is tokenised, closed with an end id and cut into pieces: whole sequences of
   ``capacity`` ids and one rest.  Tokens never leave the task; a piece is its start, length
   and checksum.
2. The histogram of piece lengths (at most ``capacity`` rows, however many documents) goes
   through shortest-pack-first: lengths longest first, each placed into the packs with the most
   room, whole groups of equal packs at a time.  A *pattern* is a list of lengths with the
   number of packs that use it.
3. The patterns are joined back by rank: the pieces of one length are numbered (two-level
   prefix sums, so a length that holds a third of all pieces is numbered by many tasks), and a
   slot of a pattern owns a range of numbers.

Results for odd input: a null text is empty; an empty document is the end id alone; null ids
and repeated rows are ordinary documents; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table, slices

END = 1
CAPACITY = 2048
RANGE_ROWS = 512
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long"
_CACHE_WORDS = 400_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of the byte-level BPE file, the same as ``tokenizers`` gives.

    BPE works on each word of the pre-tokeniser's split alone, so ids are kept by word.  Texts
    of Latin-1 characters are split by one regular expression and unseen words are merged by
    ``tiktoken`` with the file's own vocabulary; any other text goes to ``tokenizers`` whole.
    """

    # letters, digits and white space of Latin-1, as the pre-tokeniser classes them
    _L = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
    _N = "0-9²³¹¼-¾"
    _S = r" \t\n\r\x0b\x0c\x85\xa0"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self._special = [t["content"] for t in spec.get("added_tokens", [])]
        self._plain = re.compile("[\x00-\xff]*")
        w, d, s = self._L, self._N, self._S
        self._split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{w}]+| ?[{d}]+| ?[^{s}{w}{d}]+|[{s}]+(?![^{s}])|[{s}]+")
        self._ids: dict[str, list[int]] = {}
        self._merge = None
        if pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer"):
            self._merge = self._merger(model)

    def _merger(self, model: dict):
        """``tiktoken`` over the file's vocabulary, if its ids are in merge order (else None)."""
        import tiktoken

        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocab["".join(m)] for m in pairs]
        if made != sorted(made):
            return None
        # printable bytes stand for themselves, the others for the characters from U+0100 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in self._special}
        return tiktoken.Encoding("file", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def _word(self, word: str) -> list[int]:
        ids = self._merge.encode_ordinary(word)
        if len(self._ids) >= _CACHE_WORDS:
            self._ids.clear()
        if len(word) < 64:
            self._ids[word] = ids
        return ids

    def __call__(self, text: str) -> np.ndarray:
        if not self._merge or not self._plain.fullmatch(text) or any(t in text for t in self._special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        known, out = self._ids, []
        for word in self._split.findall(text):
            ids = known.get(word)
            out += self._word(word) if ids is None else ids
        return np.array(out, np.uint32)


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for batch in slices(batches, "text", 4_000_000):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(zip(*rows))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Histogram of lengths -> patterns ``(number of packs, lengths in the pack)``.

    ``room[r]`` holds the open patterns with ``r`` ids left.  The longest length goes to the
    packs with the most room; if a pattern has more packs than there are pieces left, it is
    divided.  The work depends on the capacity, not on the counts.
    """
    room: list[list[list]] = [[] for _ in range(capacity + 1)]
    widest = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        while left:
            while widest and not room[widest]:
                widest -= 1
            if widest < length:
                # no pack has room: a new pack takes this length until it is full, then the next
                fits = min(capacity // length, left)
                count, pattern, space = left // fits, (), capacity
            else:
                fits, space = 1, widest
                count, pattern = room[widest].pop()
                if count > left:
                    room[widest].append([count - left, pattern])
                    count = left
            rest = space - fits * length
            room[rest].append([count, pattern + (length,) * fits])
            left -= count * fits
            widest = max(widest, rest)
    return [(n, p) for packs in room for n, p in packs]


def _slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """``length, first rank, end rank, first sequence, offset`` for every slot of every pattern."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for n in lengths:
            first = used.get(n, 0)
            used[n] = first + count
            rows.append((n, first, first + count, sequence, offset))
            offset += n
        sequence += count
    return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = scratch_table(rows.mapInArrow(_pieces(tokenizer or tokenizer_path(), capacity, end), _PIECES), "pieces")
    # the pieces of one length in hash order, cut into ranges whose number follows from the count
    histogram = scratch_table(pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    counts = {r["length"]: r["n"] for r in histogram.collect()}  # at most ``capacity`` rows
    slots = _slots(shortest_pack_first(counts, capacity)) if counts else []
    table = spark.createDataFrame(slots, "s_length long, first long, last long, sequence long, offset long")
    keyed = (pieces.join(F.broadcast(histogram), "length")
             .withColumn("key", F.shiftrightunsigned(F.xxhash64("doc_id", "start"), 2))
             .withColumn("part", F.expr(f"CAST(floor(key / {float(2 ** 62)}D * ceil(n / {RANGE_ROWS})) AS BIGINT)")))
    sums = keyed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("length").alias("b_length"), F.col("part").alias("b_part"),
                        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy("key", "doc_id", "start", "ids_crc32")
    ranked = (keyed.withColumn("inside", F.row_number().over(inside) - 1)
              .join(bases, (F.col("length") == F.col("b_length")) & (F.col("part") == F.col("b_part")))
              .withColumn("rank", F.col("base") + F.col("inside")))
    # slots: bounded by the capacity (each length opens or extends few patterns), not by the documents
    placed = ranked.join(F.broadcast(table), (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequences, tokens, padded``: a sequence is padded to the capacity unless its length is a power of two."""
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    full = F.when(F.expr("n & (n - 1)") == 0, F.col("n")).otherwise(F.lit(capacity))
    return per.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.sum(full - F.col("n")).alias("padded"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))
