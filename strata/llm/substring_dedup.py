"""Repeated passages: Rabin-Karp hashes of every window of ``window`` words.

1. Each task hashes its words, rolls a polynomial over every window and settles what it can
   see: of equal windows in one batch all but those of the smallest id are repeats.  Each
   window of a batch then leaves it once, so a passage that stands in a third of all documents
   reaches a reducer once per batch and not once per document.
2. Spark groups the windows by hash; a window is a repeat when the smallest id of its group is
   smaller than its own.
3. The repeats of a document go back to its text, overlapping windows merge into maximal
   intervals of words, and the rest is joined.

Windows are compared by a mixed 64-bit hash of independent word hashes (chance of one false
match among n windows: about n * n / 2**65).

Results for odd input: a null text has no words; a text shorter than a window is never cut; a
document with a null id is kept whole and makes no other a repeat; rows that repeat an id and
its text are cut alike, never because of each other; rows that share an id but not their text
each lose their own repeated windows only; an empty table gives an empty result.
Only the id and the text column are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table, slices, words_of

WINDOW = 13
BATCH_BYTES = 8_000_000
_BASE = 0x9E3779B97F4A7C15
_WORDS_KEPT = 1_000_000


class WordHashes(dict):
    """word -> 64-bit hash, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


def rolled(h: np.ndarray, window: int) -> np.ndarray:
    """Polynomial hash of every run of ``window`` values, by doubling the run length."""
    if len(h) < window:
        return np.zeros(0, np.uint64)
    def joined(left, left_len, right, right_len):
        n = len(h) - left_len - right_len + 1
        return left[:n] * np.uint64(pow(_BASE, right_len, 1 << 64)) + right[left_len:left_len + n]

    done, have, power, n = None, 0, h, 1  # power: hashes of the runs of length n
    while True:
        if window & n:
            done = power if done is None else joined(done, have, power, n)
            have += n
        if have == window:
            break
        power = joined(power, n, power, n)
        n *= 2
    done = done[:len(h) - window + 1].copy()
    done ^= done >> np.uint64(32)
    done *= np.uint64(0xD6E8FEB86659FD93)
    done ^= done >> np.uint64(29)
    return done


def _window_hashes(words: list[list[bytes]], window: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document number and position of every window."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((known[w] for ws in words for w in ws), np.uint64, int(sizes.sum()))
    h = rolled(flat, window)
    doc = np.repeat(np.arange(len(words)), sizes)[:len(h)]
    ends = np.cumsum(sizes)
    position = np.arange(len(h)) - (ends - sizes)[doc]
    inside = position + window <= sizes[doc]
    return h[inside], doc[inside], position[inside]


def _run_key(windows: np.ndarray, ids: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Key of a placed run: the sum of its window hashes, scattered by document and place."""
    return windows.view(np.int64) ^ (ids * 0x2545F4914F6CDD1D + span)


def _open_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in slices(batches, "text", BATCH_BYTES):
            batch = batch.sort_by("doc_id")
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            h, doc, position = _window_hashes([words_of(t) for t in batch.column("text").to_pylist()], window, known)
            if not len(h):
                continue
            order = np.argsort(h, kind="stable")
            first = np.r_[True, h[order][1:] != h[order][:-1]]
            least = np.empty(len(h), np.int64)
            least[order] = np.repeat(ids[doc[order[first]]], np.diff(np.r_[np.flatnonzero(first), len(h)]))
            here = np.flatnonzero(least < ids[doc])
            # repeats that this batch knows already, as runs of windows
            heads = np.flatnonzero(np.r_[True, (here[1:] != here[:-1] + 1) | (doc[here[1:]] != doc[here[:-1]])]) if len(here) else here
            runs = np.diff(np.r_[heads, len(here)])
            at = here[heads] if len(here) else here
            span = position[at] * (1 << 32) + runs
            # the key of a run says which windows it stands for: rows that share an id tell theirs apart by it
            windows = np.add.reduceat(h[here], heads) if len(here) else h[here]
            left = np.sort(order[first])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[h[left].view(np.int64), _run_key(windows, ids[doc[at]], span)]),
                pa.array(np.r_[ids[doc[left]], ids[doc[at]]]),
                pa.array(np.r_[np.zeros(len(left), np.int64), span]),
            ], names=["h", "doc_id", "span"])

    return run


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, spans, hashes``: per document the runs of repeated windows already placed
    (start * 2**32 + count) and the hashes of the others."""
    rows = docs.where("doc_id is not null").mapInArrow(_open_windows(window), "h long, doc_id long, span long")
    # a placed run has a scattered key, so it is its own least id; no column is added to the exchange
    found = (rows.withColumn("least", F.min("doc_id").over(Window.partitionBy("h")))
             .where("span > 0 or least < doc_id"))
    return found.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("span") > 0, F.struct("span", "h"))).alias("spans"),
        F.collect_list(F.when(F.col("span") == 0, F.col("h"))).alias("hashes"))


def _cut(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in slices(batches, "text", BATCH_BYTES):
            out = []
            for doc_id, text, spans, hashes in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans", "hashes"))):
                words = words_of(text)
                gone = np.zeros(len(words) + 1, np.int64)
                starts, ends = [], []
                if spans or hashes:
                    h, _, position = _window_hashes([words], window, known)
                if spans:
                    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)]
                    span = np.array([s["span"] for s in spans], np.int64)
                    a, n = span >> 32, span & 0xFFFFFFFF
                    here = a + n < len(sums)
                    a, n, span, key = a[here], n[here], span[here], np.array([s["h"] for s in spans], np.int64)[here]
                    mine = _run_key(sums[a + n] - sums[a], np.full(len(a), doc_id, np.int64), span) == key
                    starts += a[mine].tolist()
                    ends += (a[mine] + n[mine] + window - 1).tolist()
                if hashes:
                    at = position[np.isin(h, np.array(hashes, np.int64).view(np.uint64))]
                    starts += at.tolist()
                    ends += (at + window).tolist()
                if starts:
                    np.add.at(gone, np.minimum(starts, len(words)), 1)
                    np.add.at(gone, np.minimum(ends, len(words)), -1)
                covered = np.cumsum(gone[:-1]) > 0
                kept = b" ".join(w for w, c in zip(words, covered.tolist()) if not c) if starts else b" ".join(words)
                row = [doc_id, len(words), int(covered.sum()), hashlib.sha256(kept).hexdigest()]
                if with_text:
                    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
                    row += [kept.decode("utf-8", "surrogatepass"), edges.reshape(-1, 2).tolist()]
                out.append(row)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed"][:len(columns)])

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, ``with_text``, ``kept`` (the remaining
    words joined by one space) and ``removed`` (maximal intervals [from, to) of words)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hits = scratch_table(repeats(rows, window).withColumnRenamed("doc_id", "hit_id"), "window-hits")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string, removed array<array<long>>" if with_text else "")
    return (rows.join(hits, rows.doc_id == hits.hit_id, "left").select("doc_id", "text", "spans", "hashes")
            .mapInArrow(_cut(window, with_text), schema))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(load(spark, sf_dir, "documents"), with_text=False)
