"""Language-model scores from a subword lattice.

A public vocabulary gives the subword pieces and their first scores.  A word (its beginning
marked) is the sum over *all* its segmentations into pieces; the log-space forward recursion
over the lattice of a word returns that marginal probability, and a document is the product of
its words and one end mark.  The piece probabilities are re-estimated on the training documents
by expectation-maximisation (forward and backward over the same lattices), weighted by word
counts, so they follow the corpus.  Single-byte pieces cover any text.

``lattice_score`` uses the vocabulary's pieces alone.  For ``score`` a word of the training
documents is one more arc over its whole lattice: ``DISCOUNT`` is taken from every count, and
what it frees weighs the other segmentations, so the sum stays a probability.

Flow.  Tasks turn their documents into arrays of local word numbers and emit each distinct word
of a block once, with its training count; a very frequent word therefore costs one row per
block.  Spark adds up the counts, each distinct word of the corpus goes through the lattice
once, the results return to the blocks, and a document's score is a sum over its numbers.

Results for odd input: a null text is empty and scores as the end mark alone; a null id counts
as empty text in the hash that picks the training rows; repeated rows are ordinary documents;
with no training row the vocabulary's own scores are used; an empty table gives an empty result.
Only the id and the text column are read, so others may have any name.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import held_out, load, scratch_table, slices, words_of

EM_ROUNDS = 2
DISCOUNT = 0.75
BLOCK_WORDS = 400_000
BLOCK_TOKENS = 8_000_000
LATTICE_BYTES = 400_000
START = b" "  # the vocabulary's word-begin mark; cannot occur inside a word
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCKS = "block long, doc_id long, held_out boolean, tokens binary, word binary, number int, n long"


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes and their log probabilities before training.

    The file's scores are ranks; rank r starts with a weight of 1 / (r + 10).  All 256 bytes
    are pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if START not in piece[1:]:
            weight[piece] = max(weight.get(piece, 0.0), 1 / (10 - model.get_score(i)))
    pieces = sorted(weight)
    w = np.array([weight[p] for p in pieces])
    return pieces, np.log(w / w.sum())


class Lattice:
    """Segmentations of many words at once.

    The words (with their begin mark) lie in one byte array.  ``arcs`` are all pieces found in
    it: from byte, to byte, piece.  Positions of different words never meet, so a sweep handles
    all words of a batch one position at a time.
    """

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.by_length = {}
        for n in sorted({len(p) for p in pieces}):
            ids = np.array([i for i, p in enumerate(pieces) if len(p) == n])
            h = np.zeros(len(ids), np.uint64)
            text = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8).reshape(-1, n)
            for k in range(n):
                h = h * _BASE + text[:, k].astype(np.uint64) + np.uint64(1)
            order = np.argsort(h)
            seen = np.zeros(1 << 20, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[n] = (h[order], ids[order], text[order], seen)

    def _arcs(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``ends``: for every byte the end of its word."""
        at, to, piece = [], [], []
        h, alive = np.zeros(len(data), np.uint64), np.arange(len(data))
        longest = max(self.by_length)
        for n in range(1, longest + 1):
            alive = alive[alive + n <= ends[alive]]
            if not len(alive):
                break
            h[alive] = h[alive] * _BASE + data[alive + n - 1].astype(np.uint64) + np.uint64(1)
            if n not in self.by_length:
                continue
            known, ids, text, seen = self.by_length[n]
            maybe = alive[seen[(h[alive] >> np.uint64(44)).astype(np.int64)]]
            place = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            hit = known[place] == h[maybe]
            maybe, place = maybe[hit], place[hit]
            same = (text[place] == data[maybe[:, None] + np.arange(n)]).all(1) if n > 7 else slice(None)
            maybe, place = maybe[same], place[same]
            at.append(maybe)
            to.append(maybe + n)
            piece.append(ids[place])
        return np.concatenate(at), np.concatenate(to), np.concatenate(piece)

    @staticmethod
    def _sweep(size: int, origin: np.ndarray, source: np.ndarray, target: np.ndarray, cost: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Log-space sums over paths: ``target`` takes from ``source``; ``step`` orders the targets."""
        value = np.full(size, -np.inf)
        value[origin] = 0.0
        order = np.lexsort((target, step))
        source, target, cost, step = source[order], target[order], cost[order], step[order]
        edges = np.r_[np.flatnonzero(np.r_[True, step[1:] != step[:-1]]), len(step)]
        for a, b in zip(edges[:-1], edges[1:]):
            v, t = value[source[a:b]] + cost[a:b], target[a:b]
            heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            top = np.maximum.reduceat(v, heads)
            spread = np.repeat(top, np.diff(np.r_[heads, b - a]))
            value[t[heads]] = top + np.log(np.add.reduceat(np.exp(v - spread), heads))
        return value

    def run(self, words: list[bytes], log_p: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural-log marginal of every word; with ``counts`` also the expected piece counts."""
        marked = [START + w + b"\n" for w in words]  # one spare byte: the position after the word
        data = np.frombuffer(b"".join(marked), np.uint8)
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        stop = np.cumsum(sizes)
        first, last = stop - sizes, stop - 1
        at, to, piece = self._arcs(data, np.repeat(last, sizes))
        start = np.repeat(first, sizes)
        forward = self._sweep(len(data), first, at, to, log_p[piece], (to - start[to]))
        total = forward[last]
        if counts is None:
            return total, None
        backward = self._sweep(len(data), last, to, at, log_p[piece], np.repeat(last, sizes)[at] - at)
        word = np.repeat(np.arange(len(words)), sizes)[at]
        share = np.exp(forward[at] + log_p[piece] + backward[to] - total[word]) * counts[word]
        return total, np.bincount(piece, share, minlength=len(self.pieces))


def _batches(words: list[bytes], limit: int = LATTICE_BYTES) -> Iterator[slice]:
    start = size = 0
    for i, w in enumerate(words):
        if size and size + len(w) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(w) + 2
    if start < len(words):
        yield slice(start, len(words))


# ------------------------------------------------------------------------------------- blocks
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> rows of word numbers, then the distinct words of the block."""
    number: dict[bytes, int] = {}
    training, tokens = np.zeros(0, np.int64), 0
    block = int.from_bytes(os.urandom(7), "little")

    def flush():
        words = list(number)
        for a in range(0, len(words), 100_000):
            part = words[a:a + 100_000]
            none = [None] * len(part)
            yield rows(block, none, none, none, part, range(a, a + len(part)), training[a:a + len(part)])

    def rows(block, doc_id, held, token_bytes, words, numbers, n):
        size = len(doc_id)
        return pa.RecordBatch.from_arrays([
            pa.array([block] * size, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(held, pa.bool_()), pa.array(token_bytes, pa.binary()),
            pa.array(words, pa.binary()), pa.array(numbers, pa.int32()), pa.array(n, pa.int64()),
        ], names=["block", "doc_id", "held_out", "tokens", "word", "number", "n"])

    for batch in slices(batches, "text", 4_000_000, 5_000):
        ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
        texts = [words_of(t, fold=True) for t in batch.column("text").to_pylist()]
        for words in texts:
            for w in words:
                if w not in number:
                    number[w] = len(number)
        coded = [np.fromiter((number[w] for w in words), np.int32, len(words)) for words in texts]
        learn = [c for c, h in zip(coded, held) if not h]
        more = np.bincount(np.concatenate(learn), minlength=len(number)) if learn else np.zeros(len(number), np.int64)
        training = np.r_[training, np.zeros(len(number) - len(training), np.int64)] + more
        tokens += sum(map(len, coded))
        none = [None] * len(ids)
        yield rows(block, ids, held, [zlib.compress(c.tobytes(), 1) for c in coded], none, none, none)
        if len(number) >= BLOCK_WORDS or tokens >= BLOCK_TOKENS:
            yield from flush()
            number, training, tokens = {}, np.zeros(0, np.int64), 0
            block = int.from_bytes(os.urandom(7), "little")
    yield from flush()


def _expected(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, log_p = shared.value
        lattice, total = Lattice(pieces), np.zeros(len(pieces))
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("c").to_numpy(zero_copy_only=False)
            for part in _batches(words):
                total += lattice.run(words[part], log_p, counts[part].astype(float))[1]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["piece", "n"])

    return run


def _marginals(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, log_p = shared.value
        lattice = Lattice(pieces)
        for batch in batches:
            words = batch.column("word").to_pylist()
            parts = [lattice.run(words[p], log_p)[0] for p in _batches(words)]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                                             names=["word", "c", "lp"])

    return run


def _documents(n_train: int, distinct: int, end_count: int, end_lp: float):
    def run(words: pa.Table, docs: pa.Table) -> pa.Table:
        size = words.num_rows
        c, lp = np.zeros(size, np.int64), np.zeros(size)
        number = words["number"].to_numpy()
        c[number], lp[number] = words["c"].to_numpy(), words["lp"].to_numpy()
        whole, end_whole = lp, end_lp
        if n_train:
            freed = DISCOUNT * distinct / n_train
            whole = np.logaddexp(np.log(np.maximum(c - DISCOUNT, 1e-300) / n_train), lp + np.log(freed))
            end_whole = np.log((end_count - DISCOUNT) / n_train + freed * np.exp(end_lp))
        base = np.log10((c + 0.5) / (n_train + 0.5 * (distinct + 1)))
        end_base = np.log10((end_count + 0.5) / (n_train + 0.5 * (distinct + 1)))
        out = []
        for packed in docs["tokens"].to_pylist():
            t = np.frombuffer(zlib.decompress(packed), np.int32)
            out.append((len(t) + 1, int((c[t] > 0).sum()) + (end_count > 0), float(base[t].sum() + end_base),
                        float((whole[t].sum() + end_whole) / np.log(10)), float((lp[t].sum() + end_lp) / np.log(10))))
        n, known, b, s, pure = zip(*out) if out else ((), (), (), (), ())
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array([n_train] * len(n), pa.int64()), "base_score": pa.array(b, pa.float64()), "score": pa.array(s, pa.float64()),
                         "lattice_score": pa.array(pure, pa.float64())})

    return run


def lm_score(docs: DataFrame, is_held_out: Column, path: str | None = None, rounds: int = EM_ROUNDS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    lattice_score`` per document (log10).

    ``is_held_out`` is a condition over ``doc_id``; all other rows train the model.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("held_out", is_held_out)
    blocks = scratch_table(rows.mapInArrow(_blocks, _BLOCKS), "lm-blocks")
    local = blocks.where("word is not null")
    words = scratch_table(local.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    seen = words.where("c > 0").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    ends = blocks.where("tokens is not null and not held_out").count()
    n_train, distinct = (seen["n"] or 0) + ends, seen["v"] + (ends > 0)

    pieces, log_p = vocabulary(path or vocabulary_path())
    log_end = np.log(1e-3)
    log_p = log_p + np.log1p(-1e-3)
    for _ in range(rounds if ends else 0):
        shared = context.broadcast((pieces, log_p))  # as large as the vocabulary
        counts = np.full(len(pieces), 0.01)
        sums = words.where("c > 0").mapInArrow(_expected(shared), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        for r in sums.collect():  # at most one row per piece
            counts[r["piece"]] += r["n"]
        total = counts.sum() + ends
        log_p, log_end = np.log(counts / total), float(np.log(ends / total))
    shared = context.broadcast((pieces, log_p))
    scored = words.mapInArrow(_marginals(shared), "word binary, c long, lp double")
    replies = local.select("block", "number", "word").join(scored, "word").select("block", "number", "c", "lp")
    coded = blocks.where("tokens is not null").select(F.col("block").alias("of_block"), "doc_id", "held_out", "tokens")
    return replies.groupBy("block").cogroup(coded.groupBy("of_block")).applyInArrow(
        _documents(n_train, distinct, ends, log_end),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, lattice_score double")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(load(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 1))
