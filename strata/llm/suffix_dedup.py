"""Repeated byte strings by a distributed suffix array (difference cover).

A byte goes when it is covered by a string of ``length`` bytes that also starts in a document
with a smaller id.

Distribution.  Every string of ``length`` bytes has an anchor: the least hash of its 20-byte
substrings.  Equal strings have equal anchors, so they meet in the same task when text is dealt
out by anchor, and a run of neighbouring strings with one anchor travels as one segment of text.
A first pass counts anchors; text around anchors that only one document has never travels.

Suffix order.  In a task the segments of its anchors form one text, sorted by the difference
cover mod 3: the triples at positions 1 and 2 (mod 3) are sorted and named, names that are not
yet unique are sorted by recursion on the string of names, the remaining suffixes are sorted by
(first byte, rank of the next) and merged in.  Neighbours in the order are compared over
``length`` bytes; those that agree form a class whose smallest id marks all others.

Skew.  A batch settles what it can see: of equal segments only that of the smallest id leaves
it, and an anchor that several of its documents share needs no count.  So the inner anchors of a
passage that stands in a third of all documents reach a task once per batch.  Anchors near its
edges bring each document's own neighbouring bytes along.  If the distinct segments of an anchor
hold more than ``SORT_BYTES``, its strings are dealt out again one by one, by their own hash, and a
batch sends each string once, with its least id.  Only anchors of more than ``SORT_BYTES`` /
(2 ``length`` - ``ANCHOR``) documents are measured; one that fewer documents repeat with ever
other neighbours stays whole.

Results for odd input: a null text is empty; texts shorter than ``length`` are kept whole; a
document with a null id is kept whole and makes no other a repeat; rows that repeat an id and
its text are cut alike, never because of each other; rows that share an id but not their text
share the intervals of both; an empty table gives an empty result.
Only the id and the text column are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table, shuffle_width, slices
from strata.llm.substring_dedup import rolled

LENGTH = 50
ANCHOR = 20
BATCH_BYTES = 3_000_000
SORT_BYTES = 1_200_000
_MIX = 0x2545F4914F6CDD1D


# ------------------------------------------------------------------------------- suffix array
def suffix_array(s: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Positions of the suffixes of ``s`` (values >= 1) in order, by difference cover mod 3.

    With ``depth`` only the first ``depth`` values count: the recursion ends as soon as names cover
    them, and suffixes that agree so far stand together in any order."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.zeros(n + 5, np.int32 if n < 2 ** 30 and s.max() < 2 ** 31 else np.int64)
    t[:n] = s
    ones, twos = (n + (n % 3 == 1) + 1) // 3, (n + (n % 3 == 1)) // 3
    sampled = lambda v, k: np.concatenate([v[1 + k::3][:ones], v[2 + k::3][:twos]])
    order, name = _named(sampled(t, 0), sampled(t, 1), sampled(t, 2))
    if name[order[-1]] < len(order) and (depth is None or depth > 3):
        # the recursion: the string of names, class 1 before class 2
        order = suffix_array(name, None if depth is None else -(-depth // 3))
    ordered = np.where(order < ones, 3 * order + 1, 3 * (order - ones) + 2)
    rank = np.zeros(n + 5, t.dtype)
    rank[ordered] = np.arange(1, len(ordered) + 1)
    known, after = t[0:n:3], rank[1:n + 1:3]
    by = _order(known, after)
    rest, known, after = 3 * by, known[by], after[by]
    ordered = ordered[ordered < n]
    one = ordered % 3 == 1
    one, two = ordered[one], ordered[~one]
    before = _less((t[one], rank[one + 1]), (known, after)) + _less((t[two], t[two + 1], rank[two + 2]), (known, t[rest + 1], rank[rest + 2]))
    out, free = np.empty(n, np.int64), np.ones(n, bool)
    # suffixes that agree over the depth may be asked for out of order, never beyond their group
    at = np.arange(len(rest)) + np.maximum.accumulate(before)
    out[at], free[at] = rest, False
    out[free] = ordered
    return out


def _packed(columns: tuple[np.ndarray, ...], tops: list[int]) -> np.ndarray | None:
    """Columns as one integer that sorts alike, if it fits."""
    room = 1
    for top in tops:
        room *= top + 1
    if room >= 2 ** 62:
        return None
    key = columns[0].astype(np.int64)
    for c, top in zip(columns[1:], tops[1:]):
        key = key * (top + 1) + c
    return key


def _tops(*groups) -> list[int]:
    return [max(int(c.max(initial=0)) for c in same) for same in zip(*groups)]


def _order(*columns: np.ndarray) -> np.ndarray:
    key = _packed(columns, _tops(columns))
    return np.lexsort(columns[::-1]) if key is None else np.argsort(key)


def _named(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = _order(*columns)
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new) + 1
    return order, name


def _less(known: tuple[np.ndarray, ...], asked: tuple[np.ndarray, ...]) -> np.ndarray:
    """How many of the (sorted) known keys are smaller than each asked key."""
    tops = _tops(known, asked)
    a, b = _packed(known, tops), _packed(asked, tops)
    if a is None:
        both = tuple(np.r_[k, q] for k, q in zip(known, asked))
        _, name = _named(*both)
        a, b = name[:len(known[0])], name[len(known[0]):]
    return np.searchsorted(a, b)


def classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the suffixes of ``text`` by their first ``length`` bytes and, for each place in it, the class of those."""
    n = len(text)
    order = suffix_array(text.astype(np.int64) + 1, length)
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)])
    word = np.ndarray(n + length, np.uint64, padded.data, strides=(1,)).copy()  # the eight bytes from each place on
    last = word[order + max(0, length - 8)]  # neighbours mostly differ at the end, if at all
    same = last[1:] == last[:-1]
    for k in range(0, length - 8, 8):
        at = np.flatnonzero(same)
        same[at] = word[order[at] + k] == word[order[at + 1] + k]
    return order, np.cumsum(np.concatenate([[True], ~same])[:n]) - 1


# ------------------------------------------------------------------------------------ anchors
def _anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every string of ``length`` bytes: its anchor, document number and start; and the text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    least = rolled(data.astype(np.uint64) + np.uint64(257), ANCHOR)
    width, n = length - ANCHOR + 1, 1
    while 2 * n <= width:
        least, n = np.minimum(least[:-n], least[n:]) if len(least) > n else least[:0], 2 * n
    if width > n:
        least = np.minimum(least[:len(least) - (width - n)], least[width - n:]) if len(least) > width - n else least[:0]
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    start = np.arange(len(least)) - (np.cumsum(sizes) - sizes)[doc]
    inside = start + length <= sizes[doc]
    return least[inside], doc[inside], start[inside], data


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _counted(length: int):
    """Anchors of the documents: open ones keyed by themselves, those a batch knows to be shared by a scattered key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            anchor, doc, _, _ = _anchors(_bytes(batch.column("text")), length)
            if not len(anchor):
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            head = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
            anchor, owner = anchor[head].view(np.int64), ids[doc[head]]
            order = np.lexsort((owner, anchor))
            a, o = anchor[order], owner[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (o[1:] != o[:-1])]
            order, a, o = order[new], a[new], o[new]
            group = np.cumsum(np.r_[True, a[1:] != a[:-1]]) - 1
            shared = np.bincount(group)[group] > 1
            back = np.argsort(order)  # in the order of the documents: neighbours compress
            a, o, shared = a[back], o[back], shared[back]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(shared, a ^ (o * _MIX), a)), pa.array(o), pa.array(np.where(shared, a, 0)),
            ], names=["key", "doc_id", "known"])
            # one of the sharers speaks for the batch towards the others
            if shared.any():
                first, at = np.unique(a[shared], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(o[shared][at]), pa.array(np.zeros(len(first), np.int64))],
                                                 names=["key", "doc_id", "known"])

    return run


def shared_anchors(rows: DataFrame, length: int) -> DataFrame:
    """``doc_id, anchors``: anchors that at least one other document has."""
    counted = rows.where("doc_id is not null").mapInArrow(_counted(length), "key long, doc_id long, known long")
    window = Window.partitionBy("key")
    found = counted.withColumn("low", F.min("doc_id").over(window)).withColumn("high", F.max("doc_id").over(window))
    return (found.where("known != 0 or low != high").groupBy("doc_id")
            .agg(F.collect_list(F.when(F.col("known") != 0, F.col("known")).otherwise(F.col("key"))).alias("anchors")))


# ----------------------------------------------------------------------------------- segments
_SEGMENT = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])


def _listed(lists: pa.ListArray, doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whether each anchor is in the list of its document."""
    owner, listed = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy(zero_copy_only=False)
    if not len(listed):
        return np.zeros(len(doc), bool)
    code = lambda d, a: a.view(np.uint64) * np.uint64(_MIX) + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    known, mine = np.unique(code(owner, listed)), code(doc, anchor)
    return known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine


def _hash(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little")


def _strings(piece: bytes, n: int, length: int) -> Iterator[tuple[int, int, bytes]]:
    """The ``n`` strings of a segment as ``(place, count, string)``; neighbours that are equal (one byte throughout) stay together."""
    at = 0
    while at < n:
        string, m = piece[at:at + length], 1
        while at + m < n and piece[at + m + length - 1] == string[0] and piece.startswith(string, at + m):
            m += 1
        yield at, m, string
        at += m


def _segments(length: int):
    """Runs of strings with one shared anchor, as text; repeats inside the batch leave as placed runs (no text).

    The strings of a hot anchor go one by one, under their own hash."""

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        a, me, b, n, piece = zip(*out)
        key = np.array([x & 0xFFFFFFFFFFFFFFFF for x in a], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(me, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()),
                                           pa.array(piece, pa.binary())], schema=_SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            batch = batch.sort_by("doc_id")
            ids = batch.column("doc_id").to_pylist()
            texts = _bytes(batch.column("text"))
            anchor, doc, start, _ = _anchors(texts, length)
            head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]) if len(anchor) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[head, len(anchor)])
            # a string takes part if (document, anchor) is listed
            take = _listed(batch.column("anchors"), doc[head], anchor[head])
            head, sizes = head[take], sizes[take]
            hot = _listed(batch.column("hot"), doc[head], anchor[head])
            seen: dict[bytes, int] = {}
            strings: dict[bytes, int] = {}
            out = []
            for a, d, b, n, split in zip(anchor[head].view(np.int64).tolist(), doc[head].tolist(), start[head].tolist(), sizes.tolist(), hot.tolist()):
                piece, me = texts[d][b:b + n + length - 1], ids[d]
                first = seen.setdefault(piece, me)
                if first < me:  # documents come in id order
                    out.append((a ^ (me * 31 + b), me, b, n, None))
                elif not split:
                    out.append((a, me, b, n, piece))
                else:
                    for at, m, string in _strings(piece, n, length):
                        if strings.setdefault(string, me) < me:
                            out.append((a ^ (me * 31 + b + at), me, b + at, m, None))
                        else:
                            out.append((_hash(string), me, b + at, m, piece[at:at + m + length - 1]))
                        if len(out) >= 50_000:
                            yield rows_of(out)
                            out = []
            if out:
                yield rows_of(out)

    return run


def _marked(pieces: pa.Array, owner: np.ndarray, start: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs ``doc_id, start, n`` of strings that a smaller id has too, among segments of some anchors."""
    coded = pieces.cast(pa.large_binary()).dictionary_encode()
    which, distinct = coded.indices.to_numpy(), coded.dictionary
    edges = np.frombuffer(distinct.buffers()[1], np.int64)[:len(distinct) + 1]
    offset, sizes = edges[:-1], np.diff(edges)
    order, group = classes(np.frombuffer(distinct.buffers()[2], np.uint8)[:edges[-1]], length)
    least_of = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least_of, which, owner)
    piece_of = np.repeat(np.arange(len(distinct)), sizes)
    whole = np.arange(sizes.sum()) - offset[piece_of] + length <= sizes[piece_of]
    value = np.where(whole, least_of[piece_of], np.iinfo(np.int64).max)[order]
    least = np.empty(len(order), np.int64)
    least[order] = np.minimum.reduceat(value, np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))[group]
    # every string of every segment against the least id of its class
    row = np.repeat(np.arange(len(which)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    hit = np.flatnonzero(least[offset[which[row]] + step] < owner[row])
    heads = hit[np.r_[True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])]] if len(hit) else hit
    counts = np.diff(np.r_[np.searchsorted(hit, heads), len(hit)])
    return owner[row[heads]], start[row[heads]] + step[heads], counts


def _measured(length: int):
    """Distinct segments of the listed anchors: anchor, hash of the segment, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = _bytes(batch.column("text"))
            anchor, doc, start, _ = _anchors(texts, length)
            if not len(anchor):
                continue
            head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
            sizes = np.diff(np.r_[head, len(anchor)])
            take = _listed(batch.column("hot"), doc[head], anchor[head])
            head, sizes = head[take], sizes[take] + length - 1
            found = {(a, _hash(texts[d][b:b + n])): n for a, d, b, n in
                     zip(anchor[head].view(np.int64).tolist(), doc[head].tolist(), start[head].tolist(), sizes.tolist())}
            if found:
                a, h = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(list(found.values()), pa.int64())],
                                                 names=["anchor", "piece", "n"])

    return run


def _lists(pairs: DataFrame, anchors: DataFrame) -> DataFrame:
    """``doc_id, hot``: per document those of its anchors that are in ``anchors``."""
    return pairs.join(anchors, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("anchor").alias("hot"))


def hot_anchors(rows: DataFrame, shared: DataFrame, length: int) -> DataFrame | None:
    """``doc_id, hot``: anchors whose distinct segments hold more than ``SORT_BYTES``; None if no anchor has enough documents."""
    pairs = shared.select("doc_id", F.explode("anchors").alias("anchor"))
    common = scratch_table(pairs.groupBy("anchor").count().where(F.col("count") > SORT_BYTES // (2 * length - ANCHOR)).select("anchor"), "common-anchors")
    if common.isEmpty():
        return None
    held = scratch_table(_lists(pairs, common), "common-lists")
    pieces = rows.join(held, "doc_id").select("text", "hot").mapInArrow(_measured(length), "anchor long, piece long, n long")
    large = pieces.groupBy("anchor", "piece").agg(F.max("n").alias("n")).groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > SORT_BYTES)
    large = scratch_table(large.select("anchor"), "hot-anchors")
    if large.isEmpty():
        return None
    return scratch_table(_lists(held.select("doc_id", F.explode("hot").alias("anchor")), large), "hot-lists")


def dealt_segments(rows: DataFrame, length: int) -> DataFrame:
    """``anchor, doc_id, start, n, text``: what travels; ``anchor`` is the string's own hash where an anchor is hot."""
    shared = scratch_table(shared_anchors(rows, length), "anchors")
    hot = hot_anchors(rows, shared, length)
    none = F.array().cast("array<long>")
    listed = rows.join(shared, "doc_id")
    listed = listed.withColumn("hot", none) if hot is None else listed.join(hot, "doc_id", "left").withColumn("hot", F.coalesce("hot", none))
    return listed.select("doc_id", "text", "anchors", "hot").mapInArrow(_segments(length), "anchor long, doc_id long, start long, n long, text binary")


def _compared(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def sort():
            pieces = pa.chunked_array([b.column("text").cast(pa.large_binary()) for b in held]).combine_chunks()
            column = lambda name: np.concatenate([b.column(name).to_numpy() for b in held])
            ids, start, n = _marked(pieces, column("doc_id"), column("start"), column("n"), length)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "start", "n"])

        for batch in batches:
            text = batch.column("text")
            if text.null_count:
                yield batch.filter(text.is_null()).select(["doc_id", "start", "n"])
                batch = batch.filter(text.is_valid())
            while batch.num_rows:
                anchor = batch.column("anchor").to_numpy()
                sizes = pc.binary_length(batch.column("text")).to_numpy()
                full = size + np.cumsum(sizes) - sizes > SORT_BYTES
                full[1:] &= anchor[1:] != anchor[:-1]
                full[0] &= anchor[0] != last
                cut = int(full.argmax()) if full.any() else batch.num_rows
                if cut:
                    held.append(batch.slice(0, cut))
                    size, last = size + int(sizes[:cut].sum()), anchor[cut - 1]
                batch = batch.slice(cut)
                if batch.num_rows:
                    yield sort()
                    held, size = [], 0
        if held:
            yield sort()

    return run


def repeated_runs(rows: DataFrame, length: int) -> DataFrame:
    """``hit_id, starts, counts``: per document the runs of repeated strings."""
    runs = (dealt_segments(rows, length).repartition(shuffle_width(rows.sparkSession), "anchor").sortWithinPartitions("anchor")
            .mapInArrow(_compared(length), "doc_id long, start long, n long"))
    return scratch_table(runs.groupBy(F.col("doc_id").alias("hit_id")).agg(
        F.collect_list(F.struct("start", "n")).alias("runs")).select("hit_id", "runs.start", "runs.n"), "byte-runs")


def _cut(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            out = []
            for doc_id, raw, starts, counts in zip(batch.column("doc_id").to_pylist(), _bytes(batch.column("text")),
                                                   batch.column("start").to_pylist(), batch.column("n").to_pylist()):
                edges = np.zeros((0, 2), np.int64)
                kept = raw
                if starts:
                    depth = np.zeros(len(raw) + 1, np.int64)
                    b = np.array(starts)
                    np.add.at(depth, np.minimum(b, len(raw)), 1)
                    np.add.at(depth, np.minimum(b + np.array(counts) + length - 1, len(raw)), -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                row = [doc_id, len(raw), len(raw) - len(kept), len(edges), hashlib.sha256(kept).hexdigest()]
                out.append([*row, kept, edges.tolist()] if with_text else row)
            types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"][:len(columns)])

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, ``with_text``, ``kept`` (the
    remaining bytes) and ``removed`` (maximal intervals [from, to) of bytes)."""
    if length < ANCHOR:
        raise ValueError(f"length must be at least {ANCHOR}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    runs = repeated_runs(rows, length)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, removed array<array<long>>" if with_text else "")
    return (rows.join(runs, rows.doc_id == runs.hit_id, "left").select("doc_id", "text", "start", "n")
            .mapInArrow(_cut(length, with_text), schema))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(load(spark, sf_dir, "documents"), with_text=False)
