"""Conversation structure repair by weighted interval parsing over a Chomsky-normal-form grammar.

A conversation is legal when its role initials match ``(s?(ua)+)?``.  The repair grammar has one
nonterminal ``[p>q]`` for each pair of states of that pattern: it derives the rows of a span that
lead from ``p`` to ``q`` after edits.

    [p>q] -> [p>r] [r>q]                       two neighbouring spans
    [p>q] -> row                               keep 0, rerole 2, delete 3; a kept truncated row adds 1
    [p>q] -> insertions [p'>q'] insertions     closure: rows may be inserted anywhere, 2 each

A cell of a span holds the minimum ``(cost, audit)`` of each nonterminal.  Since a nonterminal fixes
the states at both ends of its span, every split of a span gives the same cell, so cells are combined
bottom-up by span length (1, 2, 4, ...) with one split each: work is linear in the rows and not
cubic.  The least audit of a cell is enough: audits of equal cost over the same rows are never
prefixes of each other (a longer one would hold one more insertion), so order survives concatenation.
An audit also fixes the repaired roles, because the legal pattern has one role for each place.

How the work is spread: only a digest of each row (turn, role, flags, SHA-256 of role and text)
is sorted, by range over (conversation, turn, role, digest).  A conversation may span any number of
tasks; each parses its piece and one row per piece is combined afterwards.  Copies of a row
are counted before the shuffle and parsed by doubling.  The last step reads each conversation's texts in
order once, as a stream, for the hash of the repaired conversation: SHA-256 is sequential, so this
step alone keeps a conversation in one task, in bounded memory.

Defined results: null role or text counts as one space; a null turn sorts first and takes no part in
``gaps``; rows of a null conv_id are one conversation; rows sharing a turn are ordered by role, then by
the digest of role and text; equal rows are all read (the later ones are duplicates); an empty table gives
no rows; other columns are ignored, whatever their names.  ``gaps`` beyond a long is the largest long.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table, shuffle_width

# fixed values: white space, sentence ends, the costs of the edits, legal neighbours
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
LEGAL = (b"su", b"ua", b"au")
INSERTED = {b"u": b"user", b"a": b"assistant"}

# states of (s?(ua)+)?: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPTING = (START, AFTER_A)
N_STATES = 4
MOST = 2**63 - 1

Cell = list  # of N_STATES * N_STATES entries: None or (cost, audit)


# ---------------------------------------------------------------------------------- the grammar
def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: [p>q] -> [p>r] [r>q]."""
    out: Cell = [None] * (N_STATES * N_STATES)
    for p in range(0, N_STATES * N_STATES, N_STATES):
        for r in range(N_STATES):
            a = left[p + r]
            if a is None:
                continue
            for q in range(N_STATES):
                b = right[r * N_STATES + q]
                if b is None:
                    continue
                cost, held = a[0] + b[0], out[p + q]
                if held is None or cost < held[0]:
                    out[p + q] = (cost, a[1] + b[1])
                elif cost == held[0]:
                    out[p + q] = min(held, (cost, a[1] + b[1]))
    return out


def _least(cell: Cell, p: int, q: int, cost: int, audit: str) -> None:
    at = p * N_STATES + q
    if cell[at] is None or (cost, audit) < cell[at]:
        cell[at] = (cost, audit)


def empty_cell() -> Cell:
    """The span without rows: insertions only, closed under repetition."""
    once: Cell = [None] * (N_STATES * N_STATES)
    for p in range(N_STATES):
        _least(once, p, p, 0, "")
    for (p, initial), q in STEPS.items():
        if initial != "s":
            _least(once, p, q, COST["I"], "I")
    closed = once
    for _ in range(N_STATES):
        closed = combine(closed, once)
    return closed


EMPTY = empty_cell()


def row_cell(initial: str, doomed: bool, truncated: bool) -> Cell:
    """The span of one row, closed under insertions.  ``doomed`` rows (blank, duplicate) can only go."""
    cell: Cell = [None] * (N_STATES * N_STATES)
    for p in range(N_STATES):
        _least(cell, p, p, COST["D"], "D")
    if not doomed:
        extra = TRUNCATED_COST if truncated else 0
        for (p, role), q in STEPS.items():
            if role == initial:
                _least(cell, p, q, COST["K"] + extra, "K")
            if role != "s":
                _least(cell, p, q, COST["R"] + extra, "R")
    return combine(combine(EMPTY, cell), EMPTY)


ROW_CELLS = {(i, d, t): row_cell(i, d, t) for i in "suax" for d in (False, True) for t in (False, True)}


def repeated(cell: Cell, times: int) -> Cell:
    """The span of ``times`` equal rows, by doubling."""
    out, power = EMPTY, cell
    while times:
        if times & 1:
            out = combine(out, power)
        times >>= 1
        if times:
            power = combine(power, power)
    return out


def best(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return min(c for c in (cell[START * N_STATES + q] for q in ACCEPTING) if c is not None)


class Spans:
    """Cells of the rows seen so far: spans of growing powers of two, merged when two are of one length."""

    def __init__(self):
        self.stack: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        level = 0
        while self.stack and self.stack[-1][0] == level:
            cell, level = combine(self.stack.pop()[1], cell), level + 1
        self.stack.append((level, cell))

    def cell(self) -> Cell:
        out = None
        for _, c in reversed(self.stack):
            out = c if out is None else combine(c, out)
        return EMPTY if out is None else out


# ---------------------------------------------------------------------------------- damage
def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage: ``conv_id, turn, role, text, copies`` (2: repeated adjacently)."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text, role = spaced("text"), spaced("role")
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), hit.alias("hit"))
            .where("hit != 0")
            .select("conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies")))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def row_digests(rows: DataFrame) -> DataFrame:
    """One narrow row for each distinct (conversation, turn, role, text), with its number of copies and
    whether an equal role and text stands at an earlier turn."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), "copies",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("initial"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(*ENDS)).alias("truncated"))
    counted = narrow.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    # least turn of each role and text (null first), aggregated before its exchange, met by an equi-join that
    # can be split where one of them is frequent
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    firsts = counted.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(F.min(place).alias("_first"))
    met = counted.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
    return met.withColumn("seen", place > F.col("_first")).drop("_conv", "_digest", "_first")


# ---------------------------------------------------------------------------------- parsing
SUMMARY = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head binary, tail binary"
PIECE = f"conv_id long, piece long, whole boolean, cost long, audit string, cells string, {SUMMARY}"


class _Piece:
    """What one task knows of a conversation: counts, ends and the spans of its rows."""

    def __init__(self, conv_id):
        self.conv_id, self.spans = conv_id, Spans()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.head = self.tail = None

    def add(self, turn, initial: str, copies: int, blank: bool, truncated: bool, seen: bool) -> None:
        role = initial.encode()
        if self.tail is not None and self.tail + role not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # a role beside itself is never legal
        self.head, self.tail = self.head or role, role
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        fresh = not blank and not seen
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += truncated and fresh
        if fresh:
            self.spans.add(ROW_CELLS[initial, False, truncated])
        gone = copies - fresh
        if gone:
            self.spans.add(repeated(ROW_CELLS[initial, True, False], gone) if gone > 1 else ROW_CELLS[initial, True, False])

    def row(self, piece: int, whole: bool) -> dict:
        cell = self.spans.cell()
        cost, audit = best(cell) if whole else (None, None)
        return {"conv_id": self.conv_id, "piece": piece, "whole": whole, "cost": cost, "audit": audit,
                "cells": None if whole else json.dumps(cell), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "turns": self.turns, "low": self.low, "high": self.high, "head": self.head, "tail": self.tail}


_PIECE_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("cost", pa.int64()), ("audit", pa.string()), ("cells", pa.string()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()),
    ("low", pa.int64()), ("high", pa.int64()), ("head", pa.binary()), ("tail", pa.binary())])


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> one row per conversation and task.  A task's first and last conversation may go on
    in a neighbour, so those keep their cells; the others are done."""
    part, held, first, out = TaskContext.get().partitionId(), None, True, []
    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "copies", "blank", "truncated", "seen"))):
            if held is None or conv != held.conv_id:
                if held is not None:
                    out.append(held.row(part, not first))
                    first = False
                held = _Piece(conv)
            held.add(*row)
        if len(out) >= 2000:
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE_ARROW)
            out = []
    if held is not None:
        out.append(held.row(part, False))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_PIECE_ARROW)


def _join_pieces(table: pa.Table) -> pa.Table:
    """The pieces of one conversation, in order -> its row; the spans of two neighbours are combined."""
    pieces = sorted(table.to_pylist(), key=lambda r: r["piece"])
    spans, out = Spans(), dict(pieces[0], whole=True, cells=None)
    for i, p in enumerate(pieces):
        spans.add([None if c is None else tuple(c) for c in json.loads(p["cells"])])
        if not i:
            continue
        for name in ("blank", "duplicate", "truncated", "illegal"):
            out[name] += p[name]
        out["illegal"] += out["tail"] + p["head"] not in LEGAL
        out["turns"] += p["turns"] - (p["low"] is not None and p["low"] == out["high"])
        out["low"] = p["low"] if out["low"] is None else out["low"]
        out["high"] = out["high"] if p["high"] is None else p["high"]
        out["tail"] = p["tail"]
    out["cost"], out["audit"] = best(spans.cell())
    return pa.Table.from_pylist([out], schema=_PIECE_ARROW)


def parse(rows: DataFrame) -> DataFrame:
    """Damaged rows -> one row per conversation: counts, ``cost`` and ``audit``."""
    order = ["conv_id", "turn", "role", "digest"]
    spark = rows.sparkSession
    sorted_rows = row_digests(rows).repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    columns = sorted_rows.select("conv_id", "turn", "initial", F.col("copies").cast("long").alias("copies"), "blank", "truncated", "seen")
    pieces = scratch_table(columns.mapInArrow(_parse, PIECE), "repair")
    joined = pieces.where("not whole").groupBy("conv_id").applyInArrow(_join_pieces, PIECE)
    return pieces.where("whole").unionByName(joined).drop("piece", "whole", "cells", "head", "tail")


# ---------------------------------------------------------------------------------- repaired texts
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_RESULT_ARROW = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Repair:
    """Applies an audit to the rows of a conversation, in order; yields the repaired rows as ``role:text``."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _role(self) -> bytes:
        """The role that the pattern wants next (user or assistant)."""
        return INSERTED[b"a" if self.state == AFTER_U else b"u"]

    def _step(self, role: bytes) -> None:
        self.state = STEPS[self.state, role[:1].decode()]

    def inserted(self) -> Iterator[bytes]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = self._role()
            self._step(role)
            self.at += 1
            yield role + b":"

    def row(self, role: bytes, text: bytes) -> Iterator[bytes]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            role = self._role() if edit == "R" else role
            self._step(role)
            yield role + b":" + text


def _hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its summary row, then its rows in order -> the result row."""
    out: list[dict] = []
    summary = repair = digest = None
    lines = 0

    def put(parts: Iterable[bytes]) -> None:
        nonlocal lines
        for line in parts:
            if lines:
                digest.update(b"\n")
            digest.update(line)
            lines += 1

    def close() -> None:
        put(repair.inserted())
        out.append(summary | {"repaired_sha256": digest.hexdigest()})

    for batch in batches:
        cols = {name: batch.column(name) for name in batch.schema.names}
        for i in range(batch.num_rows):
            at = lambda name: cols[name][i].as_py()  # noqa: B023, E731
            if at("kind") == 0:
                if summary is not None:
                    close()
                low, high, turns = at("low"), at("high"), at("turns")
                summary = {n: at(n) for n in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit")}
                summary["gaps"] = 0 if low is None else min(MOST, high - low + 1 - turns)
                repair, digest, lines = Repair(summary["audit"]), hashlib.sha256(), 0
            else:
                role, text = at("role"), at("text")
                for _ in range(at("copies")):
                    put(repair.row(role, text))
        if len(out) >= 2000:
            yield pa.RecordBatch.from_pylist(out, schema=_RESULT_ARROW)
            out.clear()
    if summary is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_RESULT_ARROW)


def repair_conversations(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copies) -> one row for each id of ``everyone``."""
    ids = everyone.select(F.col("conv_id").cast("long").alias("_all")).distinct()
    parsed = ids.join(parse(rows), F.col("_all").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("_all", "conv_id")
    parsed = parsed.fillna(0, ["blank", "duplicate", "truncated", "illegal", "turns", "cost"]).fillna("", ["audit"])
    n = shuffle_width(rows.sparkSession)
    texts = rows.select("conv_id", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
                        _digest().alias("digest"), F.col("copies").cast("long").alias("copies"), F.lit(1).alias("kind"))
    both = texts.unionByName(parsed.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return (both.repartition(n, "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
            .mapInArrow(_hash, RESULT))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage, its faults and its cheapest repair."""
    rows = load(spark, sf_dir, "conversations")
    return repair_conversations(damaged(rows), rows)
