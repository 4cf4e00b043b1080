"""Conversation repair against an exhaustive search over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm import conversation_repair as cr
from tests.llm.helpers import SF, with_clashes

ROWS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType())])
WS = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        yield from [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)


def digest(role, text):
    r = role.encode()
    return hashlib.sha256(str(len(r)).encode() + b":" + r + text.encode()).digest()


def faults(rows):
    seen = set()
    for _, _, role, text in rows:
        end = text.strip(WS)
        yield "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))


PREFIX = re.compile(r"(s|s?(ua)*u?)")


def cheapest(rows, kinds):
    """Least (cost, audit) with the repaired rows, over all edits and insertions that cost no more than deleting every row."""
    found = []
    bound = 3 * len(rows)

    def go(i, initials, cost, audit, out):
        if cost > bound or not PREFIX.fullmatch(initials):
            return
        if i == len(rows) and LEGAL.fullmatch(initials):
            found.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in out)))
        for role in ("user", "assistant"):
            go(i, initials + role[0], cost + 2, audit + "I", [*out, (role, "")])
        if i == len(rows):
            return
        _, _, role, text = rows[i]
        go(i + 1, initials, cost + 3, audit + "D", out)
        if kinds[i] not in ("blank", "duplicate"):
            extra = kinds[i] == "truncated"
            go(i + 1, initials + (role[:1] or "-"), cost + extra, audit + "K", [*out, (role, text)])
            for other in ("user", "assistant"):
                go(i + 1, initials + other[0], cost + 2 + extra, audit + "R", [*out, (other, text)])

    go(0, "", 0, "", [])
    return min(found, key=lambda f: f[:2])


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(damage([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[2], r[3])))
        kinds = list(faults(mine))
        cost, audit, text = cheapest(mine, kinds)
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [(a[2][:1] + b[2][:1]) for a, b in zip(mine, mine[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def run(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    return result(cr.repair_conversations(cr.damaged(df), df))


def test_equals_exhaustive_search(spark):
    rnd = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(rnd.choice([1, 2, 3, 3])):
            rows.append((conv, rnd.choice([turn, turn, turn + 1, None]), rnd.choice(["user", "assistant", "system", "tool", None]),
                         rnd.choice(["Hi.", "Hi", "Ok!", "Why? ", " ", "", None, "é\n", "Hi.\x85"])))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (-1, 7, "", "x"), (-1, -3, "sister", "y.")]
    assert run(spark, rows) == expected(rows)


def test_ends_and_empty(spark):
    """A conversation that loses all rows, one of null turns only, extreme turns, repeated rows, an empty table."""
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    plain = next(c for c in range(gone + 1, 20_000) if zlib.crc32(f"{c}: ".encode()) % 20 > 4)
    rows = [(gone, 0, "user", "Hi."), (plain, None, "user", "Hi."), (plain, None, "assistant", "Hi."),
            (-5, -2**63, "user", "a."), (-5, 2**63 - 1, "assistant", "b.")] + [(-6, 3, "user", "same.")] * 3
    got = run(spark, rows)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[plain][0] == 0 and got[-5][0] == 2**63 - 1
    assert got == expected(rows) | {-5: got[-5]}
    df = spark.createDataFrame([], ROWS)
    assert cr.repair_conversations(cr.damaged(df), df).count() == 0


def test_long_conversation_spans_tasks(spark):
    """One conversation of 3,000 rows over all tasks: the same row as from one task; other columns are ignored."""
    rnd = random.Random(1)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Hi.", f"Hi {t}", ""])) for t in range(3000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, ROWS)
    many = result(cr.repair_conversations(cr.damaged(df), df))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = result(cr.repair_conversations(cr.damaged(with_clashes(df)), with_clashes(df)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert many == one and len(many[1][6]) >= 2500
    # a left-to-right search over states, without spans, finds the same cost and audit
    mine = sorted(damage(rows[:-1]), key=lambda r: (r[1], r[2], digest(r[2], r[3])))
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insert(at):
        while True:
            new = dict(at)
            for (p, x), q in steps.items():
                if x != "s" and p in at:
                    new[q] = min(new.get(q, (9**9, "")), (at[p][0] + 2, at[p][1] + "I"))
            if new == at:
                return at
            at = new

    at = insert({0: (0, "")})
    for (_, _, role, _), kind in zip(mine, faults(mine)):
        new = {}
        for p, (cost, audit) in at.items():
            options = [(p, cost + 3, audit + "D")]
            if kind not in ("blank", "duplicate"):
                for x, c, e in ((role[:1], 0, "K"), ("u", 2, "R"), ("a", 2, "R")):
                    if (p, x) in steps:
                        options.append((steps[p, x], cost + c + (kind == "truncated"), audit + e))
            for q, c, a in options:
                new[q] = min(new.get(q, (9**9, "")), (c, a))
        at = insert(new)
    assert many[1][5:7] == min(at[q] for q in (0, 3) if q in at)


def test_copies_by_doubling():
    cell = cr.ROW_CELLS["u", True, False]
    spans = cr.Spans()
    for _ in range(13):
        spans.add(cell)
    assert cr.repeated(cell, 13) == spans.cell()


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(cr.op11_conversation_repair(spark, SF))
    assert set(got) == {r[0] for r in rows}
    short = [c for c in got if sum(r[0] == c for r in rows) <= 3]
    want = expected([r for r in rows if r[0] in short])
    assert {c: got[c] for c in short} == want


if __name__ == "__main__":
    pytest.main([__file__])
