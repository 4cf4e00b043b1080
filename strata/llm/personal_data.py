"""Personal data by bootstrapped contextual extraction.

1. Seeds: e-mail addresses, IPv4 addresses, payment cards and phone numbers by exact rules.
2. Every seed, and every other token run with the look of an identifier, is a mention with its
   lexical patterns: the words around it with a gap for the mention.
3. Patterns and instances form a bipartite graph that Spark scores in rounds: a pattern is as
   good as the share of its instances that are known, an instance as good as the patterns that
   hold it (noisy or).  Seeds keep the score 1.
4. A mention that is no seed is added when a high-confidence pattern holds it and its instance
   scores high.

A pattern is aggregated by (kind, pattern) with partial sums, so a pattern that holds a third
of all mentions is no bottleneck; documents without mentions take no part in the graph.

Results for odd input: a null or empty text has no spans; null ids and repeated rows are
ordinary documents, each with its own spans; offsets count code points; an empty table gives
an empty result.
Only the id and the text column are read, so others may have any name.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import load, scratch_table, slices

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SEEDS = 3
CONFIDENCE = 0.8
SMOOTHING = 0.5

# fixed values: the base rules
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
# the same matches in linear time: from each "@" outwards, and from the start of a run of digits only
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
# token runs that may be an identifier in another spelling
_AT_TAIL = r"[\w.%+-]++ ?(?:\[at\]|\(at\)|\{at\}|@| at ) ?[\w-]++(?:(?: ?(?:\[dot\]|\(dot\)|\.) ?| dot )[\w-]++)++"
_AT = re.compile(_AT_TAIL, re.IGNORECASE)
_AT_FRESH = re.compile(r"(?<![\w.%+-])" + _AT_TAIL, re.IGNORECASE)  # starts at the start of a run
_SIGNS = ("@", " at ", "[at]", "(at)", "{at}")  # _AT matches no text without one of them
_NUMBER = re.compile(r"\(?[0-9](?:[ ().-]{0,2}[0-9]){5,}")
_CONTEXT = 60  # a neighbouring word counts with its part within so many characters of the mention

_SPAN = "array<struct<kind:int,start:int,stop:int>>"
_FOUND = f"doc_id long, base {_SPAN}, base_sha256 string, mentions array<struct<kind:int,start:int,stop:int,instance:string,seed:boolean,patterns:array<string>>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Spans of ``EMAIL.finditer``: each "@" with the run before it (not before the last match) and its domain."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1) if start == at else end
        at = text.find("@", max(at + 1, end))
    return out


def _spelled_out(text: str) -> Iterator[re.Match]:
    """Matches of ``_AT.finditer`` without trying every place of a long run: a match starts a run, or
    goes on right after the last match."""
    end = 0
    while True:
        m = (_AT.match(text, end) if end else None) or _AT_FRESH.search(text, end)
        if m is None:
            return
        yield m
        end = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in kind and text order: leftmost matches of each rule, tested once."""
    found = []
    if "@" in text:
        found += [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        # long digit runs may exceed int(): compare by length first
        small = lambda part: len(p := part.lstrip("0")) < 3 or (len(p) == 3 and int(p) <= 255)
        found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return found


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _shape(instance: str) -> int | None:
    """Kind that an identifier-like run may be."""
    digits = sum(map(str.isdigit, instance))
    if not digits or "at" in instance.lower() or "@" in instance:
        return 0
    if re.fullmatch(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}", instance):
        return 1
    return 2 if 15 <= digits <= 19 else 3 if 7 <= digits <= 14 else None


def _words(text: str) -> list[str]:
    return [re.sub("[0-9]", "0", w.lower()) for w in text.split()]


def patterns_of(text: str, start: int, stop: int) -> list[str]:
    """Words around a mention: two before, one on each side, two after; and a label before it."""
    left, right = text[max(0, start - _CONTEXT):start], text[stop:stop + _CONTEXT]
    before, after = _words(left)[-2:], _words(right)[:2]
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    if len(after) == 2:
        out.append(f"_ {after[0]} {after[1]}")
    if before and before[-1][-1] in ":=#":
        out.append(f"{before[-1]} _")
    return out


def _free(taken: list[list[int]], start: int, stop: int) -> list[tuple[int, int]]:
    """The parts of [start, stop) outside the disjoint, sorted intervals."""
    out, at = [], bisect.bisect_right(taken, [start, start])
    at -= at > 0 and taken[at - 1][1] > start
    while at < len(taken) and taken[at][0] < stop:
        if taken[at][0] > start:
            out.append((start, taken[at][0]))
        start, at = max(start, taken[at][1]), at + 1
    return [*out, (start, stop)] if start < stop else out


def _numbers(text: str, start: int, stop: int) -> list[tuple[int, int, int]]:
    """``(kind, start, stop)`` of a run, or of its parts between spaces if it is too long for one number."""
    kind = _shape(text[start:stop])
    if kind is not None:
        return [(kind, start, stop)]
    if " " not in text[start:stop]:
        return []
    out = []
    for part in re.finditer(r"[^ ]+", text[start:stop]):
        m = _NUMBER.search(part[0])
        kind = _shape(m[0]) if m else None
        if kind is not None:
            out.append((kind, start + part.start() + m.start(), start + part.start() + m.end()))
    return out


def mentions_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    found = [(k, a, b, True) for k, a, b in base]
    taken: list[list[int]] = []  # the base spans as disjoint intervals
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    low = text.lower()
    if any(sign in low for sign in _SIGNS):
        for m in _spelled_out(text):
            kind = _shape(m[0])
            if kind is not None and len(_free(taken, m.start(), m.end())) == 1 and _free(taken, m.start(), m.end())[0] == (m.start(), m.end()):
                found.append((kind, m.start(), m.end(), False))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            # the parts outside base spans; a run of several numbers falls apart at its spaces
            for a, b in _free(taken, m.start(), m.end()):
                whole = (a, b) == m.span()
                for n in ([m] if whole else _NUMBER.finditer(text, a, b)):
                    found += [(k, i, j, False) for k, i, j in _numbers(text, n.start(), n.end())]
    return [(k, a, b, text[a:b].lower(), seed, patterns_of(text, a, b)) for k, a, b, seed in found]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
    mention = pa.struct([*span, ("instance", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])
    for batch in slices(batches, "text", 8_000_000):
        base, shas, mentions = [], [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            base.append([dict(zip(("kind", "start", "stop"), s)) for s in spans])
            shas.append(hashlib.sha256(written(spans).encode()).hexdigest())
            mentions.append([dict(zip(("kind", "start", "stop", "instance", "seed", "patterns"), m)) for m in mentions_of(text, spans)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(shas), pa.array(mentions, pa.list_(mention))],
                                         names=["doc_id", "base", "base_sha256", "mentions"])


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Distinct ``kind, pattern, instance, seed`` -> scores of patterns and of instances."""
    scores = edges.groupBy("kind", "instance").agg(F.max(F.col("seed").cast("double")).alias("s"))
    patterns = None
    for _ in range(rounds):
        patterns = (edges.join(scores, ["kind", "instance"]).groupBy("kind", "pattern").agg(
            F.sum("s").alias("known"), F.count(F.lit(1)).alias("n"))
            .select("kind", "pattern", F.when(F.col("known") >= MIN_SEEDS, F.col("known") / (F.col("n") + SMOOTHING)).otherwise(0.0).alias("p")))
        patterns = scratch_table(patterns, "pii-patterns")
        scores = (edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "instance").agg(
            F.max(F.col("seed").cast("double")).alias("seed"),
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("p")))))).alias("by_patterns"))
            .select("kind", "instance", F.greatest("seed", "by_patterns").alias("s")))
    return patterns, scores


def personal_data(docs: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, base_sha256, added`` with spans ``(kind, start, stop)`` for every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = scratch_table(rows.mapInArrow(_extract, _FOUND).withColumn("row", F.monotonically_increasing_id()), "pii-mentions")
    mentions = found.where(F.size("mentions") > 0).select("row", F.inline("mentions"))
    edges = scratch_table(mentions.select("kind", F.explode("patterns").alias("pattern"), "instance", "seed")
                          .groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    patterns, scores = score_graph(edges, rounds)
    open_ = mentions.where("not seed").select("row", "kind", "start", "stop", "instance", F.explode("patterns").alias("pattern"))
    added = (open_.join(patterns.where(F.col("p") >= confidence), ["kind", "pattern"])
             .join(scores.where(F.col("s") >= confidence), ["kind", "instance"])
             .groupBy("row").agg(F.sort_array(F.collect_set(F.struct("kind", "start", "stop"))).alias("added")))
    return found.join(added, "row", "left").select(
        "doc_id", "base", "base_sha256", F.coalesce("added", F.array().cast(_SPAN)).alias("added"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal_data(load(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    line = F.transform(F.sort_array(F.concat("base", "added")), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"]))

    def count(i: int):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    counts = [count(i) for i in range(len(KINDS))]
    return out.select("doc_id", *counts, "base_sha256", F.concat_ws(",", line).alias("spans"), F.size("added").cast("long").alias("n_added"))
