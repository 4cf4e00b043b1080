"""Toxicity of texts by noisy-channel deobfuscation.

1. A character language model (trigrams with back-off) is counted over all documents.
2. A token that looks disguised - digits or signs between letters, a letter three times in a
   row, letters set apart by spaces or dots - becomes a lattice of the letters it may stand for
   (channel costs below).  Viterbi decoding under the language model restores the likeliest
   spelling; plain tokens are their own only path.
3. The restored words are scored.  A feature is a word or the first letters of a word; its
   weight is the lower confidence bound of its log-odds between toxic and clean training texts.
   Of the many features tried, some stand in toxic texts by accident, and a long clean text would
   gather them; so a feature counts only if fewer than ``ACCIDENTS`` of all features tried would
   reach its counts by chance (Chernoff bound).  Copies and shared passages are no independent
   evidence against a word: toxic texts in which a feature stands between the same two tokens count
   together (effective number of contexts, ``sum(n)**2 / sum(n**2)``); clean texts count in full.  First letters count only if several words bring
   them.  A word counts once per document with its best feature.

The classifier is fitted on at most about ``SAMPLE`` labelled rows, chosen by hash (equal texts
count once); everything else covers all documents.

Results for odd input: null and empty texts get the score of a text without any feature; null
ids, repeated rows and texts of any length are ordinary documents; labels whose id or mark is
null are ignored; with no usable label every text gets the score 0; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.llm.common import held_out, load, scratch_table, slices

SAMPLE = 30_000
PREFIXES = (4, 5, 6)
CONFIDENCE = 2.58
MIN_TOXIC = 8
MIN_WEIGHT = 1.0
ACCIDENTS = 0.1

# classes of the character model: 0 is the word end, 1 anything else, then the letters
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
CLASSES = len(LETTERS) + 2
CLASS_OF = {c: i + 2 for i, c in enumerate(LETTERS)}
# what a disguised character may stand for
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h",
}
COST_SWAP, COST_VOWEL, COST_DROP, COST_SPACE, COST_REPEAT, COST_TWICE, COST_LOST = 1.0, 2.0, 0.5, 3.0, 1.5, 3.0, 9.0
SETTLE = 64
SEPARATORS = " .-_*~'"
_EDGES = ".,;:!?\"'()[]{}<>|*#%&$-_~/\\"
# tokens may be of any length: no branch scans the same run again and again
_ODD = re.compile(r"[^\W\d_][^\w\s]*+(?:(?<=[@$!|+*€£¡.\-~#(<])|[\d_][\d@$!|+*€£¡.\-_~#(<]*+)[^\W\d_]|(\w)\1\1|^[\d@$!|+(<€£¡]++[^\W\d_]|[^\W\d_][\d@$!|+€£¡]++$"
                  # signs and digits alone: three or more, a sign among them, not one repeated
                  r"|^(?=.*[@$!|+€£¡])(?!(.)\2+$)[\d@$!|+(<€£¡]{3,}+$")
_APART = re.compile(r"(?<!\S)(?:\S[ \t._\-]){2,}\S(?!\S)")


# ---------------------------------------------------------------------------- character model
def _lookup() -> np.ndarray:
    table = np.ones(256, np.int64)
    for c, i in CLASS_OF.items():
        table[ord(c)] = i
    for c in " \t\n\x0b\x0c\r":
        table[ord(c)] = 0
    return table


def _trigrams():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _lookup(), np.zeros(CLASSES ** 3, np.int64)
        for batch in slices(batches, "text", 4_000_000):
            joined = "\n".join(t for t in batch.column("text").to_pylist() if t).lower()
            code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            x = np.where(code < 256, table[np.minimum(code, 255)], 1)
            x = np.r_[0, 0, x, 0]
            x = x[np.r_[True, (x[1:] != 0) | (x[:-1] != 0)]]  # one end between words
            total += np.bincount((x[:-2] * CLASSES + x[1:-1]) * CLASSES + x[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    return run


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """``log P(c | a, b)`` as an array [a, b, c]; at most ``CLASSES ** 3`` counts reach the driver."""
    grams = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_trigrams(), "gram long, n long")
    counts = np.zeros(CLASSES ** 3)
    for row in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    tri = counts.reshape(CLASSES, CLASSES, CLASSES)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + CLASSES)
    p2 = (bi + 20 * p1) / (bi.sum(1, keepdims=True) + 20)
    return np.log((tri + 20 * p2) / (tri.sum(2, keepdims=True) + 20)).astype(np.float32)


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest letters behind a disguised token of any length (may hold spaces)."""
    states, settled, run = {(0, 0): (0.0, "")}, [], 0
    for i, c in enumerate(token):
        arcs = []  # (letter or "" or " ", cost)
        run = run + 1 if i and token[i - 1] == c else 1
        if c in CLASS_OF:
            long_run = run > 2 or token[i:i + 3 - run + 1] == c * (4 - run)
            arcs.append((c, COST_TWICE if run > 2 else COST_REPEAT if run == 2 and long_run else 0.0))
            if run > 1:
                arcs.append(("", 0.0 if long_run else COST_TWICE))
        for letter in STANDS_FOR.get(c, ""):
            arcs.append((letter, COST_VOWEL if c == "*" else COST_SWAP))
        if c in SEPARATORS:
            arcs.append(("", COST_DROP))
            if c in " .-_":
                arcs.append((" ", COST_SPACE))
        if not arcs or (c in STANDS_FOR and not c.isdigit()):
            arcs.append(("", COST_LOST))
        best: dict = {}
        for (a, b), (score, text) in states.items():
            for letter, cost in arcs:
                if letter == "":
                    key, value = (a, b), (score - cost, text)
                elif letter == " " and b == 0:
                    continue
                else:
                    n = CLASS_OF.get(letter, 0)
                    key, value = (b, n), (score - cost + float(model[a, b, n]), text + letter)
                if key not in best or value > best[key]:
                    best[key] = value
        states = best or states
        if i % SETTLE == SETTLE - 1:  # what all paths agree on is decided: they go on with the rest
            n = len(commonprefix([t for _, t in states.values()]))
            if n:
                settled.append(next(iter(states.values()))[1][:n])
                states = {k: (s, t[n:]) for k, (s, t) in states.items()}
    rest = max((s + (float(model[a, b, 0]) if b else 0.0), t) for (a, b), (s, t) in states.items())[1]
    return ("".join(settled) + rest).strip()


def words_behind(token: str, model: np.ndarray) -> list[str]:
    """Lower-case token -> plain words it holds, with and without deobfuscation."""
    bare = token.strip(_EDGES)
    words = [bare] if bare else []
    # "@ss" and "m0r0n!" need their outer signs: only sentence marks go
    tight = token.strip(".,;:?\"'()[]{}")
    if _ODD.search(tight):
        words += restore(tight, model).split()
        if bare != tight and _ODD.search(bare):
            words += restore(bare, model).split()
    return words


def apart(text: str, model: np.ndarray) -> list[str]:
    """Words spelled out as single characters."""
    found = []
    for m in _APART.finditer(text):
        spelled = m[0]
        if len(set(spelled) - set(SEPARATORS + "\t")) >= 2:
            found += restore(spelled, model).split()
    return found


def features_of(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


# --------------------------------------------------------------------------------- classifier
@dataclass
class Model:
    characters: np.ndarray
    weights: dict[str, float]
    prior: float


class Scorer:
    def __init__(self, model: Model):
        self.model, self._known = model, {}

    def _weigh(self, word: str) -> float:
        return max((self.model.weights.get(f, 0.0) for f in features_of(word)), default=0.0)

    def _token(self, token: str) -> tuple:
        found = tuple((w, x) for w in words_behind(token, self.model.characters) if (x := self._weigh(w)))
        if len(self._known) > 500_000:
            self._known.clear()
        self._known[token] = found
        return found

    def __call__(self, text: str | None) -> float:
        low, hits, known = (text or "").lower(), {}, self._known
        for token in set(low.split()):
            found = known.get(token)
            if found is None:
                found = self._token(token)
            if found:
                hits.update(found)
        for word in apart(low, self.model.characters):
            if x := self._weigh(word):
                hits[word] = x
        z = self.model.prior + sum(hits.values())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _feature_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters, counts = shared.value, {0: Counter(), 1: Counter()}
        for batch in slices(batches, "text", 4_000_000):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                low = text.lower()
                words = {w for token in set(low.split()) for w in words_behind(token, characters)} | set(apart(low, characters))
                counts[toxic].update({f for w in words for f in features_of(w)} | {""})
        for toxic, c in counts.items():
            if c:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)), pa.array([toxic] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())],
                                                 names=["feature", "toxic", "n"])

    return run


def _contexts(shared):
    """Per text and wanted feature the tokens on both sides of its first place, as a checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters, wanted = shared.value
        known: dict[str, list[str]] = {}
        for batch in slices(batches, "text", 4_000_000):
            counts = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                low, around = text.lower(), {}
                tokens = ["", *low.split(), ""]
                for i, token in enumerate(tokens[1:-1]):
                    found = known.get(token)
                    if found is None:
                        found = [f for w in words_behind(token, characters) for f in features_of(w) if f in wanted]
                        if len(known) > 200_000:
                            known.clear()
                        if len(token) <= 64:
                            known[token] = found
                    for f in found:
                        around.setdefault(f, crc32(f"{tokens[i]} {tokens[i + 2]}".encode("utf-8", "surrogatepass")))
                for f in {f for w in apart(low, characters) for f in features_of(w) if f in wanted}:
                    around.setdefault(f, crc32(low.encode("utf-8", "surrogatepass")))
                counts.update((f, toxic, c) for f, c in around.items())
            if counts:
                features, marks, places = zip(*counts)
                yield pa.RecordBatch.from_arrays([pa.array(features), pa.array(marks, pa.int32()), pa.array(places, pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                                 names=["feature", "toxic", "place", "n"])

    return run


def _evidence(counted: DataFrame, bad: int, good: int, tried: int) -> DataFrame:
    """Rows of ``feature, bad, good`` that carry weight ``w``, of ``tried`` features among ``bad`` toxic and ``good`` clean texts."""
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    weight = odds - CONFIDENCE * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    # exp(-surprise) bounds the chance that a feature of this many texts stands in so many toxic ones
    n, rate = F.col("bad") + F.col("good"), bad / (bad + good)
    part = lambda k, share: F.when(k > 0, k * F.log(k / (n * share))).otherwise(0.0)
    surprise = part(F.col("bad"), rate) + part(F.col("good"), 1 - rate)
    return counted.where(F.col("bad") >= MIN_TOXIC).withColumn("w", weight).where((F.col("w") >= MIN_WEIGHT) & (surprise >= math.log(max(1, tried) / ACCIDENTS)))


def fit(docs: DataFrame, labels: DataFrame, training: Column | None = None, sample: int = SAMPLE) -> Model:
    """Character model over ``docs``; weights from labelled rows that satisfy ``training`` (over ``doc_id``)."""
    spark = docs.sparkSession
    characters = character_model(docs)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)")
    if training is not None:
        marked = marked.where(training)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample / max(1, marked.count()))
    # about ``sample`` rows of two numbers: the only thing broadcast by hint here
    chosen = marked.where(F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) < F.lit(int(share * 2 ** 53)))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "doc_id").select("text", "toxic", F.xxhash64("text").alias("same")).dropDuplicates(["same"]))
    texts = scratch_table(texts.select("text", "toxic"), "labelled-texts")
    counts = texts.mapInArrow(_feature_counts(spark.sparkContext.broadcast(characters)), "feature string, toxic int, n long")
    by_feature = scratch_table(counts.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good")).where(
        F.expr(f"feature = '' or bad + good >= {MIN_TOXIC}")), "features")
    total = by_feature.where("feature = ''").first()
    if total is None or not total["bad"]:
        return Model(characters, {}, -30.0)
    bad, good = total["bad"], total["good"]
    tried = by_feature.where("feature != ''")
    n_tried = tried.count()
    # the model: features that MIN_TOXIC of the at most ``sample`` fitted rows hold
    wanted = frozenset(r["feature"] for r in _evidence(tried, bad, good, n_tried).select("feature").collect())
    places = (texts.mapInArrow(_contexts(spark.sparkContext.broadcast((characters, wanted))), "feature string, toxic int, place long, n long")
              .groupBy("feature", "toxic", "place").agg(F.sum("n").alias("n"))
              .groupBy("feature", "toxic").agg(F.sum("n").cast("double").alias("n"), (F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n"))).alias("apart")))
    independent = places.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("apart"))), F.lit(0.0)).alias("bad"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0.0)).alias("good"))
    rows = _evidence(independent, bad, good, n_tried).orderBy(F.desc("w"), "feature").collect()
    words = sorted((r["feature"][1:], r["bad"]) for r in rows if r["feature"][0] == "=")

    def one_word(prefix: str, n: int) -> bool:
        """Whether most texts with these first letters have them from one and the same word."""
        at = bisect.bisect_left(words, (prefix,))
        return any(m >= 0.5 * n for w, m in itertools.takewhile(lambda x: x[0].startswith(prefix), words[at:]))

    weights = {r["feature"]: r["w"] for r in rows if r["feature"][0] == "=" or not one_word(r["feature"][1:], r["bad"])}
    return Model(characters, weights, math.log((bad + 0.5) / (good + 0.5)))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``toxicity`` (0 to 1)."""
    # plain values: a broadcast is not pickled with the code, and executors may lack this package
    shared = docs.sparkSession.sparkContext.broadcast((model.characters, model.weights, model.prior))
    schema = StructType([*docs.schema.fields, StructField("toxicity", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for batch in slices(batches, text_col, 4_000_000):
            scores = [scorer(t) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "toxicity"])

    return docs.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, load(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 0))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents whose score is below ``threshold``; all columns, which may have any names.  Fitted on the rows
    that are not held out."""
    model = fit(docs, labels, ~held_out(F.col("doc_id"), 0))
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return score(packed, model).where(F.col("toxicity") < threshold).select("row.*")
