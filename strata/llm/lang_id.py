"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

    features     text in lower case, every run of other characters than letters one space, a space at both
                 ends; its 1- to 3-grams hashed into 2**BITS places; weight (1 + ln count) * idf, unit length
    idf          documents per place, counted over *all* training rows
    training     follow the regularised leader (proximal, a rate per weight) with an elastic net:
                 L1 leaves most weights exactly zero, L2 shrinks the rest
    priors       rows are fitted in equal numbers per language; the biases are then moved to the
                 languages' shares among all training rows
    calibration  one temperature for all scores, by least log loss on rows kept out of the fit

How the work is spread: the document counts are one map-side pass that sends at most 2**BITS small
rows per task.  The classifier is fitted on a documented bounded sample: about ``FIT_ROWS`` rows per
language, chosen by a hash of their id and text (copies of both count once).
Their features (not their texts) reach the driver.  Scoring reads each text once, map side, with a model of
at most 2**BITS places x languages.  Whole texts are used; a long text is taken in pieces of ``PIECE`` characters.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if no
training row has a language and a letter.  Null and repeated doc_ids are ordinary rows (a null id
counts as empty text for the fold).  Equal scores: the language first in code point order.  Extra
columns are ignored, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import load

BITS = 17
SIZES = (1, 2, 3)
FIT_ROWS = 1000  # per language; one in CALIBRATE of them is kept for the temperature
CALIBRATE = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
PIECE = 1 << 20
UNKNOWN = "und"


# ---------------------------------------------------------------------------------- features
class Grams:
    """Hashed n-gram counts of one text after the other.  Lives in one task."""

    def __init__(self, bits: int = BITS):
        self.places = 1 << bits
        self.shift = np.uint64(64 - bits)
        # code point -> itself if it is a letter, else a space
        self.letters = np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)), np.uint32, 0x110000)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places (ascending) and their counts; none for a text without a letter."""
        text = (text or "").lower()
        total, carry, some = None, np.array([32], np.uint32), False
        for at in range(0, len(text), PIECE):
            last = at + PIECE >= len(text)
            codes = self.letters[np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
            some = some or bool((codes != 32).any())
            codes = np.concatenate([carry, codes, np.array([32], np.uint32)] if last else [carry, codes])
            keep = np.ones(len(codes), bool)
            keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
            codes = codes[keep].astype(np.uint64)
            done = 0 if at == 0 else len(carry)
            found = np.concatenate([self._places(codes, n, max(0, done - n + 1)) for n in SIZES])
            counted = np.bincount(found, minlength=self.places)
            total = counted if total is None else total + counted
            carry = codes[-(max(SIZES) - 1):].astype(np.uint32)
        if not some:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places = np.flatnonzero(total)
        return places, total[places]

    def _places(self, codes: np.ndarray, n: int, start: int) -> np.ndarray:
        """Places of the n-grams that begin at ``start`` or later."""
        count = len(codes) - n + 1 - start
        if count <= 0:
            return np.zeros(0, np.int64)
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = (h * np.uint64(0x110000)) + codes[start + i:start + i + count]
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)


def weigh(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of unit length."""
    w = (1 + np.log(counts)) * idf[places]
    norm = np.linalg.norm(w)
    return w / norm if norm else w


# ---------------------------------------------------------------------------------- the model
class Leader:
    """Multinomial logistic regression by follow-the-regularised-leader (proximal) with an elastic net.

    ``z`` holds summed gradients (moved by the rate changes), ``n`` summed squares; a weight is
    zero while its ``z`` is within L1, else the closed form of the regularised minimum."""

    def __init__(self, classes: int, places: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((places + 1, classes)), np.zeros((places + 1, classes))  # the last row: biases
        self.places = places

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, places: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(places, self.places), np.append(x, 1.0)
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        gradient = np.outer(x, error)
        n = self.n[at]
        rate = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - rate * w
        self.n[at] = n + gradient * gradient


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The temperature of least weighted log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / math.exp(log_t))[np.arange(len(labels)), labels]
        return float(-(weight * np.log(np.maximum(p, 1e-300))).sum())

    low, high, ratio = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


class Model:
    """Languages, idf, and the weights of the places that have any."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, t: float):
        self.languages, self.idf, self.bias, self.t = languages, idf.astype(np.float32), bias, t
        used = np.flatnonzero(np.abs(weights).sum(axis=1))
        self.row = np.full(len(idf), -1, np.int32)
        self.row[used] = np.arange(len(used), dtype=np.int32)
        self.weights = weights[used].astype(np.float32)

    def logits(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = weigh(places, counts, self.idf)
        at = self.row[places]
        has = at >= 0
        return x[has] @ self.weights[at[has]] + self.bias

    def predict(self, places: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(places) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(places, counts) / self.t)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


# ---------------------------------------------------------------------------------- Spark
def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def document_counts(train: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Documents per place and documents, over all training rows that have a letter."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total, n = Grams(bits), np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                places, _ = grams.counts(text.as_py())
                total[places] += 1
                n += len(places) > 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": np.append(used, 1 << bits), "n": np.append(total[used], n)})

    sums = train.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    df = np.zeros((1 << bits) + 1, np.int64)
    for r in sums.toLocalIterator():  # at most 2**bits + 1 rows
        df[r.place] = r.n
    return df[:-1], int(df[-1])


def fit_sample(train: DataFrame, shares: dict[str, int], bits: int, fit_rows: int) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """``(lang, place, places, counts)`` of about ``fit_rows`` rows per language (all, if it has fewer), in the
    order of their hash, languages taking turns.

    A row is taken if its hash lies below its language's share, so nothing is ranked and no
    language's rows meet in one task; rows with the same id and text count once."""

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for batch in batches:
            for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text"))):
                places, counts = grams.counts(text)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang], "h": [h], "places": [places.astype(np.int32).tobytes()], "counts": [counts.astype(np.int32).tobytes()]},
                    schema=pa.schema([("lang", pa.string()), ("h", pa.int64()), ("places", pa.binary()), ("counts", pa.binary())]))

    hashed = train.select("lang", "text", F.xxhash64(F.lit(12), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("h"))
    taken = F.lit(False)
    for lang, n in shares.items():
        share = F.lit(True) if n <= fit_rows else F.shiftrightunsigned("h", 11) < F.lit(int(fit_rows / n * 2**53))
        taken = taken | ((F.col("lang") == lang) & share)
    chosen = hashed.where(taken).groupBy("lang", "h").agg(F.first("text").alias("text"))
    rows = chosen.mapInArrow(features, "lang string, h long, places binary, counts binary").collect()
    seen: dict[str, int] = {}
    out = []
    for r in sorted(rows, key=lambda r: (r.lang, r.h)):
        seen[r.lang] = seen.get(r.lang, 0) + 1
        out.append((r.lang, seen[r.lang], np.frombuffer(bytes(r.places), np.int32), np.frombuffer(bytes(r.counts), np.int32)))
    return sorted(out, key=lambda r: (r[1], r[0]))


def train_model(docs: DataFrame, bits: int = BITS, fit_rows: int = FIT_ROWS, epochs: int = EPOCHS) -> Model:
    """Fits on ``doc_id, text, lang`` (rows with a language)."""
    train = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    shares = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    languages = sorted(shares)
    k = len(languages)
    if not k:
        return Model([], np.zeros(1 << bits), np.zeros((1 << bits, 0)), np.zeros(0), 1.0)
    df, n = document_counts(train, bits)
    idf = np.log((1 + n) / (1 + df)) + 1
    rows = [(languages.index(lang), place, p, weigh(p, c, idf)) for lang, place, p, c in fit_sample(train, shares, bits, fit_rows) if len(p)]
    fitted, kept = [r for r in rows if r[1] % CALIBRATE], [r for r in rows if r[1] % CALIBRATE == 0]
    leader = Leader(k, 1 << bits)
    for _ in range(epochs):
        for y, _, p, x in fitted:
            leader.learn(p, x, y)
    weights = leader.weights(slice(None))
    # the sample holds languages in equal numbers, the corpus does not
    true = np.array([shares[lang] for lang in languages], float)
    seen = np.array([max(1, sum(r[0] == y for r in fitted)) for y in range(k)], float)
    bias = weights[-1] + np.log(true / true.sum()) - np.log(seen / seen.sum())
    logits = np.array([x @ weights[p] + bias for _, _, p, x in kept]).reshape(len(kept), k)
    labels = np.array([r[0] for r in kept], int)
    calibrated = np.bincount(labels, minlength=k)
    return Model(languages, idf, weights[:-1], bias, temperature(logits, labels, true[labels] / np.maximum(1, calibrated[labels])))


def predict(docs: DataFrame, model: Model, bits: int = BITS) -> DataFrame:
    """``doc_id, text, held_out`` -> ``doc_id, held_out, lang_pred, score``."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for batch in batches:
            found = [model.predict(*grams.counts(text.as_py())) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "held_out", "text").mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out fold."""
    docs = load(spark, sf_dir, "documents")
    model = train_model(docs.where(fold(F.col("doc_id")) != 2))
    return predict(docs.select("doc_id", "text", (fold(F.col("doc_id")) == 2).alias("held_out")), model)
