"""Language identification: sparse multinomial logistic regression over TF-IDF
character n-grams, trained with follow-the-regularised-leader under an
elastic-net penalty, then calibrated with a temperature.

N-grams of 1 to ``LONGEST`` characters of the lower-cased text are hashed into
2**BITS buckets; a feature is the n-gram's share of the text times its inverse
document frequency. Document frequencies are counted over all training rows.
The weights are fitted on a bounded sample of them: the ``sample_rows`` rows with
the lowest hashes, spread evenly over the languages; every fifth of these is
kept out of the fit and sets the temperature. Predictions read the text alone.

Defined results: a null text, a text without any letter, and every text if
there is nothing to learn from, is ``und`` with score 0; ties go to the language
that sorts first; rows that repeat are predicted alike; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.char_ngrams import ngram_buckets

LONGEST = 3
BITS = 16
SAMPLE_ROWS = 6_000
EPOCHS = 2
UNKNOWN = "und"
SCALE = 64.0
HELD_FOR_TEMPERATURE = 5
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rates and the elastic net of the leader."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and each one's share of its n-grams."""
    total = np.zeros(1 << BITS, np.int64)
    for buckets in ngram_buckets(text, LONGEST, BITS):
        total += np.bincount(buckets, minlength=1 << BITS)
    own = np.flatnonzero(total)
    return own, total[own] / max(1, total.sum())


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, texts = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            here = np.zeros(1 << BITS, bool)
            for buckets in ngram_buckets(text.as_py() or "", LONGEST, BITS):
                here[buckets] = True
            seen += here
            texts += 1
    own = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[own, -1]), pa.array(np.r_[seen[own], texts])], ["bucket", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_counts(text.as_py() or "") for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["lang"],
                batch["place"],
                pa.array([b for b, _ in rows], pa.list_(pa.int64())),
                pa.array([share for _, share in rows], pa.list_(pa.float64())),
            ],
            ["lang", "place", "buckets", "shares"],
        )


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, by: Ftrl, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bucket, class) after ``epochs`` passes; the last row is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - by.l1, 0)
        return -shrunk / ((by.beta + np.sqrt(n[at])) / by.alpha + by.l2)

    for _ in range(epochs):
        for label, buckets, values in rows:
            at, x = np.r_[buckets, size - 1], np.r_[values, 1.0]
            w = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / by.alpha * w
            n[at] = more
    return weights(slice(None))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores under which the labels are likeliest (golden-section search)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    """``table`` holds weight times inverse document frequency; its size is fixed by BITS and the languages."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def scores(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for buckets in ngram_buckets(text, LONGEST, BITS):
            total += np.add.reduce(self.table[buckets], axis=0, dtype=np.float64)
            n += len(buckets)
        return self.bias + total * (SCALE / max(1, n))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = _softmax(self.scores(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, by: Ftrl = Ftrl()) -> Model:
    """Fit on ``doc_id``, ``text`` and ``lang`` (rows with a null language are passed over)."""
    rows = labelled.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(sample_rows).collect())
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)
    frequencies = rows.select("text").mapInArrow(_document_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counted = frequencies.toPandas()  # at most 2**BITS + 1 rows
    n_texts = counted.loc[counted.bucket == -1, "n"].sum()
    idf = np.full(1 << BITS, np.log(n_texts + 1.0) + 1)
    known = counted[counted.bucket >= 0]
    idf[known.bucket] = np.log((n_texts + 1.0) / (known.n + 1.0)) + 1

    each = max(HELD_FOR_TEMPERATURE, sample_rows // len(languages))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = rows.select("doc_id", "lang").withColumn("place", place).filter(F.col("place") <= each).drop("lang")
    taken = rows.join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id")  # at most sample_rows ids
    sample = taken.select("lang", "place", "text").mapInArrow(_features, "lang string, place int, buckets array<long>, shares array<double>")

    index = {name: k for k, name in enumerate(languages)}
    rows_of: list[list] = [[], []]
    order = []
    for lang, at, buckets, shares in sample.toLocalIterator():
        b = np.array(buckets, np.int64)
        order.append((at, lang, (index[lang], b, np.array(shares) * idf[b] * SCALE)))
    order.sort(key=lambda r: r[:2])
    for at, _, row in order:
        rows_of[at % HELD_FOR_TEMPERATURE == 0].append(row)
    weights = train(rows_of[0], len(languages), by)
    table = (weights[:-1] * idf[:, None]).astype(np.float32)
    held = rows_of[1]
    scores = np.array([weights[-1] + values @ weights[b] for _, b, values in held]).reshape(len(held), len(languages))
    return Model(languages, table, weights[-1], temperature(scores, np.array([r[0] for r in held], int)))


def language(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """A struct of the predicted ``lang`` and its ``score``."""
    shipped = spark.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        found = [shipped.value.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"]
        )

    return F.arrow_udf(predict, "lang string, score double")(text)


def remainder(doc_id: Column | str, parts: int = 3) -> Column:
    """CRC-32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts
