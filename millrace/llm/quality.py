"""Quality classifier by co-training two views of a document.

The content view is a hashed character n-gram profile of the text. The metadata
view is what is known about the document around its words: language, source,
length, lines and the make-up of its characters. Each view has a logistic
regression. In every round each one labels all documents without a label, and
its most confident ``ADDED`` of either class, at least ``CONFIDENT`` sure, join
the other's training rows. Afterwards each view is calibrated on labelled rows
that neither was fitted on, and the calibrated log-odds are added with weights
fitted on the same rows. The sum scores every document, read whole.

Labelled rows come from about ``LABELLED_ROWS`` documents, those with the lowest
hashes of their ids (all, if fewer are labelled). Candidates for pseudo-labels are all documents; the
profiles (about ``CONTENT + 100`` bytes a document) are written once, and the rounds
read only them.

Defined results: a null text counts as empty, a null language or source as a
value of its own; a document labelled twice counts as rejected if one label
rejects it; labels that are null or of unknown documents are passed over; if no
document of either class is labelled, every document is kept with score 1;
repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.char_ngrams import ngram_buckets
from millrace.storage import bound_batches, land

CONTENT_BITS = 9
CONTENT = 1 << CONTENT_BITS
NGRAM = 2
LANGUAGES, SOURCES = 16, 64
LABELLED_ROWS = 8_192
ROUNDS = 2
ADDED = 400
CONFIDENT = 0.95
THRESHOLD = 0.3
HELD = 4
PENALTY = 1e-3
SHAPE = 12
META = SHAPE + LANGUAGES + SOURCES
ROWS_AT_ONCE = 1_024
PROFILE = "content binary, meta array<float>"


def content_profile(text: str) -> np.ndarray:
    """Square roots of the n-gram shares, in 256 steps."""
    counts = np.zeros(CONTENT, np.int64)
    for buckets in ngram_buckets(text, NGRAM, CONTENT_BITS):
        counts += np.bincount(buckets, minlength=CONTENT)
    return np.sqrt(counts / max(1, counts.sum())) * 255


def metadata(text: str, lang: str | None, source: str | None) -> np.ndarray:
    n = max(1, len(text))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = codes[codes < 128]
    count = np.bincount(low, minlength=128)
    letters = count[65:91].sum() + count[97:123].sum() + (len(codes) - len(low))
    words = text.split()
    lines = text.count("\n") + 1
    distinct = len(set(words))
    shape = np.array(
        [
            np.log1p(len(text)) / 10,
            np.log1p(lines) / 5,
            np.log1p(len(text) / lines) / 10,
            letters / n,
            count[48:58].sum() / n,
            (count[9:14].sum() + count[32]) / n,
            count[65:91].sum() / n,
            (count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / n,
            distinct / max(1, len(words)),
            np.log1p(n / max(1, len(words))) / 3,
            min(1.0, 10 * count[[35, 36, 37, 38, 42, 64, 94, 124, 126]].sum() / n),
            min(1.0, 10 * count[33] / n),
        ]
    )
    known = np.zeros(LANGUAGES + SOURCES)
    known[zlib.crc32(repr(lang).encode()) % LANGUAGES] = 1
    known[LANGUAGES + zlib.crc32(repr(source).encode()) % SOURCES] = 1
    return np.concatenate([shape * 4, known])


def _profiles(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    content = np.empty((len(texts), CONTENT), np.uint8)
    meta = np.empty((len(texts), META), np.float32)
    for i, (t, lang, source) in enumerate(zip(texts, langs, sources)):
        text = t.as_py() or ""
        content[i] = content_profile(text)
        meta[i] = metadata(text, lang.as_py(), source.as_py())
    return content, meta


def _as_text(name: str) -> Column:
    return F.col(name).cast("string")


def _profile_column() -> Column:
    def profile(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.Array:
        content, meta = _profiles(texts, langs, sources)
        return pa.StructArray.from_arrays(
            [pa.array([c.tobytes() for c in content], pa.binary()), pa.array(list(meta), pa.list_(pa.float32()))], ["content", "meta"]
        )

    return F.arrow_udf(profile, PROFILE)("text", _as_text("lang"), _as_text("source"))


@dataclass
class Logistic:
    """Standardised logistic regression with a ridge penalty, by Newton's method."""

    centre: np.ndarray = None
    scale: np.ndarray = None
    weights: np.ndarray = None

    def _spread(self, x: np.ndarray) -> np.ndarray:
        return np.c_[(x - self.centre) / self.scale, np.ones(len(x))]

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = self._spread(x)
        ridge = np.full(z.shape[1], PENALTY * len(y))
        ridge[-1] = 1e-6
        self.weights = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (y - p) - ridge * self.weights
            step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(ridge), slope)
            self.weights += step
            if np.abs(step).max() < 1e-4:
                break
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        parts = [self._spread(x[at : at + ROWS_AT_ONCE].astype(float)) @ self.weights for at in range(0, len(x), ROWS_AT_ONCE)]
        return np.concatenate([np.empty(0), *parts])


@dataclass
class Model:
    """``views`` are the content and the metadata classifier; ``mix`` has for each its
    calibration and weight in one: a factor of its log-odds, and a constant."""

    views: list[Logistic] = field(default_factory=list)
    calibrations: list[np.ndarray] = field(default_factory=list)
    mix: np.ndarray = None

    def score(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Columns: probability under the content view, the metadata view, both."""
        if not self.views:
            return np.ones((len(content), 3))
        odds = [v.odds(x) for v, x in zip(self.views, (content, meta))]
        calibrated = [c[0] * o + c[1] for c, o in zip(self.calibrations, odds)]
        both = self.mix[0] * calibrated[0] + self.mix[1] * calibrated[1] + self.mix[2]
        return 1 / (1 + np.exp(-np.clip(np.array([*calibrated, both]).T, -30, 30)))


def _unpack(batch) -> tuple[np.ndarray, np.ndarray]:
    content = np.frombuffer(b"".join(batch["content"].to_pylist()), np.uint8).reshape(-1, CONTENT)
    return content, np.asarray(batch["meta"].flatten(), np.float32).reshape(len(content), META)


def _confident(spark: SparkSession, unlabelled: DataFrame, views: list[Logistic]) -> list:
    """For each view, the rows it is surest of, as (content, metadata, label)."""
    shipped = spark.sparkContext.broadcast(views)

    def odds(content: pa.Array, meta: pa.Array) -> pa.Array:
        x = _unpack({"content": content, "meta": meta})
        found = [v.odds(part) for v, part in zip(shipped.value, x)]
        return pa.StructArray.from_arrays([pa.array(f, pa.float64()) for f in found], ["v0", "v1"])

    sure = float(np.log(CONFIDENT / (1 - CONFIDENT)))
    scored = unlabelled.withColumn("odds", F.arrow_udf(odds, "v0 double, v1 double")("content", "meta"))
    picked = []
    for view in ("v0", "v1"):
        mine = []
        for label, order in ((1, F.desc("odd")), (0, F.asc("odd"))):
            ranked = scored.select("content", "meta", F.col(f"odds.{view}").alias("odd"), F.xxhash64("content", "meta").alias("tie"))
            top = ranked.filter(F.col("odd") >= sure if label else F.col("odd") <= -sure).orderBy(order, "tie").limit(ADDED)
            top = land(top, "quality-confident")
            mine += [(np.frombuffer(r.content, np.uint8), np.array(r.meta, np.float32), label) for r in top.collect()]  # at most ADDED
        picked.append(mine)
    return picked


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS) -> Model:
    """Co-train on ``docs`` (doc_id, text, lang, source) and ``labels`` (doc_id, quality)."""
    spark = docs.sparkSession
    bound_batches(spark)
    given = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    profiled = docs.select("doc_id", _profile_column().alias("p")).select("doc_id", "p.content", "p.meta")
    # the one shuffle of profiles; the rounds only filter what is written here
    profiled = land(profiled.join(given.hint("merge"), "doc_id", "left"), "quality-profiles")
    known = profiled.filter(F.col("quality").isNotNull())
    share = int((1 << 30) * min(1.0, labelled_rows / max(1, known.count())))
    rows = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).collect()  # about labelled_rows
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    if len({int(r.quality > 0) for r in rows}) < 2:
        return Model()
    x = [np.array([np.frombuffer(r.content, np.uint8) for r in rows]), np.array([r.meta for r in rows], np.float32)]
    y = np.array([r.quality > 0 for r in rows], float)
    held = np.arange(len(rows)) % HELD == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    unlabelled = profiled.filter(F.col("quality").isNull())
    extra: list[list] = [[], []]
    for turn in range(rounds + 1):
        views = []
        for view in range(2):
            more = extra[1 - view]  # what the other view is sure of
            xs = np.concatenate([x[view][~held].astype(float), *[m[view][None].astype(float) for m in more]])
            views.append(Logistic().fit(xs, np.concatenate([y[~held], [m[2] for m in more]])))
        if turn < rounds:
            extra = _confident(spark, unlabelled, views)
    on = held if held.any() else np.ones(len(rows), bool)
    calibrations, calibrated = [], []
    for view in range(2):
        odds = views[view].odds(x[view][on])
        line = _line(odds[:, None], y[on])
        calibrations.append(line)
        calibrated.append(line[0] * odds + line[1])
    return Model(views, calibrations, _line(np.array(calibrated).T, y[on]))


def _line(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Factors and constant of a logistic regression on log-odds."""
    of = Logistic().fit(np.clip(odds, -30, 30), y)
    factors = of.weights[:-1] / of.scale
    return np.r_[factors, of.weights[-1] - (factors * of.centre).sum()]


def score(spark: SparkSession, model: Model) -> Column:
    """A struct of ``content``, ``metadata`` and ``score`` probabilities from text, lang and source."""
    shipped = spark.sparkContext.broadcast(model)

    def column(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.Array:
        found = shipped.value.score(*_profiles(texts, langs, sources))
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in found.T], ["content", "metadata", "score"])

    return F.arrow_udf(column, "content double, metadata double, score double")("text", _as_text("lang"), _as_text("source"))
