"""Hard negatives by threshold joins over an inverted index that leaves out what norms cover.

An anchor's positives are the rows of its label with the highest inner products; the
hard negatives of a positive are the rows of other labels whose score is in a window
below the positive's, best first. Both are threshold joins of all rows with the
anchors, which come in blocks of ``ANCHOR_BYTES``.

Rows are packed label by label into blocks, written once. Dimensions stand in one order, those with the most energy first.
A block is an inverted index: for a step of dimensions, the list of the rows that have it indexed. At threshold t a
row leaves out all dimensions behind the first place where the norm of its suffix times the
norm of the longest anchor falls below t (rows are sorted by that place, so that a list is
a run of rows and a step is one matrix product). Partial scores are accumulated
step by step; a pair whose partial score plus the product of the two remaining
norms is under the anchor's threshold is dropped, and what the index left out is added
for the others only. Scores are exact integers.

Thresholds start where a bounded sample of rows suggests and are lowered, for the anchors
whose windows aren't full, down to a value that can't miss a row: the sample's own
result for positives, the foot of the window for negatives. The sample decides what is
computed needlessly, never what is found.

Work is anchors x rows by nature (a stated query set against all rows); a task keeps, for
each anchor, no more rows than the windows hold, and only these are shuffled. A label
that holds a third of all rows is many blocks like any other.

Defined results: rows with a null id, a null label, a null vector or a null or
non-finite component, or without components take no part; missing components of shorter vectors count
as zero; rows that share an id are rows of their own, and ties between them go by the order
of storage; an anchor without positives gives no rows; an empty table gives none; extra
columns are left out. Scores beyond 64 bits wrap; they are exact up to there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.storage import land

POSITIVES = 5
NEGATIVES = 5
FLOOR = 80  # a window starts at this many hundredths of the positive's score
ROWS_IN_BLOCK = 2_048
ANCHOR_BYTES = 1 << 22
PAIRS_AT_ONCE = 1 << 21
SAMPLE = 1_024
STEP = 8
EASING = (0.25, 0.5)  # parts of the way to a window's foot at which thresholds halt
SLACK = 1e-6  # norms and bounds are rounded; a bound counts as lower only by more than this part
LOWEST, NEVER = -(1 << 62), 1 << 62
_BLOCK_SQL = "label long, ids binary, rows binary, vectors binary"
_BLOCK = pa.schema([("label", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("vectors", pa.binary())])


def whole_numbers(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part."""
    x = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(x.isNotNull() & fine, F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")))


def _packed(batches: Iterator[pa.RecordBatch], order: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows of one label from rows sorted by label."""

    def pad(vectors: pa.ListArray) -> np.ndarray:
        lengths = np.diff(np.asarray(vectors.offsets))
        out = np.zeros((len(vectors), len(order)), np.int64)
        out[np.repeat(np.arange(len(vectors)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(vectors.flatten())
        return out[:, order]

    def block(label: int, parts: list) -> pa.RecordBatch:
        columns = [np.concatenate([p[i] for p in parts]) for i in range(3)]
        return pa.RecordBatch.from_arrays([pa.array([label]), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], schema=_BLOCK)

    held, label, n = [], None, 0
    for batch in batches:
        labels, ids, rows = (batch[c].to_numpy() for c in ("label", "vec_id", "row"))
        vectors = pad(batch["vector"])
        edges = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]]) if len(labels) else []
        for start, stop in zip(edges, [*edges[1:], len(labels)]):
            while start < stop:
                if held and (labels[start] != label or n >= size):
                    yield block(int(label), held)
                    held, n = [], 0
                label, end = labels[start], min(stop, start + size - n)
                held.append((ids[start:end], rows[start:end], vectors[start:end]))
                n, start = n + end - start, end
    if held:
        yield block(int(label), held)


@dataclass
class Rows:
    """A block, or anchors: vectors (dimensions in the order of the index), ids, and storage order."""

    label: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, dims: int, blocks: list[tuple]) -> Rows:
        labels = [np.full(len(ids) // 8, label, np.int64) for label, ids, _, _ in blocks]
        ids, rows, flat = (np.concatenate([np.empty(0, np.int64), *(np.frombuffer(b[i], np.int64) for b in blocks)]) for i in (1, 2, 3))
        return cls(np.concatenate([np.empty(0, np.int64), *labels]), ids, rows, flat.reshape(len(ids), dims))

    def take(self, at: np.ndarray) -> Rows:
        return Rows(self.label[at], self.ids[at], self.rows[at], self.vectors[at])


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Column j: the norm of what lies behind the first j steps of dimensions."""
    square = vectors.astype(float) ** 2
    steps = -(-square.shape[1] // STEP)
    padded = np.zeros((len(square), steps * STEP))
    padded[:, : square.shape[1]] = square
    each = padded.reshape(len(square), steps, STEP).sum(axis=2)
    out = np.zeros((len(square), steps + 1))
    out[:, :steps] = each[:, ::-1].cumsum(axis=1)[:, ::-1]
    return np.sqrt(out)


class Index:
    """The inverted index of a block for the lowest threshold that is asked of it."""

    def __init__(self, block: Rows, norms: np.ndarray, lowest: float, longest: float):
        # how many steps a row has in the index: up to the suffix that its norm covers
        covered = norms * longest * (1 + SLACK) < lowest
        depth = np.where(covered.any(axis=1), covered.argmax(axis=1), norms.shape[1] - 1)
        order = np.argsort(-depth, kind="stable")
        self.block, self.norms, self.depth = block.take(order), norms[order], depth[order]
        self.columns = np.ascontiguousarray(self.block.vectors.T.astype(float))
        self.lists = [int((self.depth > step).sum()) for step in range(norms.shape[1] - 1)]

    def above(self, anchors: np.ndarray, norms: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row of the block and exact score of all pairs that reach the anchor's threshold."""
        a, n = len(anchors), len(self.block.ids)
        partial = np.zeros((a, n))
        alive = np.ones((a, n), bool)
        least = thresholds[:, None]
        queries = anchors.astype(float)
        for step, size in enumerate(self.lists):
            if not size:
                break
            dims = slice(step * STEP, (step + 1) * STEP)
            live = np.flatnonzero(alive[:, :size].any(axis=1))
            if not len(live):
                break
            partial[live, :size] += queries[live, dims] @ self.columns[dims, :size]
            rest = norms[live, step + 1, None] * self.norms[None, :size, step + 1]
            alive[live, :size] &= partial[live, :size] + rest + SLACK * (np.abs(partial[live, :size]) + rest) >= least[live]
        # rows that left dimensions out: the partial score is that of their indexed ones
        rest = np.take_along_axis(self.norms, self.depth[:, None], 1)[:, 0]
        own = norms[:, self.depth] * rest[None, :]
        alive &= partial + own + SLACK * (np.abs(partial) + own) >= least
        i, j = np.nonzero(alive)
        score = np.empty(len(i), np.int64)
        for at in range(0, len(i), PAIRS_AT_ONCE // 32):
            part = slice(at, at + PAIRS_AT_ONCE // 32)
            score[part] = np.einsum("ij,ij->i", anchors[i[part]], self.block.vectors[j[part]])
        keep = score >= thresholds[i]
        return i[keep], j[keep], score[keep]


def first_of_each(window: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of every window: by score downwards, id, row."""
    order = np.lexsort((rows, ids, -score, window))
    sorted_windows = window[order]
    starts = np.flatnonzero(np.r_[True, sorted_windows[1:] != sorted_windows[:-1]]) if len(order) else np.empty(0, int)
    at = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[at < k]


@dataclass
class Ask:
    """Anchors with windows [foot, top] of scores; ``start`` is the threshold each begins at. Window w of anchor i has number i * windows + w."""

    anchors: Rows
    norms: np.ndarray
    same_label: bool
    k: int
    start: np.ndarray
    foot: np.ndarray
    top: np.ndarray


class Found:
    """The best rows of every window so far."""

    def __init__(self, k: int):
        self.k, self.columns = k, [np.empty(0, np.int64) for _ in range(4)]

    def add(self, *columns: np.ndarray) -> None:
        all_columns = [np.concatenate(pair) for pair in zip(self.columns, columns)]
        keep = first_of_each(*all_columns, self.k)
        self.columns = [c[keep] for c in all_columns]

    def least(self, windows: int) -> np.ndarray:
        """The score of the last row of every full window; LOWEST for the others."""
        out = np.full(windows, NEVER)
        np.minimum.at(out, self.columns[0], self.columns[1])
        return np.where(np.bincount(self.columns[0], minlength=windows) >= self.k, out, LOWEST)


def search_block(ask: Ask, block: Rows, found: Found) -> None:
    """Add what the block has for the windows, lowering thresholds until they are full or at their foot."""
    norms = suffix_norms(block.vectors)
    mine = np.flatnonzero((ask.anchors.label == block.label[0]) == ask.same_label)
    size = max(1, PAIRS_AT_ONCE // max(1, len(block.ids)))
    for at in range(0, len(mine), size):
        _search_part(ask, block, norms, mine[at : at + size], found)


def _search_part(ask: Ask, block: Rows, norms: np.ndarray, asked: np.ndarray, found: Found) -> None:
    per = ask.foot.shape[1]
    # a full window asks for what is as good as its last row at least
    foot = np.maximum(ask.foot, found.least(ask.foot.size).reshape(ask.foot.shape))[asked]
    closed = ask.top[asked] < ask.foot[asked]
    foot[closed] = NEVER
    now = np.maximum(ask.start[asked], foot)
    start, before = now, np.full(len(asked), NEVER)
    got = np.zeros((len(asked), per), np.int64)
    open_ = np.flatnonzero(~closed.all(axis=1))
    eased = iter(EASING)
    while len(open_):
        thresholds = now[open_].min(axis=1)
        who = asked[open_]
        index = Index(block, norms, float(thresholds.min()), float(ask.norms[who, 0].max()))
        i, j, score = index.above(ask.anchors.vectors[who], ask.norms[who], thresholds)
        new = (score < before[open_[i]]) & (index.block.rows[j] != ask.anchors.rows[who[i]])
        i, j, score = i[new], j[new], score[new]
        ids, rows = index.block.ids[j], index.block.rows[j]
        for w in range(per):
            inside = np.flatnonzero((score >= ask.foot[who[i], w]) & (score <= ask.top[who[i], w]))
            got[open_, w] += np.bincount(i[inside], minlength=len(open_))
            keep = inside[first_of_each(i[inside], score[inside], ids[inside], rows[inside], found.k)]
            found.add(who[i[keep]] * per + w, score[keep], ids[keep], rows[keep])
        before[open_] = thresholds
        # a window rests when all its rows have been asked for, or this block alone has filled it
        rests = (thresholds[:, None] <= foot[open_]) | (got[open_] >= found.k)
        open_ = open_[~rests.all(axis=1)]
        part = next(eased, 1.0)
        lower = foot if part == 1 else (start - (start - foot) * part).astype(np.int64)
        now = np.maximum(foot, np.minimum(now, lower))


_FOUND = pa.schema([("window", pa.int64()), ("score", pa.int64()), ("id", pa.int64()), ("row", pa.int64())])


def _best(index: DataFrame, dims: int, ask: Ask) -> DataFrame:
    """The first k rows of every window over all blocks: window, score, id, row, rank."""
    shipped = index.sparkSession.sparkContext.broadcast(ask)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(k)
        for batch in batches:
            for values in zip(*(batch[c].to_pylist() for c in ("label", "ids", "rows", "vectors"))):
                search_block(shipped.value, Rows.of(dims, [values]), found)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found.columns], schema=_FOUND)

    k = ask.k
    own = index.mapInArrow(search, "window long, score long, id long, row long")
    ranked = F.row_number().over(Window.partitionBy("window").orderBy(F.desc("score"), "id", "row"))
    return own.withColumn("rank", ranked).filter(F.col("rank") <= ask.k)


def _sampled(index: DataFrame, dims: int, blocks: int) -> Rows:
    """A bounded sample of rows: the same number from every block, SAMPLE in all."""
    each = max(1, SAMPLE // max(1, blocks))
    some = index.filter(F.pmod(F.xxhash64("rows"), F.lit(max(1, blocks // SAMPLE))) == 0)
    cut = [F.substring(c, 1, 8 * each * (dims if c == "vectors" else 1)).alias(c) for c in ("ids", "rows", "vectors")]
    return Rows.of(dims, [tuple(r) for r in some.select("label", *cut).limit(SAMPLE).collect()])


def _from_sample(ask: Ask, sample: Rows) -> None:
    """Thresholds start at the sample's best score in a window; its k-th there is a foot that can't miss."""
    for at in range(0, len(ask.anchors.ids), SAMPLE):
        part = slice(at, at + SAMPLE)
        scores = ask.anchors.vectors[part] @ sample.vectors.T
        fit = (ask.anchors.label[part, None] == sample.label[None, :]) == ask.same_label
        fit &= ask.anchors.rows[part, None] != sample.rows[None, :]
        for w in range(ask.foot.shape[1]):
            inside = fit & (scores <= ask.top[part, w : w + 1]) & (scores >= ask.foot[part, w : w + 1])
            best = -np.sort(-np.where(inside, scores, LOWEST), axis=1)
            ask.start[part, w] = np.where(best[:, 0] > LOWEST, best[:, 0], ask.foot[part, w])
            if scores.shape[1] >= ask.k:
                ask.foot[part, w] = np.maximum(ask.foot[part, w], best[:, ask.k - 1])


def build(vectors: DataFrame, rows_in_block: int = ROWS_IN_BLOCK) -> tuple[DataFrame, int]:
    """Written blocks, and the number of dimensions, from rows of vec_id, label and vector (whole numbers)."""
    fine = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0")
    fine = fine.select(F.col("label").cast("long").alias("label"), F.col("vec_id").cast("long").alias("vec_id"), "vector")
    energy = fine.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim").agg(F.avg(F.col("x").cast("double") ** 2).alias("e"))
    order = [(r.dim, r.e) for r in energy.collect()]  # one row a dimension
    dims = len(order)
    places = np.array([d for d, _ in sorted(order, key=lambda r: (-r[1], r[0]))], np.int64)
    numbered = fine.withColumn("row", F.monotonically_increasing_id()).sortWithinPartitions("label")
    blocks = numbered.mapInArrow(lambda batches: _packed(batches, places, rows_in_block), _BLOCK_SQL)
    return land(blocks, "vector-blocks"), dims


def _anchor_batches(index: DataFrame, dims: int, every: int, at_once: int) -> Iterator[Rows]:
    """Anchors in bounded batches, which the driver passes on one after another."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, *values in zip(*(batch[c].to_pylist() for c in ("label", "ids", "rows", "vectors"))):
                rows = Rows.of(dims, [(label, *values)])
                mine = rows.take(np.flatnonzero(rows.ids % every == 0))
                if len(mine.ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label]), *(pa.array([c.tobytes()], pa.binary()) for c in (mine.ids, mine.rows, mine.vectors))], schema=_BLOCK
                    )

    anchors = land(index.mapInArrow(chosen, _BLOCK_SQL), "anchor-blocks")
    counted = anchors.select(F.length("ids").alias("n"), F.xxhash64("ids", "rows").alias("key"))
    total = (counted.agg(F.sum("n")).first()[0] or 0) // 8
    batches = max(1, -(-total // at_once))
    for i in range(batches):
        own = anchors.filter(F.pmod(F.xxhash64("ids", "rows"), F.lit(batches)) == i)
        yield Rows.of(dims, [tuple(r) for r in own.toLocalIterator()])


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def mine(index: DataFrame, dims: int, every: int = 100, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for all anchors: rows whose id ``every`` divides."""
    spark = index.sparkSession
    blocks = index.count()
    out = _empty(spark)
    if not dims or not blocks:
        return out
    sample = _sampled(index, dims, blocks)
    for anchors in _anchor_batches(index, dims, every, max(1, anchor_bytes // (8 * dims))):
        n = len(anchors.ids)
        if not n:
            continue
        norms = suffix_norms(anchors.vectors)
        shape = (n, 1)
        ask = Ask(anchors, norms, True, POSITIVES, np.full(shape, LOWEST), np.full(shape, LOWEST), np.full(shape, NEVER))
        _from_sample(ask, sample)
        positives = land(_best(index, dims, ask), "positives")
        rows = positives.collect()  # POSITIVES for each anchor of the batch
        top = np.full((n, POSITIVES), LOWEST, np.int64)
        foot = np.full((n, POSITIVES), NEVER, np.int64)  # no window
        for r in rows:
            top[r.window, r["rank"] - 1] = r.score
            foot[r.window, r["rank"] - 1] = -(-FLOOR * r.score // 100)
        ask = Ask(anchors, norms, False, NEGATIVES, foot.copy(), foot, top)
        _from_sample(ask, sample)
        negatives = land(_best(index, dims, ask), "negatives")
        names = spark.createDataFrame([(i, int(v)) for i, v in enumerate(anchors.ids)], "anchor long, anchor_id long")
        own = positives.select(
            (F.col("window") * POSITIVES + F.col("rank") - 1).alias("window"), F.col("window").alias("anchor"),
            F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        )
        joined = negatives.join(own, "window").join(names, "anchor")
        out = out.unionByName(
            joined.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        )
    return out
