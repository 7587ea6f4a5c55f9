"""Approximate nearest neighbours by balanced posting lists.

The measure is the inner product. Vectors get one more component that gives all
of them the length of the longest, queries a zero there, so that the largest
inner product is the smallest distance. A bounded sample is halved again and
again along the line between two means, at the median, until a cell holds
``CELL`` vectors; the means of these balanced cells, moved a few times to the mean of
the vectors nearest to them, are the centroids. Centroids are
searched best first on a nearest-neighbour graph in memory.

Every vector of the table is posted to its nearest list and, if it lies near a
boundary, to others as well: up to ``COPIES`` lists whose centroids are at most
``1 + SPREAD`` times as far away as the nearest. A query reads its ``most`` nearest
lists, but of these only those whose centroids are at most ``1 + reach`` times as
far away as the nearest, ``LISTS`` of them at least. Both are fitted with the
centroids: up to ``PROBES`` vectors of the
sample are searched among the sample; a share of ``IN_MOST`` of their nearest stands
in the ``most`` lists, and of ``IN_REACH`` within the ratio. A whole table is denser
than its sample, neighbours are nearer, and recall is no lower. Neighbouring lists are
compared together, in bundles cut into blocks of about ``BLOCK`` vectors and
``QUERIES`` queries, so that a long list is spread over tasks. A query reads the bundle of its nearest list
first, ``k + 1`` rows a block; its ``k + 1``-th best score there is the floor below which the
other bundles return nothing, so that their number doesn't multiply its rows.

Equal vectors are one entry with its ``k + 1`` smallest ids: ids beyond these lose
every tie, so nothing is lost. Equal queries are searched once. An id with several
different vectors is an entry of its own for each and counts with its best score.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id, nor vectors whose length isn't
the commonest one; ids that repeat are one row's own; ties go to the smaller id;
fewer than ``k`` candidates are all returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.storage import land

SAMPLE = 32_768
CELL = 16
REFINED = 6
NEIGHBOURS = 24
POST_BEAM = 32
ENTRIES = 16
COPIES = 2
SPREAD = 0.05
PROBES = 256
IN_MOST = 0.95
IN_REACH = 0.98
LISTS = 2
BLOCK = 4_096
QUERIES = 1_024
_AT_ONCE = 256
_EXPANDED = 1 / 16  # of a beam


def usable(vector: str | Column) -> Column:
    v = F.col(vector) if isinstance(vector, str) else vector
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & whole & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def balanced_centroids(vectors: np.ndarray, cell: int = CELL) -> np.ndarray:
    """Means of cells of at most ``cell`` vectors, equally full before they are refined."""
    rng, done, open_ = np.random.default_rng(7), [], [np.arange(len(vectors))]
    while open_:
        rows = open_.pop()
        if len(rows) <= cell:
            done.append(vectors[rows].mean(axis=0))
            continue
        x = vectors[rows]
        a, b = x[rng.choice(len(rows), 2, replace=False)]
        for _ in range(6):
            nearer = x @ (b - a) > (b @ b - a @ a) / 2
            if nearer.all() or not nearer.any():
                break
            a, b = x[~nearer].mean(axis=0), x[nearer].mean(axis=0)
        along = x @ (b - a)
        half = np.argsort(along, kind="stable")
        open_ += [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]
    means = np.array(done)
    for _ in range(REFINED):
        own = np.concatenate([_distances(vectors[at : at + _AT_ONCE], means).argmin(axis=1) for at in range(0, len(vectors), _AT_ONCE)])
        size = np.bincount(own, minlength=len(means))
        total = np.zeros_like(means)
        np.add.at(total, own, vectors)
        means = np.where(size[:, None] > 0, total / np.maximum(1, size)[:, None], means)
    return means


@dataclass
class Centroids:
    """Centroids and their graph. Their number is bounded by SAMPLE / CELL, whatever the table's size."""

    points: np.ndarray
    edges: np.ndarray
    entries: np.ndarray
    longest: float  # squared length of the longest vector
    reach: float = 0.0
    most: int = LISTS

    @classmethod
    def of(cls, points: np.ndarray, longest: float) -> Centroids:
        k = len(points)
        apart = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2) if k <= 64 else _distances(points, points)
        np.fill_diagonal(apart, np.inf)
        rng = np.random.default_rng(11)
        near = np.argsort(apart, axis=1)[:, : max(1, min(NEIGHBOURS, k - 1))]
        far = rng.integers(0, k, (k, 4))  # long links keep the graph in one piece
        ring = (np.arange(k) + 1) % k
        return cls(points, np.c_[near, far, ring], rng.permutation(k)[:ENTRIES], longest)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.longest - (vectors**2).sum(axis=1)))
        return np.c_[vectors, rest]

    def nearest(self, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``beam`` centroids nearest to each target found by walking the graph, and their distances."""
        parts = [self._walk(targets[at : at + _AT_ONCE], beam) for at in range(0, len(targets), _AT_ONCE)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _walk(self, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best first, the nearest unvisited centroids of the beam, a share of ``_EXPANDED`` of it at a time."""
        n, k = len(targets), len(self.points)
        beam, row = min(beam, k), np.arange(n)[:, None]
        seen = np.zeros((n, k), bool)
        seen[:, self.entries] = True
        ids = np.tile(self.entries, (n, 1))
        apart = _distances(targets, self.points[self.entries])
        fresh = np.ones(ids.shape, bool)
        lengths = (self.points**2).sum(axis=1)
        while True:
            waiting = np.where(fresh, apart, np.inf)
            most = min(max(4, int(_EXPANDED * beam)), waiting.shape[1])
            best = np.argpartition(waiting, most - 1, axis=1)[:, :most]
            live = np.isfinite(waiting[row, best])
            if not live.any():
                order = np.argsort(apart, axis=1, kind="stable")
                return np.take_along_axis(ids, order, 1), np.sqrt(np.take_along_axis(apart, order, 1))
            fresh[row, best] = False
            # what nothing leads to stands for an entry, which has been seen
            out = np.where(live[:, :, None], self.edges[ids[row, best]], self.entries[0]).reshape(n, -1)
            out = np.sort(out, axis=1)
            new = ~seen[row, out]
            new[:, 1:] &= out[:, 1:] != out[:, :-1]  # a neighbour listed twice counts once
            at, which = np.nonzero(new)
            seen[at, out[at, which]] = True
            far = np.full(out.shape, np.inf)
            found = out[at, which]
            far[at, which] = np.maximum(0, (targets[at] ** 2).sum(axis=1) - 2 * (targets[at] * self.points[found]).sum(axis=1) + lengths[found])
            ids, apart, fresh = np.c_[ids, out], np.c_[apart, far], np.c_[fresh, new]
            if ids.shape[1] > beam:
                keep = np.argpartition(apart, beam - 1, axis=1)[:, :beam]
                ids, apart, fresh = (np.take_along_axis(x, keep, 1) for x in (ids, apart, fresh))

    def posted(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The lists of each vector: the nearest, and others near a boundary."""
        ids, apart = self.nearest(self.lifted(vectors), POST_BEAM)
        near = (apart <= (1 + SPREAD) * apart[:, :1]) & (np.arange(ids.shape[1]) < COPIES) & np.isfinite(apart)
        return [found[n] for found, n in zip(ids, near)]

    def read(self, queries: np.ndarray) -> list[np.ndarray]:
        """The lists that each query reads, by the ratio of distances."""
        ids, apart = self.nearest(np.c_[queries, np.zeros(len(queries))], max(POST_BEAM, self.most))
        ids, apart = ids[:, : self.most], apart[:, : self.most]
        near = (apart <= (1 + self.reach) * apart[:, :1]) | (np.arange(ids.shape[1]) < LISTS)
        return [found[n & np.isfinite(d)] for found, n, d in zip(ids, near, apart)]

    def fit_reach(self, vectors: np.ndarray, k: int) -> None:
        """Set ``most`` and ``reach`` by the nearest of a few vectors among all ``vectors``."""
        probes = np.random.default_rng(13).permutation(len(vectors))[:PROBES]
        asked = vectors[probes]
        apart = np.sqrt(_distances(np.c_[asked, np.zeros(len(asked))], self.points))
        place = apart.argsort(axis=1, kind="stable").argsort(axis=1)
        ratio = apart / np.maximum(apart.min(axis=1, keepdims=True), 1e-300)
        product = asked @ vectors.T
        product[np.arange(len(probes)), probes] = -np.inf
        k = min(k, len(vectors) - 1)
        if k:
            top = np.argpartition(-product, k - 1, axis=1)[:, :k]
            nearest, back = np.unique(top, return_inverse=True)
            lists, back = self.posted(vectors[nearest]), back.reshape(top.shape)
            needed = [(place[i, lists[j]].min(), ratio[i, lists[j]].min()) for i in range(len(top)) for j in back[i]]
            places, ratios = zip(*needed)
            self.most = max(LISTS, 1 + int(np.quantile(places, IN_MOST, method="higher")))
            self.reach = float(np.quantile(ratios, IN_REACH, method="higher")) - 1


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)[None, :])


def _choose(rows: DataFrame, longest: float, k: int) -> Centroids | None:
    """Centroids and reach from the SAMPLE rows with the lowest hashes, computed in a task."""
    sample = rows.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v", F.lit("all").alias("group"))

    def means(table: pa.Table) -> pa.Table:
        vectors = _matrix(table["v"])
        found = Centroids.of(balanced_centroids(Centroids(np.zeros((0, 0)), None, None, longest).lifted(vectors)), longest)
        found.fit_reach(vectors, k)
        n = len(found.points)
        return pa.table({"c": pa.array(list(found.points), pa.list_(pa.float64())), "reach": [found.reach] * n, "most": [found.most] * n})

    fitted = sample.groupBy("group").applyInArrow(means, "c array<double>, reach double, most long").toArrow()
    if not fitted.num_rows:
        return None
    centroids = Centroids.of(_matrix(fitted["c"]), longest)
    centroids.reach, centroids.most = fitted["reach"][0].as_py(), fitted["most"][0].as_py()
    return centroids


def _with_lists(rows: DataFrame, key: str, centroids: Centroids, how: str) -> DataFrame:
    shipped = rows.sparkSession.sparkContext.broadcast(centroids)

    def lists(vectors: pa.Array) -> pa.Array:
        found = getattr(shipped.value, how)(_matrix(vectors)) if len(vectors) else []
        return pa.array([f.tolist() for f in found], pa.list_(pa.int32()))

    return rows.select(key, "v", F.arrow_udf(lists, "array<int>").asNondeterministic()("v").alias("lists"))


@dataclass
class Index:
    """``entries``: entry, v, ids (the smallest of equal vectors). ``postings``: entry, v, list.
    ``bundle`` neighbouring lists are compared together."""

    entries: DataFrame
    postings: DataFrame
    centroids: Centroids | None
    k: int
    bundle: int = 1


def build(table: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> Index:
    """Index every usable row of ``table`` for searches of up to ``k`` neighbours."""
    rows = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull() & usable("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    rows = rows.filter(F.size("v") == (lengths[0].n if lengths else 0)).withColumn("h", F.xxhash64("v"))
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    once = rows.dropDuplicates(["h", "v", "id"])
    again = once.groupBy("id").count().filter("count > 1").select("id", F.col("id").alias("again"))
    unique = once.join(again, "id", "left")
    alone = unique.filter("again IS NOT NULL").select("v", F.col("id").alias("entry"), F.array("id").alias("ids"))
    least = unique.filter("again IS NULL").withColumn("place", place).filter(F.col("place") <= k + 1)
    entries = least.groupBy("h", "v").agg(F.min("id").alias("entry"), F.sort_array(F.collect_set("id")).alias("ids")).select("v", "entry", "ids")
    entries = entries.unionByName(alone)
    entries = land(entries.select("entry", "v", "ids"), "ann-entries")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    longest = entries.agg(F.max(square)).first()[0]
    centroids = _choose(entries, longest, k) if longest is not None else None
    if centroids is None:
        return Index(entries, entries.select("entry", "v", F.lit(0).alias("list")).limit(0), None, k)
    posted = _with_lists(entries, "entry", centroids, "posted").select("entry", "v", F.explode("lists").alias("list"))
    postings = land(posted, "ann-postings")
    return Index(entries, postings, centroids, k, max(1, BLOCK * len(centroids.points) // postings.count()))


def _best_of_list(queries: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a query and a vector, and their scores, for the ``k + 1`` best vectors of each query at least."""
    rough = queries @ vectors.T
    most = min(k + 1, rough.shape[1])
    edge = np.partition(rough, rough.shape[1] - most, axis=1)[:, rough.shape[1] - most]
    slack = 1e-12 * np.sqrt((queries**2).sum(axis=1) * (vectors**2).sum(axis=1).max())
    q, v = np.nonzero(rough >= (edge - slack)[:, None])
    # summed row by row, so that a pair has the same score in every block
    return q, v, (queries[q] * vectors[v]).sum(axis=1)


def _scores(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best ``k + 1`` entries of a block of lists for each query of a block, in the lists that it reads, if they reach its floor."""
    queries, vectors = _matrix(left["v"]), _matrix(right["v"])
    entry, home = right["entry"].to_numpy(), right["list"].to_numpy()
    order = np.argsort(home, kind="stable")
    lists, start = np.unique(home[order], return_index=True)
    reads = left["lists"].combine_chunks()
    reader, wanted = np.repeat(np.arange(left.num_rows), reads.value_lengths()), reads.flatten().to_numpy()
    by_list = np.argsort(wanted, kind="stable")
    reader, wanted = reader[by_list], wanted[by_list]
    parts = []
    for one, a, b in zip(lists, start, np.append(start[1:], len(order))):
        rows, own = reader[np.searchsorted(wanted, one) : np.searchsorted(wanted, one, "right")], order[a:b]
        if len(rows) and len(own):
            q, v, score = _best_of_list(queries[rows], vectors[own], k)
            parts.append((rows[q], entry[own[v]], score))
    if not parts:
        return pa.table({"q": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    q, e, score = (np.concatenate(x) for x in zip(*parts))
    ranked = np.lexsort((-score, e, q))  # the best score of each entry
    q, e, score = q[ranked], e[ranked], score[ranked]
    first = np.r_[True, (q[1:] != q[:-1]) | (e[1:] != e[:-1])]
    q, e, score = q[first], e[first], score[first]
    ranked = np.lexsort((e, -score, q))
    q, e, score = q[ranked], e[ranked], score[ranked]
    kept = (np.arange(len(q)) - np.searchsorted(q, q) <= k) & (score >= left["floor"].to_numpy()[q])
    return pa.table({"q": left["q"].take(pa.array(q[kept])), "entry": pa.array(e[kept]), "score": pa.array(score[kept])})


def _compared(reading: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """``q``, ``entry``, ``score``: what queries find in the bundles that ``reading`` names, by blocks."""
    blocks = (
        postings.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("vector_blocks"))
        .join(reading.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("query_blocks")), "bundle")
    )  # one row per list at most
    blocks = F.broadcast(land(blocks, "ann-blocks"))

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    left = reading.join(blocks, "bundle").select("bundle", F.pmod(F.xxhash64("q"), "query_blocks").alias("qb"), each("vector_blocks").alias("vb"), "q", "v", "lists", "floor")
    right = postings.join(blocks, "bundle").select(
        "bundle", each("query_blocks").alias("qb"), F.pmod(F.xxhash64("entry", "v"), "vector_blocks").alias("vb"), "entry", "v", "list"
    )
    keys = ["bundle", "qb", "vb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: _scores(a, b, k), "q long, entry long, score double")


def search(index: Index, queries: DataFrame, query_id: str = "query_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the best found for each usable query but its own row."""
    k, spark = index.k, queries.sparkSession
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(vector).cast(index.entries.schema["v"].dataType).alias("v"))
    asked = asked.filter(F.col("query_id").isNotNull() & usable("v")).withColumn("h", F.xxhash64("v"))
    if index.centroids is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = asked.filter(F.size("v") == index.centroids.points.shape[1] - 1)
    own = asked.groupBy("h", "v").agg(F.min("query_id").alias("least")).select(F.monotonically_increasing_id().alias("q"), "h", "v")
    own = land(own, "ann-queries")
    read = _with_lists(own, "q", index.centroids, "read")
    bundles = F.array_distinct(F.transform("lists", lambda x: (x / index.bundle).cast("int")))
    part = F.filter("lists", lambda x: (x / index.bundle).cast("int") == F.col("bundle"))
    home = (F.element_at("lists", 1) / index.bundle).cast("int").alias("home")
    reading = land(read.select("q", "v", "lists", home, F.explode(bundles).alias("bundle")).withColumn("lists", part), "ann-reading")
    postings = index.postings.withColumn("bundle", (F.col("list") / index.bundle).cast("int"))
    lowest = F.lit(float("-inf"))
    near = land(_compared(reading.filter("bundle = home").withColumn("floor", lowest), postings, k), "ann-near")
    best_near = near.groupBy("q", "entry").agg(F.max("score").alias("score")).groupBy("q")
    floors = best_near.agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores")).select("q", F.get("scores", F.lit(k)).alias("floor"))
    others = reading.filter("bundle <> home").join(floors, "q", "left").withColumn("floor", F.coalesce("floor", lowest))
    scored = near.unionByName(_compared(land(others, "ann-others"), postings, k))
    scored = scored.groupBy("q", "entry").agg(F.max("score").alias("score"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "entry"))), 1, k + 1)
    top = scored.groupBy("q").agg(best.alias("top")).select("q", F.explode("top").alias("t")).select("q", "t.*")
    named = top.join(index.entries.select("entry", "ids").distinct(), "entry")
    all_ids = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct("minus", i.alias("vec_id")))))
    found = named.groupBy("q").agg(F.slice(F.array_sort(all_ids), 1, k + 1).alias("found"))
    mine = asked.join(own, ["h", "v"]).select("query_id", "q").join(found, "q")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return mine.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score")
    )
