"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts with one shingle set are one node. SimHash fingerprints within a few bits
and the texts that share most rare shingles propose first links. They can't
propose all: at 0.8 fingerprints differ by about 10 of 64 bits, often by 18, and no
blocks make a radius of that size cheap. So every pair that isn't connected yet is
looked for by prefixes: shingles stand in one order for all texts, rare ones first, and of two
texts with similarity 0.8 or more, the first n - ceil(0.8 n) + 1 shingles of
both have one in common. How many they must share follows from n, so that few
pairs remain. Shingles that the same texts have are one entry with a weight.

Of texts alike, as many as share a shingle make pairs with each other, so these
aren't rows: texts near in size that have the same most frequent first shingle
are packed into tiles of about ``TILE`` texts and ``TOKENS`` shingles, tiles that share enough
first shingles meet, and a task compares all texts of two tiles at once: the first shingles that both tiles have, then sketches,
then whole sets. A sketch has the parity of the number of shingles in each bucket of their hashes: sets that differ in d shingles
differ in at most d parities, so what a sketch rules out isn't alike, and only sets that it doesn't rule out are moved.
A task returns no more links than it takes to connect them. Every link is verified by the exact similarity of the two sets.

The order takes common shingles from a sample of texts. It decides what is
compared needlessly, not what is found: any order finds every pair.

Defined results: null, empty and white texts are one node; a text of fewer than
five words has one shingle, all of it. Nodes, and shingles within a text, are
told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.simhash_dedup import near_links, shingle_hashes, vote
from millrace.storage import discard, land

WORDS_IN_SHINGLE = 5
SAMPLE_TEXTS = 10_000
COMMON_IN_SAMPLE = 4
COMMON_AT_MOST = 200_000
ROWS_AT_ONCE = 100_000
NODES_SEEN = 100_000
CROWD = 16
TILE = 128
TOKENS = 1 << 15
BUCKETS_A_SHINGLE = 2
LEAST_BUCKETS = 64
BITS_A_ROW = 16
MOST_BITS = 1 << 27
SLICE = 1 << 16
_ENTRY = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])
_ENTRY_SQL = "key long, node long, n long"


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, WORDS_IN_SHINGLE))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Is the Jaccard similarity 4/5 or more?"""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * both >= 4 * (len(a) + len(b))


def printed(text: Column | str) -> Column:
    """``fp``, the SimHash fingerprint, and ``node``, the hash of the shingle set."""

    def column(texts: pa.Array) -> pa.Array:
        prints, nodes = [], []
        for t in texts:
            hashes = shingle_hashes(t.as_py(), WORDS_IN_SHINGLE)
            prints.append(vote(hashes))
            nodes.append(xxhash.xxh64_intdigest(np.unique(hashes).tobytes()))
        columns = [pa.array(np.array(x, np.uint64).view(np.int64), pa.int64()) for x in (prints, nodes)]
        return pa.StructArray.from_arrays(columns, ["fp", "node"])

    return F.arrow_udf(column, "struct<fp: bigint, node: bigint>")(text)


def _entries(batches: Iterator[pa.RecordBatch], choose) -> Iterator[pa.RecordBatch]:
    """Key, node and size of the chosen shingles of each node. A node that comes again in a task is mostly passed over."""
    seen: set[int] = set()
    held: list[tuple[np.ndarray, int, int]] = []
    size = 0

    def rows() -> pa.RecordBatch:
        keys = np.concatenate([k for k, _, _ in held]).view(np.int64)
        each = [len(k) for k, _, _ in held]
        columns = [keys, *(np.repeat(np.array([h[j] for h in held], np.int64), each) for j in (1, 2))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_ENTRY)

    for batch in batches:
        for node, text in zip(batch["node"].to_pylist(), batch["text"]):
            if node in seen:
                continue
            if len(seen) >= NODES_SEEN:
                seen.clear()
            seen.add(node)
            own = shingle_set(text.as_py())
            held.append((choose(own), node, len(own)))
            size += len(held[-1][0])
            if size >= ROWS_AT_ONCE:
                yield rows()
                held, size = [], 0
    if held:
        yield rows()


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample have, sorted, and in how many."""
    step = max(1, texts.count() // SAMPLE_TEXTS)
    some = texts.filter(F.pmod("node", F.lit(step)) == 0).select("node", "text")
    keys = some.mapInArrow(lambda batches: _entries(batches, lambda own: own), _ENTRY_SQL)
    counts = keys.groupBy("key").count().filter(F.col("count") >= COMMON_IN_SAMPLE)
    found = counts.orderBy(F.desc("count"), "key").limit(COMMON_AT_MOST).toArrow()
    common, n = found["key"].to_numpy().view(np.uint64), found["count"].to_numpy()
    order = np.argsort(common)
    return common[order], n[order]


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles by (count, hash); two sets with similarity 4/5 or more share one of these."""
    n = len(own)
    first = n - (4 * n + 4) // 5 + 1
    if not len(common):
        return own[:first]
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return own[np.argsort(np.where(common[at] == own, counts[at], 0), kind="stable")[:first]]


def _of_several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and node, once each, those whose key several nodes have."""
    last, met = np.empty((3, 0), np.int64), False
    for batch in batches:
        rows = np.concatenate([last, np.array([batch[c].to_numpy() for c in ("key", "node", "n")])], axis=1)
        if not rows.shape[1]:
            continue
        new = np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)]
        rows = rows[:, new]
        same = rows[0, 1:] == rows[0, :-1]
        shared = np.r_[met, same]
        shared[:-1] |= same
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[:, :-1][:, shared[:-1]]], schema=_ENTRY)
        last, met = rows[:, -1:], bool(shared[-1])
    if met:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in last], schema=_ENTRY)


def _narrowed(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts without most of those that aren't in ``rows``, so that a join with these doesn't shuffle them all.

    A bit for each hash of a row tells; there are at least BITS_A_ROW bits for each row, up to MOST_BITS in all, made in slices.
    """
    bits = min(MOST_BITS, max(SLICE, 1 << (BITS_A_ROW * rows.count()).bit_length()))
    at = F.pmod(F.xxhash64("row"), F.lit(bits))

    def marked(slice_: tuple, part: pa.Table) -> pa.Table:
        seen = np.zeros(SLICE, np.uint8)
        seen[part["at"].to_numpy() % SLICE] = 1
        return pa.table({"slice": pa.array([slice_[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(seen).tobytes()], pa.binary())})

    slices = rows.select(at.alias("at")).groupBy(F.floor(F.col("at") / SLICE).alias("slice")).applyInArrow(marked, "slice long, bits binary").toArrow()
    table = np.zeros(bits // 8, np.uint8)
    for k, part in zip(slices["slice"].to_pylist(), slices["bits"].to_pylist()):
        table[k * SLICE // 8 : (k + 1) * SLICE // 8] = np.frombuffer(part, np.uint8)
    known = texts.sparkSession.sparkContext.broadcast(table)

    def column(at: pa.Array) -> pa.Array:
        place = at.to_numpy()
        return pa.array((known.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1)

    return texts.filter(F.arrow_udf(column, "boolean")(at))


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs ``a``, ``b`` of nodes whose texts are alike."""
    pairs = land(pairs, "pairs", free=True)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    rows = texts.select("node", "row").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
    rows = land(rows, "rows", free=True)
    own = land(_narrowed(texts.select("row", "text"), rows).join(rows, "row").select("node", "text"), "texts", free=True)

    def column(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([alike(shingle_set(x.as_py()), shingle_set(y.as_py())) for x, y in zip(a, b)], pa.bool_())

    both = pairs.join(own.toDF("a", "text_a"), "a").join(own.toDF("b", "text_b"), "b")
    links = land(both.filter(F.arrow_udf(column, "boolean")("text_a", "text_b")).select("a", "b"), "links", free=True)
    discard(pairs, rows, own)
    return links


def _merged(shared: DataFrame) -> DataFrame:
    """Entries with a ``weight``: of the shingles that the same nodes have one stays and counts for all."""
    held = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"by_{k}") for k in (0, 1)]
    once = shared.groupBy("key").agg(*held).groupBy("by_0", "by_1").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight"))
    return land(shared.join(once.select("key", "weight"), "key"), "merged", free=True)


def _proposed(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """At most a few pairs a node: near fingerprints, and the hub with which it shares most, if that is enough for a link."""
    nodes = texts.select("fp", "node").distinct()
    least = land(nodes.groupBy("fp").agg(F.min("node").alias("least")), "prints", free=True)
    equal = nodes.join(least, "fp").select(F.col("node").alias("a"), F.col("least").alias("b"))
    near = near_links(least.select("fp"))
    for side in ("a", "b"):
        near = near.join(least.toDF(side, f"node_{side}"), side)
    hubs = shared.groupBy("key").agg(F.min(F.struct("node", "n")).alias("h")).select("key", F.col("h.node").alias("hub"), F.col("h.n").alias("n_hub"))
    to_hub = shared.join(hubs, "key").filter("node <> hub AND 5 * least(n, n_hub) >= 4 * greatest(n, n_hub)")
    counted = to_hub.groupBy("node", "n", "hub", "n_hub").agg(F.sum("weight").alias("c"))
    # whatever they share outside both prefixes lies in the rest of one of them
    enough = counted.filter("9 * (c + (4 * greatest(n, n_hub) + 4) div 5 - 1) >= 4 * (n + n_hub)")
    most = enough.groupBy("node").agg(F.max(F.struct("c", "hub"))["hub"].alias("hub"))
    every = equal.union(near.select("node_a", "node_b")).union(most)
    return every.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _tiled(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries whose shingle nodes of several components have, with the ``root`` and the ``tile`` of their node."""
    labelled = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keys = labelled.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("often"))
    open_ = land(labelled.join(keys.filter("least <> most").select("key", "often"), "key"), "open", free=True)
    size = F.floor(F.log("n") / F.log(F.lit(1.25))).alias("size")
    most = F.max(F.struct("often", "key")).alias("most")
    home = F.when(F.col("most.often") >= CROWD, F.col("most.key")).otherwise(F.col("node")).alias("home")
    homes = open_.groupBy("node", "n").agg(most).select("node", "n", home, size)
    parts = homes.groupBy("home", "size").agg(F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n") / TOKENS)).alias("parts"))
    tile = F.xxhash64("home", "size", F.pmod(F.xxhash64("node"), "parts")).alias("tile")
    place = (F.row_number().over(Window.partitionBy("tile").orderBy("node")) - 1).alias("place")
    placed = homes.join(parts, ["home", "size"]).select("node", tile).select("node", "tile", place)
    tiled = land(open_.drop("often").join(placed, "node"), "tiled", free=True)
    discard(open_)
    return tiled


def _meeting(tiled: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of tiles, once each, that may hold a link between two components, with ``held``: for each
    first shingle that both have, its weight and the places of the members that have it."""
    one = F.when(F.min("root") == F.max("root"), F.min("root")).alias("whole")
    tiles = land(tiled.groupBy("tile").agg(one, F.min("n").alias("low"), F.max("n").alias("high")), "tiles", free=True)
    places = F.collect_list("place").alias("places")
    held = tiled.groupBy("key", "tile").agg(F.min("weight").alias("weight"), places).join(tiles, "tile")
    sides = [held.toDF(*(f"{c}_{x}" if c not in ("key", "weight") else c for c in held.columns)) for x in ("a", "b")]
    fit = "tile_a < tile_b AND 5 * high_a >= 4 * low_b AND 5 * high_b >= 4 * low_a AND (whole_a IS NULL OR whole_b IS NULL OR whole_a <> whole_b)"
    met = sides[0].join(sides[1].drop("weight"), "key").filter(f"({fit}) OR (tile_a = tile_b AND whole_a IS NULL)").repartition("tile_a")
    each = F.collect_list(F.struct("weight", "places_a", "places_b")).alias("held")
    counted = met.groupBy("tile_a", "tile_b", "low_a", "high_a", "low_b", "high_b").agg(F.sum("weight").alias("c"), each)
    # what sizes m >= s must share at least, 20 * s - 16 * m + 9 of 45, is least for the largest m and the smallest s
    enough = counted.filter("45 * c >= 9 + greatest(0, least(20 * low_b - 16 * high_a, 20 * low_a - 16 * high_b))")
    return enough.select(F.col("tile_a").alias("a"), F.col("tile_b").alias("b"), "held")


def promising(weight: np.ndarray, held: tuple[np.ndarray, np.ndarray], left: dict[str, np.ndarray], right: dict[str, np.ndarray]) -> np.ndarray:
    """Nodes of one tile that share enough first shingles with a node of the other, of another component, for a link.

    ``held`` tells for either tile which members (columns) have which shingles; ``left`` and ``right`` are the members: ``node``, ``n`` and ``root``.
    """
    n_a, n_b = left["n"][:, None], right["n"][None, :]
    most, both = np.maximum(n_a, n_b), n_a + n_b
    # whatever they share outside both prefixes lies in the rest of one of them
    fit = (9 * ((held[0] * weight[:, None]).T @ held[1] + (4 * most + 4) // 5 - 1) >= 4 * both) & (5 * (both - most) >= 4 * most)
    return left["node"][(fit & (left["root"][:, None] != right["root"][None, :])).any(axis=1)]


def sketch(own: np.ndarray) -> np.ndarray:
    """For each of a power of two of buckets the parity of the number of hashes in it, 64 to a word."""
    buckets = max(LEAST_BUCKETS, 1 << (BUCKETS_A_SHINGLE * len(own)).bit_length())
    counts = np.bincount((own & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) as they are with fewer buckets."""
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def near(left: list[dict], right: list[dict]) -> tuple[list[int], list[int]]:
    """Nodes of either list of members (node, root, n, own: their sketch) that a sketch doesn't tell apart from all
    members of other components in the other."""
    sketches = [np.frombuffer(m["own"], np.uint64) for m in right]
    n, root = np.array([m["n"] for m in right]), np.array([m["root"] for m in right])
    by_words = {w: np.flatnonzero([len(x) == w for x in sketches]) for w in {len(x) for x in sketches}}
    stacks = {w: np.stack([sketches[j] for j in at]) for w, at in by_words.items()}
    kept, hit = [], np.zeros(len(right), bool)
    for m in left:
        own, some = np.frombuffer(m["own"], np.uint64), False
        for w, at in by_words.items():
            words = min(w, len(own))
            differ = np.bitwise_count(folded(own, words) ^ folded(stacks[w], words)).sum(axis=1, dtype=np.int64)
            fit = (9 * differ <= n[at] + m["n"]) & (root[at] != m["root"])
            hit[at[fit]] = True
            some |= bool(fit.any())
        if some:
            kept.append(m["node"])
    return kept, [m["node"] for m, of in zip(right, hit) if of]


def spanning(left: list[dict], right: list[dict]) -> list[dict]:
    """Links of members (node, root, own: their set) of one list with those of the other that connect all that any
    links of these connect; members with the same root are connected."""
    top: dict[int, int] = {m["root"]: m["root"] for m in (*left, *right)}

    def first(root: int) -> int:
        while top[root] != root:
            root = top[root]
        return root

    sets = [np.frombuffer(m["own"], np.uint64) for m in right]
    union, at = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum([0, *map(len, sets)])
    sizes, links = np.diff(starts), []
    for m in left:
        others = np.array([first(o["root"]) != first(m["root"]) for o in right])
        if not others.any():
            continue
        own = np.frombuffer(m["own"], np.uint64)
        place = np.minimum(np.searchsorted(union, own), len(union) - 1)
        hit = np.zeros(len(union), np.int32)
        hit[place[union[place] == own]] = 1
        both = np.add.reduceat(hit[at], starts[:-1])
        for j in np.flatnonzero(others & (9 * both >= 4 * (sizes + len(own)))).tolist():
            a, b = first(m["root"]), first(right[j]["root"])
            if a != b:
                top[max(a, b)] = min(a, b)
                links.append({"a": m["node"], "b": right[j]["node"]})
    return links


def _parts(lists: pa.Array) -> Iterator[tuple[int, int]]:
    ends = lists.offsets.to_numpy().tolist()
    return zip(ends, ends[1:])


def _members_of(lists: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    fields = {f.name: lists.values.field(f.name).to_numpy() for f in lists.type.value_type}
    for a, b in _parts(lists):
        yield {name: x[a:b] for name, x in fields.items()}


def _marks(places: pa.Array, a: int, b: int, members: int) -> np.ndarray:
    """Lists of places as rows of zeros and ones."""
    ends = places.offsets.to_numpy()[a : b + 1]
    out = np.zeros((b - a, members))
    out[np.repeat(np.arange(b - a), np.diff(ends)), places.values.to_numpy()[ends[0] : ends[-1]]] = 1
    return out


def _asked(tiled: DataFrame) -> DataFrame:
    """Nodes of the tile ``a`` and tiles ``b`` with which they may have a link."""
    members = tiled.select("tile", "place", "node", "n", "root").distinct().groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("place", "node", "n", "root"))).alias("of"))

    def column(held: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        weight, *places = (held.values.field(f.name) for f in held.type.value_type)
        weight, found = weight.to_numpy(), []
        for (a, b), *both in zip(_parts(held), _members_of(left), _members_of(right)):
            marks = tuple(_marks(x, a, b, len(of["node"])) for x, of in zip(places, both))
            found.append(promising(weight[a:b], marks, *both))
        return pa.array(found, pa.list_(pa.int64()))

    both = _meeting(tiled).join(members.toDF("a", "left"), "a").join(members.toDF("b", "right"), "b")
    return land(both.select("a", "b", F.explode(F.arrow_udf(column, "array<bigint>")("held", "left", "right")).alias("node")), "asked", free=True)


def _owned(texts: DataFrame, rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], label: str) -> DataFrame:
    """The rows of members with ``own``: what ``of`` makes of their sets."""

    def column(some: pa.Array) -> pa.Array:
        return pa.array([of(shingle_set(x.as_py())).tobytes() for x in some], pa.binary())

    own = F.arrow_udf(column, "binary")("text").alias("own")
    return land(_narrowed(texts.select("row", "text"), rows).join(rows, "row").select("tile", "node", "n", "root", own), label, free=True)


def _side_by_side(asked: DataFrame, there: DataFrame, own: DataFrame) -> DataFrame:
    """``left``, the members that are asked, and ``right``, those of ``there``, for each pair of tiles."""
    member = F.struct("node", "root", "n", "own")
    left = asked.join(own.drop("tile"), "node").repartition("b").groupBy("a", "b").agg(F.collect_list(member).alias("left"))  # by b alone: so it also meets the right
    right = there.groupBy(F.col("tile").alias("b")).agg(F.collect_list(member).alias("right"))
    return left.join(right, "b")


def _near(texts: DataFrame, rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of tiles with the nodes on either side, ``left`` and ``right``, that sketches don't rule out."""
    own = _owned(texts, rows, sketch, "sketches")

    def column(left: pa.Array, right: pa.Array) -> pa.Array:
        found = [near(a.as_py(), b.as_py()) for a, b in zip(left, right)]
        kind = pa.list_(pa.int64())
        return pa.StructArray.from_arrays([pa.array(x, kind) for x in zip(*found)] if found else [pa.array([], kind)] * 2, ["left", "right"])

    both = _side_by_side(asked, own, own)
    fit = F.arrow_udf(column, "left array<bigint>, right array<bigint>")("left", "right").alias("fit")
    found = land(both.select("a", "b", fit).select("a", "b", "fit.*").filter("size(left) > 0"), "near", free=True)
    discard(own)
    return found


def _compared(texts: DataFrame, tiled: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` of nodes that connect what the links between components connect."""
    asked, members = _asked(tiled), tiled.select("node", "n", "root", "tile").distinct()
    wanted = asked.select("node").union(members.join(asked.select(F.col("b").alias("tile")).distinct(), "tile").select("node")).distinct()
    rows = texts.select("node", "row").join(members.join(wanted, "node"), "node").groupBy("node", "n", "root", "tile").agg(F.min("row").alias("row"))
    rows = land(rows, "rows", free=True)
    found = _near(texts, rows, asked)
    asking = found.select("a", "b", F.explode("left").alias("node"))
    answering = found.select(F.explode("right").alias("node")).distinct()
    left = land(rows.join(asking.select("node").union(answering).distinct(), "node", "left_semi").select(*rows.columns), "rows", free=True)
    own = _owned(texts, left, lambda own: own, "sets")

    def links(left: pa.Array, right: pa.Array) -> pa.Array:
        linked = [spanning(a.as_py(), b.as_py()) for a, b in zip(left, right)]
        return pa.array(linked, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    both = _side_by_side(asking, own.join(answering, "node", "left_semi"), own)
    linked = F.arrow_udf(links, "array<struct<a: bigint, b: bigint>>")("left", "right")
    links = land(both.select(F.explode(linked).alias("l")).select("l.a", "l.b"), "links", free=True)
    discard(asked, rows, found, left, own)
    return links


def near_copies(texts: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node that is linked and isn't itself the root,
    for a landed frame with ``row`` (unique), ``node``, ``fp`` and ``text``."""
    common = texts.sparkSession.sparkContext.broadcast(common_shingles(texts))
    entries = texts.select("node", "text").mapInArrow(lambda batches: _entries(batches, lambda own: prefix(own, *common.value)), _ENTRY_SQL)
    shared = land(entries.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_of_several, _ENTRY_SQL), "shared", free=True)
    merged = _merged(shared)
    discard(shared)
    links = _verified(texts, _proposed(texts, merged))
    tiled = _tiled(merged, components(links))
    discard(merged)
    more = _compared(texts, tiled)
    discard(tiled)
    return components(links.union(more))
