"""Near-duplicates by SimHash, compared on bit planes.

A text's fingerprint has 64 bits. Two fingerprints link if they differ in at
most ``radius`` bits. With more blocks than ``radius``, any two that link agree
on ``blocks - radius`` whole blocks, so every choice of so many blocks gives a
table in which they meet. Rows that meet are compared bit-sliced: bit planes are
stored vertically, 64 rows to a machine word, a plane is compared with itself
moved by d rows, carry-save counters add up the differing bits of all pairs at
once, and a word of pairs is abandoned when each of its pairs is past the radius.

Equal fingerprints are one node, so that copies cost nothing here. A key that
many distinct fingerprints share is cut into tiles, and each pair of tiles is a
group of its own: no group exceeds two tiles, and no pair is lost. A task
emits a spanning forest of the links it finds, never all pairs.

Defined results: a null or empty text, or one of white space alone, has
fingerprint zero and is linked like any other; repeated rows share a component;
rows whose id is null are linked too, and a component without any id has a null
one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.storage import land

BITS = 64
WORDS_IN_SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS = 6
TILE = 512
PLANES_A_STEP = 8
_ROWS_AT_ONCE = 1 << 16


def shingle_hashes(text: str | None, words_in_shingle: int = WORDS_IN_SHINGLE, seed: int = SEED) -> np.ndarray:
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - words_in_shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, stops)], np.uint64)


def vote(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _ROWS_AT_ONCE):
        some = hashes[at : at + _ROWS_AT_ONCE]
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    set_bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def simhash(text: str | None, words_in_shingle: int = WORDS_IN_SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text: bit b is set if it is set in over half the shingle hashes."""
    return vote(shingle_hashes(text, words_in_shingle, seed))


def fingerprint(text: Column | str, words_in_shingle: int = WORDS_IN_SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as a signed long that has the same bits."""

    def column(texts: pa.Array) -> pa.Array:
        prints = np.array([simhash(t.as_py(), words_in_shingle, seed) for t in texts], np.uint64)
        return pa.array(prints.view(np.int64), pa.int64())

    return F.arrow_udf(column, "long")(text)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Row b holds bit b of every fingerprint, 64 fingerprints to a word, and one word of zeros at the end."""
    words = -(-len(prints) // BITS)
    bits = np.zeros((BITS, (words + 1) * BITS), np.uint8)
    bits[:, : len(prints)] = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _moved(planes: np.ndarray, words: np.ndarray, by: int) -> np.ndarray:
    """The given words of the planes, moved so that row i stands where row i - ``by`` stood."""
    whole, part = divmod(by, BITS)
    last = planes.shape[1] - 1
    low = planes[:, np.minimum(words + whole, last)]
    if not part:
        return low
    high = planes[:, np.minimum(words + whole + 1, last)]
    return (low >> np.uint64(part)) | (high << np.uint64(BITS - part))


def near_rows(planes: np.ndarray, rows: np.ndarray, by: int, radius: int) -> np.ndarray:
    """Those of ``rows`` (sorted) whose fingerprint is within ``radius`` of the one ``by`` rows on."""
    words, at = np.unique(rows // BITS, return_inverse=True)
    alive = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(alive, at, np.uint64(1) << (rows % BITS).astype(np.uint64))
    digits = radius.bit_length() + 1
    # counters start so that the top digit is reached with the first bit past the radius
    start = (1 << (digits - 1)) - 1 - radius
    counters = [np.full(len(words), ~np.uint64(0) if start >> k & 1 else np.uint64(0)) for k in range(digits)]
    for first in range(0, BITS, PLANES_A_STEP):
        step = planes[first : first + PLANES_A_STEP]
        differ = step[:, words] ^ _moved(step, words, by)
        for carry in differ:
            for k in range(digits - 1):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            counters[-1] |= carry
        alive &= ~counters[-1]
        live = alive != 0
        if not live.any():
            return rows[:0]
        if not live.all():
            words, alive = words[live], alive[live]
            counters = [c[live] for c in counters]
    bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    which, offset = np.nonzero(bits)
    return words[which] * BITS + offset


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        i = parent[i]
    return i


def spanning_links(groups: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside groups (``groups`` is sorted)."""
    n = len(prints)
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, n])
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # rows from here to the group's end
    parent = np.arange(n)
    planes = bit_planes(prints)
    rows = np.flatnonzero(left > 1)
    by = 1
    while len(rows):
        linked = near_rows(planes, rows, by, radius)
        apart = linked[parent[linked] != parent[linked + by]]
        for i in apart.tolist():
            a, b = _root(parent, i), _root(parent, i + by)
            parent[max(a, b)] = min(a, b)
        if len(apart):
            while (parent != parent[parent]).any():
                parent = parent[parent]
        by += 1
        rows = rows[left[rows] > by]
    own = np.flatnonzero(parent != np.arange(n))
    return prints[own], prints[parent[own]]


def _link_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group. A group may run on into the next batch."""
    held: pa.Table | None = None

    def links(part: pa.Table) -> pa.RecordBatch:
        keys = [part[c].to_numpy() for c in ("key", "tile_a", "tile_b")]
        new = np.zeros(part.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        prints = part["fp"].to_numpy().view(np.uint64)
        a, b = spanning_links(np.cumsum(new), np.ascontiguousarray(prints), radius)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64), pa.int64()) for x in (a, b)], ["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        last = np.ones(rows.num_rows, bool)
        for c in ("key", "tile_a", "tile_b"):
            values = rows[c].to_numpy()
            last &= values == values[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        held = rows.slice(cut)
        if cut:
            yield links(rows.slice(0, cut))
    if held is not None and held.num_rows:
        yield links(held)


def _block_keys(blocks: int, same: int) -> list[Column]:
    """One key for every choice of ``same`` blocks of the fingerprint."""
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    keys = []
    for chosen in combinations(range(blocks), same):
        key = F.lit(len(keys)).cast("long")
        for k in chosen:
            width = edges[k + 1] - edges[k]
            part = F.shiftrightunsigned("fp", edges[k]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return keys


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` that connect whatever fingerprints (distinct ``fp``) are connected."""
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    keyed = prints.select("fp", F.explode(F.array(*_block_keys(blocks, blocks - radius))).alias("key"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).alias("tiles"))
    own = F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1)))
    tiled = keyed.join(hot, "key", "left").select(
        "fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("tiles", F.lit(1)) - 1)).alias("other")
    )
    grouped = tiled.select("key", F.least("own", "other").alias("tile_a"), F.greatest("own", "other").alias("tile_b"), "fp")
    sorted_rows = grouped.repartition("key", "tile_a", "tile_b").sortWithinPartitions("key", "tile_a", "tile_b")
    return sorted_rows.mapInArrow(lambda batches: _link_batches(batches, radius), "a long, b long").distinct()


def label_components(printed: DataFrame, id_col: str, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """``fp`` and ``component_id`` for a landed frame with ``fp`` and ``id_col``."""
    prints = land(printed.groupBy("fp").agg(F.min(id_col).alias("least_id")), "prints")
    linked = components(near_links(prints.select("fp"), radius, blocks, tile))
    rooted = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``
    (the smallest id reachable over links), one row per row of ``docs``."""
    printed = land(docs.select(id_col, fingerprint(text).alias("fp")), "fingerprints")
    labels = label_components(printed, id_col)
    return printed.join(labels, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
