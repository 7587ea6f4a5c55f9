"""Benchmark decontamination by SimHash over item-sized windows.

Texts are cut into lower-cased words. For every benchmark item, documents are
read through windows as long as the item. A window's 64-bit SimHash is the
weighted vote of its five-word shingles; fingerprints are compared with the
items' by multi-index hashing: two fingerprints within ``radius`` bits differ by
at most ``radius // 8`` bits in one of the eight bytes, so that looking up, for
each byte, the items with a byte that near yields every item within the radius.
Each candidate is then verified exactly: the weighted Jaccard similarity of the
shingles (as multisets, weighted by rarity among the items) must reach
``similarity``. Neighbouring windows that match one item give one row, the best.

A window without any shingle of the benchmark has similarity zero with every
item and is not fingerprinted. The benchmark is read in blocks of
``ITEMS_AT_ONCE`` items; every block sees all documents, whole. Weights are
counted over the whole benchmark, so that rows don't depend on the blocks.
Every block is broadcast with the shingles that more than one item has, the only
ones whose weight isn't the greatest.

Defined results: null texts count as empty; a text or item of fewer than five
words has one shingle, all of it; an item or text without words matches nothing;
repeated items match each under its own id; repeated documents give repeated rows;
ties between windows go to the earliest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_IN_SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BYTES = 8
ITEMS_AT_ONCE = 2_000
WINDOWS_AT_ONCE = 4_096
CHARACTERS_AT_ONCE = 1 << 19
_FILTER_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "item_id long, first_word long, last_word long, similarity double"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: is it part of a word (a letter, a digit or an underscore)?"""
    return np.array([chr(c).isalnum() or c == 0x5F for c in range(0x110000)])


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    base = 0x2545F4914F6CDD1D
    pair = [np.full(CHARACTERS_AT_ONCE, x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
    for powers in pair:
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
    return pair[0], pair[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts together, and the number of words before each text and in all."""
    codes = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) if t.isascii() else len(t.lower()) for t in texts], np.int64)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = _letters()[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    up, down = _powers()
    at = 0
    while at < len(starts):  # in pieces of as many characters as there are powers
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + CHARACTERS_AT_ONCE, side="right")))
        low, high = int(starts[at]), int(ends[upto - 1])
        if high - low > CHARACTERS_AT_ONCE:  # one enormous word
            hashes[at] = xxhash.xxh64_intdigest(codes[low:high].tobytes())
        else:
            mixed = codes[low:high].astype(np.uint64) + np.uint64(1)
            mixed *= _MIX
            mixed ^= mixed >> np.uint64(31)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(mixed * up[: high - low], out=sums[1:])
            own = slice(at, upto)
            part = (sums[ends[own] - low] - sums[starts[own] - low]) * down[starts[own] - low]
            part ^= part >> np.uint64(32)
            hashes[own] = part * _MIX
        at = upto
    begins = np.cumsum(np.r_[0, lengths + 1])
    return hashes, np.searchsorted(starts, begins)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words; of the whole, if there are fewer."""
    n = min(WORDS_IN_SHINGLE, len(words))
    if not n:
        return np.empty(0, np.uint64)
    count = len(words) - n + 1
    mixed = np.zeros(count, np.uint64)
    for k in range(n):
        mixed = (mixed ^ words[k : k + count]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _votes(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits * 2.0 - 1.0) * weights[:, None]


def _print(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=-1, bitorder="little")


@dataclass
class Weights:
    """Weights of shingles by rarity among all items. ``known`` (sorted) holds those that several items have."""

    known: np.ndarray
    weights: np.ndarray
    rare: float

    def weigh(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.weights[at], self.rare)


def weights_of(known: np.ndarray, items_with: np.ndarray, items: int) -> Weights:
    """Weights are multiples of 2**-20: sums of them are exact, in whatever order."""
    step = 1 << 20
    own = np.round((1.0 + np.log(items / items_with)) * step) / step
    return Weights(known, own, float(np.round((1.0 + np.log(max(items, 1))) * step) / step))


@dataclass
class Items:
    """A block of the benchmark, ready to be compared with. ``near[b][v]`` is the
    bit set of the items whose byte b is near v."""

    ids: list[int]
    shingles: list[np.ndarray]
    known: np.ndarray
    weights: Weights
    filter: np.ndarray
    prints: np.ndarray
    near: np.ndarray
    by_size: dict[int, np.ndarray]

    def weigh(self, hashes: np.ndarray) -> np.ndarray:
        return self.weights.weigh(hashes)


def prepare(rows: list[tuple[int, str | None]], radius: int = RADIUS, weights: Weights | None = None) -> Items | None:
    """A block of items. Without ``weights`` the block is the whole benchmark."""
    cut = [(i, shingles(word_hashes([t or ""])[0])) for i, t in rows]
    cut = [(i, s) for i, s in cut if len(s)]
    if not cut:
        return None
    known, items_with = np.unique(np.concatenate([np.unique(s) for _, s in cut]), return_counts=True)
    if weights is None:
        several = items_with > 1
        weights = weights_of(known[several], items_with[several], len(cut))
    filter_ = np.zeros(1 << _FILTER_BITS, bool)
    filter_[known >> np.uint64(64 - _FILTER_BITS)] = True
    items = Items([i for i, _ in cut], [s for _, s in cut], known, weights, filter_, None, None, {})
    items.prints = np.array([_print(_votes(s, items.weigh(s)).sum(axis=0)) for s in items.shingles])
    values = np.arange(256, dtype=np.uint8)
    near = [np.bitwise_count(values[:, None] ^ items.prints[None, :, b]) <= radius // BYTES for b in range(BYTES)]
    items.near = np.packbits(np.array(near), axis=-1)
    sizes = np.array([len(s) for s in items.shingles])
    items.by_size = {int(n): np.packbits(sizes == n) for n in np.unique(sizes)}
    return items


def similarity(a: np.ndarray, b: np.ndarray, items: Items) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(at[: len(a)], minlength=len(both)), np.bincount(at[len(a) :], minlength=len(both))
    w = items.weigh(both)
    return float((np.minimum(x, y) * w).sum() / (np.maximum(x, y) * w).sum())


def _candidates(prints: np.ndarray, items: Items, size: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) pairs within the radius, among the items of this size."""
    looked_up = reduce(np.bitwise_or, (items.near[b][prints[:, b]] for b in range(BYTES)))
    window, item = np.nonzero(np.unpackbits(looked_up & items.by_size[size], axis=1)[:, : len(items.ids)])
    apart = np.bitwise_count(prints[window] ^ items.prints[item]).sum(axis=1, dtype=np.int64)
    return window[apart <= radius], item[apart <= radius]


def _hits(own: np.ndarray, items: Items) -> np.ndarray:
    """Places of the shingles that the benchmark has."""
    maybe = np.flatnonzero(items.filter[own >> np.uint64(64 - _FILTER_BITS)])
    return maybe[np.isin(own[maybe], items.known)]


def find(words: np.ndarray, items: Items, least: float = SIMILARITY, radius: int = RADIUS) -> list[tuple[int, int, int, float]]:
    """(item, first word, last word, similarity) of every passage that matches an item."""
    own = shingles(words)
    hits = _hits(own, items)
    if not len(hits):
        return []
    found: list[tuple[int, int, int, float]] = []
    for size in items.by_size:
        if size > len(own):
            window = np.array([0])
        else:
            reach = (hits[:, None] - np.arange(size)[None, :]).ravel()
            window = np.unique(reach[(reach >= 0) & (reach <= len(own) - size)])
        best: dict[int, tuple[float, int]] = {}
        ended: dict[int, int] = {}

        def close(i: int, size: int = size, best: dict = best) -> None:
            s, at = best.pop(i)
            found.append((items.ids[i], at, min(len(words), at + size + WORDS_IN_SHINGLE - 1) - 1, s))

        for first in range(0, len(window), WINDOWS_AT_ONCE):
            part = window[first : first + WINDOWS_AT_ONCE]
            low, high = int(part[0]), int(min(len(own), part[-1] + size))
            votes = np.zeros((high - low + 1, 64))
            np.cumsum(_votes(own[low:high], items.weigh(own[low:high])), axis=0, out=votes[1:])
            prints = _print(votes[np.minimum(part + size, high) - low] - votes[part - low])
            for w, i in zip(*_candidates(prints, items, size, radius)):
                at = int(part[w])
                s = similarity(own[at : at + size], items.shingles[i], items)
                if s < least:
                    continue
                if i in best and at > ended[i] + size:
                    close(i)
                if i not in best or s > best[i][0]:
                    best[i] = (s, at)
                ended[i] = at
        for i in list(best):
            close(i)
    return found


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str | None]]]:
    rows: list[tuple[int, str | None]] = []
    for r in benchmark.select(item_id, text).orderBy(item_id).toLocalIterator():
        rows.append((r[0], r[1]))
        if len(rows) == ITEMS_AT_ONCE:
            yield rows
            rows = []
    if rows:
        yield rows


def benchmark_weights(benchmark: DataFrame, text: str) -> Weights:
    """Weights over all items; an item without words doesn't count."""

    def hashes(texts: pa.Array) -> pa.Array:
        own = [np.unique(shingles(word_hashes([t or ""])[0])).view(np.int64) for t in texts.to_pylist()]
        return pa.array(own, pa.list_(pa.int64()))

    own = benchmark.select(F.arrow_udf(hashes, "array<long>").asNondeterministic()(text).alias("own"))
    items = own.filter(F.size("own") > 0).count()
    counts = own.select(F.explode("own").alias("h")).groupBy("h").count().filter("count > 1").toArrow()
    known, items_with = counts["h"].to_numpy().view(np.uint64), counts["count"].to_numpy()
    order = np.argsort(known)
    return weights_of(known[order], items_with[order], items)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "matches",
) -> DataFrame:
    """Add ``out``: an array of structs, one per passage and item matched; empty for clean documents."""
    spark = docs.sparkSession
    columns = []
    weights = benchmark_weights(benchmark, item_text)
    for rows in _blocks(benchmark, item_id, item_text):
        items = prepare(rows, radius, weights)
        if items is not None:
            columns.append(_match_column(spark.sparkContext.broadcast(items), text, least, radius))
    none = F.array().cast(f"array<struct<{MATCHES.replace(' long', ': bigint').replace(' double', ': double')}>>")
    return docs.withColumn(out, F.array_sort(F.concat(none, *columns)))


def find_all(texts: list[str], items: Items, least: float = SIMILARITY, radius: int = RADIUS) -> list[list[tuple[int, int, int, float]]]:
    """``find`` for many texts. Texts that share no shingle with the benchmark are passed over together."""
    out: list[list] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        upto, characters = at, 0
        while upto < len(texts) and (upto == at or characters + len(texts[upto]) < CHARACTERS_AT_ONCE):
            characters += len(texts[upto])
            upto += 1
        words, begins = word_hashes(texts[at:upto])
        counts = np.diff(begins)
        some = np.zeros(upto - at, bool)
        some[(counts > 0) & (counts < WORDS_IN_SHINGLE)] = True
        if len(words) >= WORDS_IN_SHINGLE:
            some[np.searchsorted(begins, _hits(shingles(words), items), side="right") - 1] = True
        for k in np.flatnonzero(some).tolist():
            out[at + k] = find(words[begins[k] : begins[k + 1]], items, least, radius)
        at = upto
    return out


def _match_column(items, text: str, least: float, radius: int):
    def match(texts: pa.Array) -> pa.Array:
        rows = find_all([t or "" for t in texts.to_pylist()], items.value, least, radius)
        names = ("item_id", "first_word", "last_word", "similarity")
        kind = pa.list_(pa.struct(list(zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.float64())))))
        return pa.array([[dict(zip(names, m)) for m in row] for row in rows], kind)

    kind = f"array<struct<{MATCHES.replace(' long', ': bigint').replace(' double', ': double')}>>"
    # marked so that no plan reads the text twice to test the array before using it
    return F.arrow_udf(match, kind).asNondeterministic()(text)
