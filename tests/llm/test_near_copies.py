"""The near-dedup stage against brute force over five-word shingle sets."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest

from millrace.llm import components, near_copies


def word_sets(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """Ids of the first row of each component."""
    sets = [word_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [rows[i][0] for i in range(len(rows)) if root(i) == i]


@pytest.mark.parametrize("common", [1, 200_000])
def test_stage_equals_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(near_copies, "COMMON_AT_MOST", common)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choices(words, k=40))  # common to many, near copies or not
    texts = [None, "", " \t", "one two", "One  TWO", "one three", *[line] * 3]
    for size in (6, 30, 120, 400):
        for _ in range(4):
            base = rng.choices(words, k=size)
            for edits in (0, 0, 1, 2, 3, 4, 5, 7, 9):
                own = list(base)
                for k in rng.sample(range(size), min(size, edits * max(1, size // 150))):
                    own[k] = rng.choice(words)
                texts.append(" ".join(own) + (f" {line}" if rng.random() < 0.3 else ""))
    texts += [f"{line} {' '.join(rng.choices(words, k=k))}" for k in range(4, 40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute_force(rows)
    got = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in got.collect()) == want
    assert len(want) < len(rows)


def test_shuffles_are_removed_as_soon_as_read(spark, monkeypatch):
    """Those of the steps before would otherwise stay on disk beside the texts that are compared."""
    kept = []
    real = near_copies.land

    def landed(df, label="landed", free=False):
        if not free:
            kept.append(label)
        return real(df, label, free)

    monkeypatch.setattr(near_copies, "land", landed)
    monkeypatch.setattr(components, "land", landed)
    texts = [f"{k % 3} a b c d e f g h i j k l m n o p {k % 5}" for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert corpus_pipeline.one_of_each_group(spark, docs, "").count() == len(brute_force(list(enumerate(texts))))
    assert kept == []


def crowd(size):
    """Copies of one text with two or three changed words, which are about as alike as a link asks for."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(size):
        own = list(base)
        for k in rng.sample(range(200), 2 + i % 2):
            own[k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    return list(enumerate(texts + [f"{rng.random()} {t}" for t in texts[:5]]))


@pytest.mark.parametrize("tile, of", [(128, 16), (8, 2)])
def test_a_crowd_is_compared_in_tiles(spark, monkeypatch, tile, of):
    """No step writes a row for each pair of a crowd, and no link is lost."""
    monkeypatch.setattr(near_copies, "TILE", tile)
    monkeypatch.setattr(near_copies, "CROWD", of)
    rows, written = crowd(300), {}
    real = near_copies.land

    def landed(df, label="landed", free=False):
        out = real(df, label, free)
        written[label] = max(written.get(label, 0), out.count())
        return out

    monkeypatch.setattr(near_copies, "land", landed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == brute_force(rows)
    assert max(written["pairs"], written["links"]) < 10 * len(rows)


def test_only_wanted_texts_are_shuffled(spark):
    """A join with few rows gets few texts, and all of these, whatever the rows are numbered by."""
    texts = spark.range(3000).selectExpr("xxhash64(id) AS row", "concat('text ', id) AS text", "id")
    rows = texts.filter("id % 60 = 7").select("row")
    kept = near_copies._narrowed(texts, rows)
    assert kept.join(rows, "row", "left_semi").count() == 50
    assert kept.count() < 100
    assert near_copies._narrowed(texts, rows.limit(0)).count() == 0


def member(node, own, sketched=True):
    return {"node": node, "root": node, "n": len(own), "own": (near_copies.sketch(own) if sketched else own).tobytes()}


def test_sketches_rule_out_no_link():
    """Sets on the edge of a link, of sizes whose sketches have the same or other lengths; half alike ones are ruled out."""
    rng = np.random.default_rng(3)
    for n in (1, 4, 9, 31, 33, 100, 127, 130, 1000, 4100):
        for _ in range(20):
            both = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
            apart = rng.integers(0, 1 << 64, n // 4, np.uint64, endpoint=False)
            cut = rng.integers(0, len(apart) + 1)
            a, b = np.union1d(both, apart[:cut]), np.union1d(both, apart[cut:])
            assert near_copies.alike(a, b)
            assert near_copies.near([member(1, a)], [member(2, b)]) == ([1], [2])
        if n >= 100:
            assert near_copies.near([member(1, both)], [member(2, np.union1d(both[: n // 2], ~both[n // 2 :]))]) == ([], [])


def test_sets_that_only_share_a_passage_are_not_moved(spark, monkeypatch):
    """They share enough first shingles for a link; the more texts there are, the more of these."""
    rng, rows, sizes = random.Random(9), [], {}
    for k in range(60):
        passage = [f"p{k}w{i}" for i in range(70)]
        rows += [" ".join(passage + [f"t{rng.random()}" for _ in range(30)]) for _ in range(2)]
    rows = list(enumerate(rows + [rows[0] + " end"]))
    real = near_copies.land

    def landed(df, label="landed", free=False):
        out = real(df, label, free)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(near_copies, "land", landed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == brute_force(rows)
    assert sizes["asked"] > 40
    assert sizes["sets"] <= 2
