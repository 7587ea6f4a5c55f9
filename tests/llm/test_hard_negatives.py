"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from millrace.llm import hard_negatives
from millrace.llm.hard_negatives import Index, Rows, build, mine, suffix_norms, whole_numbers

SCHEMA = "vec_id long, label int, embedding array<double>, rank string"


def brute(rows: list[tuple], every: int) -> list[tuple]:
    fine = []
    for i, label, vector, *_ in rows:
        if i is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector):
            fine.append((i, label, [math.floor(256 * x) for x in vector]))
    out = []
    for at, (anchor, label, v) in enumerate(fine):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, n) for k, (i, n, w) in enumerate(fine) if k != at]
        scored.sort(key=lambda s: s[:2])
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(anchor, positive, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fit)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("vector", whole_numbers("embedding"))


def cloud(seed: int, n: int, dims: int, labels: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    own = rng.choice(labels, n, p=np.r_[0.4, np.full(labels - 1, 0.6 / (labels - 1))])
    x = centres[own] + rng.normal(size=(n, dims)) * 0.8
    told = np.where(rng.random(n) < 0.3, rng.integers(0, labels, n), own)
    return [(i, int(told[i]), [float(v) for v in x[i]], "own") for i in range(n)]


@pytest.mark.parametrize("block,anchor_bytes", [(7, 8 * 20 * 5), (64, 1 << 22)])
def test_rows_equal_all_pairs(spark, block, anchor_bytes):
    rows = cloud(1, 400, 20, 4)
    rows += [(10_000 + i, 1, rows[0][2], "copy") for i in range(40)]  # one very common vector
    rows += [(20_000, 2, rows[5][2][:11], ""), (20_010, 2, None, ""), (20_020, None, rows[5][2], ""), (None, 1, rows[5][2], "")]
    rows += [(20_030, 1, [float("nan")] * 20, ""), (20_040, 1, [None] * 20, ""), (20_050, 1, [], ""), (20_060, 3, [0.0] * 20, "")]
    rows += [(20_070, 9, rows[3][2], ""), (20_080, 8, rows[4][2], ""), (20_081, 8, [-x for x in rows[4][2]], "")]  # no or no close positive
    index, dims = build(table(spark, rows), block)
    got = sorted(tuple(r) for r in mine(index, dims, 10, anchor_bytes).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == brute(rows, 10)
    assert len(got) > 500


def test_index_leaves_out_what_norms_cover():
    rng = random.Random(2)
    scale = [200] * 8 + [20] * 8 + [2] * 16
    vectors = np.array([[rng.randrange(-s, s + 1) for s in scale] for _ in range(300)], np.int64)
    rows = Rows(np.zeros(300, np.int64), np.arange(300), np.arange(300), vectors)
    anchors, norms = vectors[:20], suffix_norms(vectors)
    scores = anchors @ vectors.T
    for share in (0.9, 0.6, 0.3, 0.01):
        limits = (scores.max(axis=1) * share).astype(np.int64)
        index = Index(rows, norms, float(limits.min()), float(norms[:20, 0].max()))
        i, j, score = index.above(anchors, norms[:20], limits)
        assert sorted(zip(i, index.block.ids[j], score)) == sorted((a, b, scores[a, b]) for a, b in zip(*np.nonzero(scores >= limits[:, None])))
    index = Index(rows, norms, float(scores.max() / 2), float(norms[:20, 0].max()))
    assert index.lists[-1] == 0 and sum(index.lists) < 300 * 3


def test_ties_repeated_ids_and_empty_tables(spark):
    v = [1.0, 0.5]
    rows = [(0, 1, v, ""), (0, 1, v, ""), (3, 2, v, ""), (2, 2, v, ""), (2, 2, v, ""), (7, 1, [0.0, 0.0], "")]
    got = sorted(tuple(r)[:4] for r in mine(*build(table(spark, rows)), 5).collect())
    # two anchors with one id, each with the other as its first positive; the second has a score of zero and no negative
    assert got == sorted(2 * [(0, 0, 1, 2), (0, 0, 2, 2), (0, 0, 3, 3)])
    empty = mine(*build(table(spark, rows).limit(0)))
    assert empty.count() == 0 and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mine(*build(table(spark, [(1, 1, v, "")])), 5).count() == 0


def test_the_sample_and_the_easing_decide_no_row(spark, monkeypatch):
    rows = cloud(4, 200, 9, 3)
    want = None
    for sample, easing in ((1, ()), (64, (0.25, 0.5)), (1_024, (0.9,))):
        monkeypatch.setattr(hard_negatives, "SAMPLE", sample)
        monkeypatch.setattr(hard_negatives, "EASING", easing)
        got = sorted(tuple(r) for r in mine(*build(table(spark, rows), 16), 20).collect())
        assert want is None or got == want
        want = got
    assert want
