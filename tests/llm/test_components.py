"""Components in rounds and in one task."""

from __future__ import annotations

import random

import pytest

from millrace.llm import components as co


def brute_force(edges):
    root = {x: x for e in edges for x in e if None not in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and b is not None and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return {x: r for x, r in root.items() if x != r}


def graph():
    rng = random.Random(4)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)]
    path = rng.sample(range(1000, 1100), 100)
    return edges + edges[:9] + list(zip(path, path[1:])) + [(5, 5), (None, 3), (2000, None)]


@pytest.mark.parametrize("at_once", [0, 150, 1 << 19])
def test_components_in_rounds_and_at_once(spark, monkeypatch, at_once):
    """All rounds, a few rounds and one task give the smallest node reachable, once a node."""
    monkeypatch.setattr(co, "AT_ONCE", at_once)
    got = co.components(spark.createDataFrame(graph(), "a long, b long").repartition(5)).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == brute_force(graph())
    assert co.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_a_small_graph_takes_no_rounds(spark, monkeypatch):
    """The driver plans and compiles each round anew, which adds up over many components."""
    landed, real = [], co.land

    def counted(df, *x, **k):
        landed.append(df)
        return real(df, *x, **k)

    monkeypatch.setattr(co, "land", counted)
    path = list(zip(range(200), range(1, 201)))
    got = co.components(spark.createDataFrame(path, "a long, b long"))
    assert {r.root for r in got.collect()} == {0}
    assert len(landed) == 2
