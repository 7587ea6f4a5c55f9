"""Running columns over many slots against a walk over the ordered rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import windows as w
from millrace.operators.slots import plan_slots

SHAPES = {"spread": 40, "tied": 4, "one time": 1}


def rows_of(times, hot, seed):
    draw = random.Random(seed)
    users = ["hot"] * 6 + ["a", "b", None] if hot else ["a", "b", "c", "d", None]
    return [(i, draw.randrange(times), draw.choice(users), draw.choice([None, None, 3, -5, 8])) for i in draw.sample(range(1000), 150)]


@pytest.fixture(params=[(name, hot) for name in SHAPES for hot in (True, False)], ids=str)
def data(request, spark):
    name, hot = request.param
    rows = rows_of(SHAPES[name], hot, 3)
    df = spark.createDataFrame(rows, "id int, t int, u string, v int").repartition(3)
    return df, sorted(rows, key=lambda r: (r[1], r[0]))


def test_many_slots(data):
    df, _ = data
    assert plan_slots(df, ["t", "id"], rows_per_slot=7).slots > 10
    assert plan_slots(df, ["t", "id"], ["u"], rows_per_slot=7).slots > 10


@pytest.mark.parametrize("by", [[], ["u"]], ids=["whole", "by user"])
def test_running_columns(data, by):
    df, rows = data
    kind = df.schema["v"].dataType
    columns = [w.sum_of("v", kind, 10, "total"), w.number_from(5, "no"), w.filled("v", ["t", "id"], True, "full"), w.filled("v", ["t", "id"], False, "past")]
    got = {r.id: (r.total, r.no, r.full, r.past) for r in w.add_running(df, columns, ["t", "id"], by, rows_per_slot=7).collect()}
    state, first = {}, {}
    for i, _, u, v in rows:
        if v is not None:
            first.setdefault(u if by else 0, v)
    want = {}
    for i, _, u, v in rows:
        key = u if by else 0
        total, no, past = state.get(key, (10, 4, None))
        total, no, past = total + (v or 0), no + 1, past if v is None else v
        state[key] = (total, no, past)
        want[i] = (total, no, first.get(key) if past is None else past, past)
    assert got == want


def test_sessions(data):
    df, rows = data
    numbered = w.marker_sessions(df, F.col("v") == 8, "t", ["id"], rows_per_slot=7)
    got = {r.id: r.call_number for r in numbered.collect()}
    assert got == {i: sum(v == 8 for _, t2, _, v in rows if t2 <= t) for i, t, _, _ in rows}


def test_nothing_to_number(spark):
    empty = spark.createDataFrame([], "id int, t int, v int")
    assert w.running_sum(empty, "v", ["t", "id"], rows_per_slot=7).collect() == []
