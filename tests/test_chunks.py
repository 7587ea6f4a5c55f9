"""Files cut where a restarting buffer is full."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from millrace.operators.restarts import number_by_restart
from millrace.sources.csv_files import restart_plan, row_bytes, write_chunked


def walk(sizes, limit):
    no, held, out = 1, 0, []
    for size in sizes:
        out.append(no)
        held += size or 0
        if held >= limit:
            no, held = no + 1, 0
    return out


@pytest.mark.parametrize(
    "sizes, limit",
    [
        ([random.Random(1).choice([0, 0, 1, 2, 5, 13, None]) for _ in range(180)], 9),
        ([0, 0, 9, 0, 0, 10, 1, 8, 0], 9),
        ([4], 5),
        ([None, 0], 1),
        ([], 5),
    ],
)
def test_equals_a_walk(spark, sizes, limit):
    df = spark.createDataFrame(list(enumerate(sizes)), "id int, size int")
    got = {r.id: r.file_no for r in number_by_restart(df, "size", ["id"], limit, rows_per_slot=23).collect()}
    assert [got[i] for i in range(len(sizes))] == walk(sizes, limit)


def test_files_hold_what_was_planned(spark, tmp_path):
    words = ["", None, 'say "so"', "a,b", "two\nlines", " é ", "plain " * 9]
    df = spark.createDataFrame([(i, words[i % 7], i / 3, i % 2 == 0) for i in range(60)], "id int, word string, x double, even boolean")
    write_chunked(df, f"file://{tmp_path}/out", ["id"], 400)
    sizes = [r.row_bytes for r in row_bytes(df).orderBy("id").collect()]
    want = {}
    for no, size in zip(walk(sizes, 400), sizes):
        want[no] = want.get(no, 0) + size
    header = len('"id","word","x","even"\n')
    there = {int(f.parent.name.partition("=")[2]): f.stat().st_size - header for f in Path(tmp_path, "out").glob("file_no=*/*.csv")}
    assert there == want and len(want) > 5


def test_limit_must_be_above_zero(spark):
    with pytest.raises(ValueError):
        restart_plan(spark.range(3), ["id"], 0)
