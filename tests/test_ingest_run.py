"""Ingestion runs: a crash behind any step, reruns, rivals, rejects."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.plans.ingest_run import STEPS, Feed, RunConflict
from millrace.storage import scratch_path

SCHEMA = "id long, author string, at timestamp, seen long, run_ordinal_ string"


def day(n: int) -> datetime:
    return datetime(2024, 1, n)


FIRST = [(1, "a", day(1), 0, ""), (1, "a", day(1), 5, ""), (2, "a", day(3), 0, ""), (3, None, day(2), 0, ""), (4, "b", None, 0, "")]
SECOND = [(5, "a", day(3), 0, ""), (6, "a", day(4), 0, ""), (7, None, day(1), 0, ""), (8, "b", day(1), 0, ""), (9, None, day(5), 0, "")]


def feed(spark) -> Feed:
    return Feed(scratch_path(spark, "feed"), "author", "at", ["id"], [F.desc("seen")])


def landed(f: Feed, spark) -> list[tuple]:
    return sorted((r.id, r.seen, r.run_ordinal) for r in f.rows(spark).collect())


def frames(spark):
    return spark.createDataFrame(FIRST, SCHEMA), spark.createDataFrame(SECOND, SCHEMA)


WANT = [(1, 5, 1), (2, 0, 1), (3, 0, 1), (6, 0, 2), (8, 0, 2), (9, 0, 2)]


def test_two_runs(spark):
    f, (first, second) = feed(spark), frames(spark)
    assert f.rows(spark) is None and f.marks(spark) is None
    assert f.ingest(first, "one")["counts"] == {"read": 5, "fresh": 4, "landed": 3, "rejected": 1}
    assert f.ingest(second, "two")["counts"] == {"read": 5, "fresh": 3, "landed": 3, "rejected": 0}
    assert landed(f, spark) == WANT
    assert {r.author: r.mark for r in f.marks(spark).collect()} == {"a": day(4), None: day(5), "b": day(1)}
    assert [r.id for r in f.rows(spark, "rejects").collect()] == [4]
    assert f.report(spark).filter("step = 'landed'").agg(F.sum("n")).first()[0] == f.rows(spark).count()


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_behind_any_step_and_a_rerun_give_the_rows_of_one_run(spark, step):
    f, (first, second) = feed(spark), frames(spark)

    def die(reached: str) -> None:
        if reached == step:
            raise KeyboardInterrupt(step)

    for batch, run in ((first, "one"), (second, "two")):
        with pytest.raises(KeyboardInterrupt):
            f.ingest(batch, run, die)
        f.ingest(batch, run)
        f.ingest(batch, run)
    assert landed(f, spark) == WANT and len(f.records(spark)) == 2
    f.sweep(spark)
    assert landed(f, spark) == WANT and f.sweep(spark) == []
    assert f.ingest(second, "three")["counts"]["landed"] == 0


def test_of_two_runs_at_once_one_commits(spark):
    f, (first, second) = feed(spark), frames(spark)

    def rival(reached: str) -> None:
        if reached == STEPS[2]:
            f.ingest(second, "rival")

    with pytest.raises(RunConflict):
        f.ingest(first, "slow", rival)
    assert [r["run"] for r in f.records(spark)] == ["rival"]
    f.ingest(first, "slow")
    assert [r["ordinal"] for r in f.records(spark)] == [1, 2]


def test_an_empty_batch_keeps_the_marks(spark):
    f, (first, _) = feed(spark), frames(spark)
    f.ingest(first.limit(0), "none")
    assert f.rows(spark).count() == 0
    f.ingest(first, "one")
    before = sorted(map(str, f.marks(spark).collect()))
    f.ingest(first.limit(0), "none again")
    assert sorted(map(str, f.marks(spark).collect())) == before
