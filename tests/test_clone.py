"""Cloning an environment: the report, and what a failure tells."""

from __future__ import annotations

import pytest

from millrace.plans import clone


@pytest.fixture
def source(spark, tmp_path):
    spark.sql(f"CREATE DATABASE dev_raw LOCATION 'file://{tmp_path}/dev_raw'")
    for name, rows in (("a", 3), ("b", 0), ("c", 5)):
        spark.range(rows).write.saveAsTable(f"dev_raw.{name}")
    yield f"file://{tmp_path}/copies"
    for db in ("dev_raw", "kim_raw"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_report(spark, source):
    rows = clone.clone_schema(spark, "dev", "kim", location=source).orderBy("table").collect()
    assert [(r.table, r.rows_source, r.rows_target, r.ok) for r in rows] == [("a", 3, 3, True), ("b", 0, 0, True), ("c", 5, 5, True)]


def test_failure_names_all_copied(spark, source):
    spark.sql("CREATE VIEW dev_raw.bad AS SELECT raise_error('no') AS x FROM range(1)")
    with pytest.raises(clone.CloneError) as failed:
        clone.clone_schema(spark, "dev", "kim", location=source)
    there = {f"kim_raw.`{t.name}`" for t in spark.catalog.listTables("kim_raw")}
    assert set(failed.value.done) <= there
    assert "dev_raw.`bad`" in str(failed.value)
    assert "kim_raw.`bad`" not in failed.value.done


def test_no_environment_is_a_target(spark):
    for src, user in (("dev", "prod"), ("dev", "Dev"), ("qa", "QA")):
        with pytest.raises(ValueError, match="environment"):
            clone.clone_schema(spark, src, user)
