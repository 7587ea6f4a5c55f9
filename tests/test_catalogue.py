"""Every registered core query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from millrace.catalogue import ENTRIES
from tools.compare import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        path = Path(f"{SF_DIR}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path / '*.parquet' if path.is_dir() else path}'")
    return con


def test_all_have_sql():
    assert [name for name, entry in ENTRIES.items() if not entry.sql] == []


@pytest.mark.parametrize("name", list(ENTRIES))
def test_rows_match_sql(spark, duck, name):
    got = ENTRIES[name].run(spark, SF_DIR).toPandas()
    want = duck.execute(ENTRIES[name].sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_privilege_drift_has_both_sides(duck):
    assert {status for (status,) in duck.execute(f"SELECT DISTINCT status FROM ({ENTRIES['privilege_drift'].sql})").fetchall()} == {"extra", "missing"}
