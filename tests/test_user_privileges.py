"""Privileges of users: once for all users with the same roles."""

from __future__ import annotations

import re

from millrace.plans import entitlements as ent

EFFECTIVE = [("A", "SELECT", "ONE", "TABLE", "T"), ("A", "INSERT", "ONE", "TABLE", None), ("B", "SELECT", "ONE", "TABLE", "T"), ("B", "USAGE", "ONE", "SCHEMA", "S"), ("C", "OWN", "ONE", "TABLE", "T")]
USERS = [("u1", "A"), ("u1", "A"), ("u2", "A"), ("u2", "B"), ("u3", "B"), ("u3", "A"), ("u4", "Z"), ("u5", None), ("u6", "Z"), ("u6", "C"), (None, "C"), (None, "C")]


def frames(spark):
    effective = spark.createDataFrame(EFFECTIVE, "role_name string, privilege string, scope string, object_kind string, object_name string")
    return effective, spark.createDataFrame(USERS, "user_name string, role_name string")


def test_rows(spark):
    got = ent.user_privileges(*frames(spark))
    assert got.columns == ["user_name", "privilege", "scope", "object_kind", "object_name"]
    want = {(u, *e[1:]) for u, r in USERS for e in EFFECTIVE if r == e[0]}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_no_aggregate_over_users_and_privileges(spark):
    """Such an aggregate holds all privileges of all users of a task."""
    plan = ent.user_privileges(*frames(spark))._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan)
    assert keys and not [k for k in keys if "user_name" in k and "privilege" in k]
