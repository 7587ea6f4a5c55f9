"""Splitting scripts, and replaying grants and revokes."""

from __future__ import annotations

import random

from millrace.plans.entitlement_audit import parse_events, replay
from millrace.plans.entitlements import split_statements


def split(spark, *scripts):
    df = spark.createDataFrame(list(enumerate(scripts)), "id int, text string")
    return [(r.id, r.stmt_text) for r in split_statements(df, "text", "id").orderBy("id", "stmt_id").collect()]


def test_quotes_and_comments_keep_their_separators(spark):
    assert split(spark, "a 'x;--y''/*z*/' b; c /* ; ' */ d -- ; \"\n;e \"q;  --\" f;$$ g; -- h\n $$") == [
        (0, "a 'x;--y''/*z*/' b"), (0, "c d"), (0, 'e "q;  --" f'), (0, "$$ g; -- h\n $$"),
    ]


def test_split_edges(spark):
    assert split(spark, None, "", " ;; -- only\n; /* no end ; x", "a - b / c $ d", "a/**/b;'no end; c") == [(3, "a - b / c $ d"), (4, "a b"), (4, "'no end; c")]


def test_long_statement(spark):
    text = "a 'b' -- c\n" * 200_000
    assert split(spark, text + ";" + text) == [(0, " ".join(["a 'b'"] * 200_000))] * 2


def states(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "at int, stmt_text string")
    return {(r.grantee, r.privilege, r.scope, r.object_name): r.active for r in replay(parse_events(df), ["at"]).collect()}


def test_revokes_that_cover(spark):
    on, bulk = "ON TABLE D.S.T", "ON ALL TABLES IN SCHEMA D.S"
    assert states(spark, f"GRANT SELECT, INSERT {on} TO ROLE A", f"REVOKE ALL PRIVILEGES {on} FROM ROLE A", f"GRANT SELECT {on} TO ROLE A") == {
        ("A", "SELECT", "ONE", "D.S.T"): True, ("A", "INSERT", "ONE", "D.S.T"): False,
    }
    for end in (bulk, "ON ALL TABLES IN DATABASE D"):
        got = states(spark, f"GRANT SELECT {on} TO ROLE A", f"GRANT SELECT {on} TO ROLE B", "GRANT SELECT ON VIEW D.S.T2 TO ROLE A", f"REVOKE SELECT {end} FROM ROLE A")
        assert got == {("A", "SELECT", "ONE", "D.S.T"): False, ("B", "SELECT", "ONE", "D.S.T"): True, ("A", "SELECT", "ONE", "D.S.T2"): True}
    kept = states(spark, f"GRANT SELECT {bulk} TO ROLE A", f"REVOKE SELECT {on} FROM ROLE A", f"REVOKE GRANT OPTION FOR SELECT {bulk} FROM ROLE A")
    assert kept == {("A", "SELECT", "ALL", "D.S"): True}
    account = ("GRANT CREATE ROLE ON ACCOUNT TO ROLE A", "REVOKE CREATE ROLE ON ACCOUNT FROM ROLE A")
    assert states(spark, *account) == {("A", "CREATE ROLE", "ONE", None): False}
    assert states(spark, "GRANT ROLE A TO USER U", "REVOKE ROLE A FROM ROLE U") == {("U", "ROLE", "ONE", "A"): True}


def test_replay_equals_a_walk(spark):
    draw = random.Random(5)
    log, held = [], {}
    for _ in range(400):
        role, priv, table = draw.choice("AB"), draw.choice(["SELECT", "INSERT"]), f"D.S{draw.randrange(2)}.T{draw.randrange(3)}"
        schema = table[:4]
        kind = draw.randrange(5)
        if kind < 2:
            log.append(f"GRANT {priv} ON TABLE {table} TO ROLE {role}")
            held[role, priv, "ONE", table] = True
        elif kind == 2:
            log.append(f"GRANT {priv} ON ALL TABLES IN SCHEMA {schema} TO ROLE {role}")
            held[role, priv, "ALL", schema] = True
        elif kind == 3:
            log.append(f"REVOKE {priv} ON ALL TABLES IN SCHEMA {schema} FROM ROLE {role}")
            held = {k: v and not (k[:2] == (role, priv) and k[3].startswith(schema)) for k, v in held.items()}
        else:
            log.append(f"REVOKE ALL ON TABLE {table} FROM ROLE {role}")
            held = {k: v and not (k[0] == role and k[3] == table) for k, v in held.items()}
        if draw.random() < 0.05:
            log.append(None)
    assert states(spark, *log) == held
