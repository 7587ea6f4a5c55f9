"""What a log of grants and revokes leaves in force, and an audit of it.

The log is replayed as one fold: the state of a grant is its last event, so no
task ever walks a grantee's or an object's whole history.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.closure import role_closure
from millrace.plans.entitlements import drift, effective_privileges, parse_grants, role_edges
from millrace.storage import land

OBJECT = ["scope", "object_kind", "object_name", "container"]
GRANT_KEY = ["grantee_kind", "grantee", "privilege", *OBJECT]
EVERY_PRIVILEGE = ("ALL", "ALL PRIVILEGES")


def parse_events(statements: DataFrame, text: str = "stmt_text") -> DataFrame:
    """The columns of ``parse_grants`` for GRANT and REVOKE statements, and ``action``.

    ``REVOKE GRANT OPTION FOR`` takes no privilege away: its status is
    ``unparsed``, like that of each form that isn't known.
    """
    raw = F.col(text)
    revoke = raw.rlike(r"(?i)^\s*REVOKE\b")
    as_grant = F.regexp_replace(F.regexp_replace(raw, r"(?i)^\s*REVOKE\b", "GRANT"), r"(?is)^(.*)\bFROM(\s+(?:ROLE|USER)\b)", "$1TO$2")
    option = raw.rlike(r"(?i)^\s*REVOKE\s+GRANT\s+OPTION\b")
    read = F.when(option, F.lit("GRANT")).when(revoke, as_grant).otherwise(raw)
    told = statements.withColumn("action", F.when(revoke, "REVOKE").otherwise("GRANT"))
    # a generated column isn't copied into each of the many expressions that use it
    return parse_grants(told.withColumn("__read", F.explode(F.array(read))), "__read").drop("__read")


def _covers() -> Column:
    """Each (privilege, scope, kind, name, container) whose revoke ends this grant.

    A grant ends with a revoke of the same thing, or of every privilege on it. One
    object's grant ends too with the bulk revoke on all objects of its kind in
    its schema (the name without its last part) or database (the first part).
    """
    name, parts = F.col("object_name"), F.split("object_name", r"\.")
    itself = F.struct(*OBJECT)

    def bulk(container: str, of: Column) -> Column:
        return F.struct(F.lit("ALL").alias("scope"), F.col("object_kind"), of.alias("object_name"), F.lit(container).alias("container"))

    single = (F.col("scope") == "ONE") & ~F.col("object_kind").isin("ROLE", "ACCOUNT", "SCHEMA", "DATABASE")
    places = F.array_compact(
        F.array(
            itself,
            F.when(single & (F.size(parts) == 3), bulk("SCHEMA", F.substring_index(name, ".", 2))),
            F.when(single & (F.size(parts) == 3), bulk("DATABASE", parts[0])),
        )
    )
    whole = F.col("object_kind") == "ROLE"
    privileges = F.when(whole, F.array("privilege")).otherwise(F.array_distinct(F.array("privilege", F.lit(EVERY_PRIVILEGE[0]))))
    return F.flatten(F.transform(privileges, lambda p: F.transform(places, lambda at: F.struct(p.alias("privilege"), at.alias("at")))))


def replay(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per grant that the log ever made: its columns, ``times`` granted,
    ``granted_at`` and ``revoked_at`` (structs of ``order``), and ``active``.

    The grant is active unless a revoke that covers it comes after its last grant
    (or at the same place of ``order``). A revoke of one object leaves a bulk grant in force, because
    the log doesn't tell which objects a schema held. Unparsed events don't count.
    """
    every = F.when(F.upper("privilege").isin(*EVERY_PRIVILEGE), EVERY_PRIVILEGE[0]).otherwise(F.col("privilege"))
    told = events.filter(F.col("status") == "parsed").withColumns({"privilege": every, "__at": F.struct(*order)})
    grants = told.filter("action = 'GRANT'").groupBy(*GRANT_KEY).agg(
        F.count(F.lit(1)).alias("times"), F.max("__at").alias("granted_at")
    )
    ends = told.filter("action = 'REVOKE'").groupBy(*GRANT_KEY).agg(F.max("__at").alias("__end"))
    # null names and containers meet as well: the join is on one struct, compared null-safe
    end_key = ends.select("grantee_kind", "grantee", F.struct("privilege", F.struct(*OBJECT).alias("at")).alias("__cover"), "__end")
    asked = grants.withColumn("__cover", F.explode(_covers()))
    same = (
        (asked["grantee_kind"] == end_key["grantee_kind"])
        & (asked["grantee"] == end_key["grantee"])
        & asked["__cover"].eqNullSafe(end_key["__cover"])
    )
    met = asked.join(end_key, same, "left").select(*[asked[c] for c in (*GRANT_KEY, "times", "granted_at")], "__end")
    state = met.groupBy(*GRANT_KEY).agg(
        F.max("times").alias("times"), F.max("granted_at").alias("granted_at"), F.max("__end").alias("revoked_at")
    )
    return state.withColumn("active", F.col("revoked_at").isNull() | (F.col("granted_at") > F.col("revoked_at")))


FINDING = ["grantee", "privilege", *OBJECT]


def audit(events: DataFrame, order: Sequence[str], expected: DataFrame) -> DataFrame:
    """finding, grantee, privilege, scope, object_kind, object_name, container, n.

    ``missing`` and ``extra``: grants in force against ``expected`` (columns
    grantee, privilege and the four of the object); ``repeated``: granted n > 1
    times; ``idle revoke``: n revokes of what was never granted as such;
    ``effective``: n privileges that a role holds, its roles' included;
    ``unparsed``: n statements. Role grants count for ``effective`` only.
    """
    log = land(events, "grant_log")
    state = land(replay(log, order), "grant_state")
    held = state.filter("active")
    things = held.filter("object_kind <> 'ROLE'")
    one = F.lit(1).cast("bigint")

    def found(rows: DataFrame, finding: str | Column, n: Column) -> DataFrame:
        name = F.lit(finding) if isinstance(finding, str) else finding
        return rows.select(
            name.alias("finding"), *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in FINDING], n.alias("n")
        )

    apart = drift(expected.select(*FINDING), things.select(*FINDING), FINDING)
    revoked = log.filter("status = 'parsed' AND action = 'REVOKE'").groupBy("grantee_kind", *FINDING).agg(F.count(F.lit(1)).alias("n"))
    ever = state.select("grantee_kind", *FINDING).withColumn("__made", F.lit(True))
    # one grouping instead of a join: null containers compare equal
    idle = (
        revoked.withColumn("__made", F.lit(False)).unionByName(ever.withColumn("n", F.lit(None).cast("bigint")))
        .groupBy("grantee_kind", *FINDING)
        .agg(F.max("n").alias("n"), F.bool_or("__made").alias("__made"))
        .filter("NOT __made AND NOT (privilege IN ('ALL', 'ALL PRIVILEGES') OR scope = 'ALL')")
    )
    roles = held.withColumn("status", F.lit("parsed"))
    reach = effective_privileges(roles, role_closure(role_edges(roles)))
    counts = reach.groupBy(F.col("role_name").alias("grantee")).agg(F.count(F.lit(1)).alias("n"))
    unread = log.filter("status = 'unparsed'").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    parts = [
        found(apart, F.col("status"), one),
        found(state.filter("times > 1 AND object_kind <> 'ROLE'"), "repeated", F.col("times")),
        found(idle, "idle revoke", F.col("n")),
        found(counts, "effective", F.col("n")),
        found(unread, "unparsed", F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)
