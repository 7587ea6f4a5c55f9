"""A log of grants and revokes made from all orders: one script an order, on the
table of its customer, its schema, or the role of its customer's group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import query, table
from millrace.plans import entitlement_audit as ent
from millrace.plans.entitlements import split_statements


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments and quoted names hold separators, which end no statement."""
    c = F.col("o_custkey")
    role, up = F.format_string("N%d_FR", c % 25), F.format_string("R%d_FR", c % 5)
    schema = F.format_string("DB.S%d", c % 97)
    name = F.concat(F.lit('"'), schema, F.format_string('.T%d;--"', c))
    form = F.col("o_orderkey") % 11
    made = (
        F.when(form <= 3, F.concat(F.lit("grant select on table "), name, F.lit("\n to role "), role))
        .when(form == 4, F.concat(F.lit("GRANT SELECT, INSERT ON ALL TABLES IN SCHEMA "), schema, F.lit(" TO ROLE "), role))
        .when(form == 5, F.concat(F.lit("REVOKE SELECT ON TABLE "), name, F.lit(" FROM ROLE "), role))
        .when(form == 6, F.concat(F.lit("revoke all privileges on table "), name, F.lit(" from role "), role))
        .when(form == 7, F.concat(F.lit("REVOKE SELECT ON ALL TABLES IN SCHEMA "), schema, F.lit(" FROM ROLE "), role))
        .when((form == 8) & (F.floor(F.col("o_orderkey") / 11) % 2 == 1), F.concat(F.lit("GRANT ROLE "), up, F.lit(" TO ROLE TOP_FR")))
        .when(form == 8, F.concat(F.lit("GRANT ROLE "), role, F.lit(" TO ROLE "), up))
        .when(form == 9, F.concat(F.lit("REVOKE ROLE "), role, F.lit(" FROM ROLE "), up))
        .otherwise(F.lit("GRANT BROKEN"))
    )
    text = F.concat(F.lit("/* it's; one */ USE ROLE A;\n"), made, F.lit(" -- done; really\n;;"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", text.alias("script"))


FORMS_SQL = """base AS (SELECT o_orderdate AS d, o_orderkey AS k, o_orderkey % 11 AS h, (o_orderkey // 11) % 2 = 1 AS odd, 'N' || (o_custkey % 25) || '_FR' AS role,
  'R' || (o_custkey % 5) || '_FR' AS up, 'DB.S' || (o_custkey % 97) AS s, 'DB.S' || (o_custkey % 97) || '.T' || o_custkey || ';--' AS t FROM orders)"""


@query(
    f"""WITH {FORMS_SQL} SELECT k AS o_orderkey, 0 AS stmt_id, 'USE ROLE A' AS stmt_text FROM base
    UNION ALL SELECT k, 1, CASE WHEN h <= 3 THEN 'grant select on table "' || t || '" to role ' || role WHEN h = 4 THEN 'GRANT SELECT, INSERT ON ALL TABLES IN SCHEMA ' || s || ' TO ROLE ' || role
      WHEN h = 5 THEN 'REVOKE SELECT ON TABLE "' || t || '" FROM ROLE ' || role WHEN h = 6 THEN 'revoke all privileges on table "' || t || '" from role ' || role
      WHEN h = 7 THEN 'REVOKE SELECT ON ALL TABLES IN SCHEMA ' || s || ' FROM ROLE ' || role WHEN h = 8 AND odd THEN 'GRANT ROLE ' || up || ' TO ROLE TOP_FR'
      WHEN h = 8 THEN 'GRANT ROLE ' || role || ' TO ROLE ' || up WHEN h = 9 THEN 'REVOKE ROLE ' || role || ' FROM ROLE ' || up ELSE 'GRANT BROKEN' END FROM base"""
)
def statement_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_statements(scripts(spark, sf_dir), "script", "o_orderkey")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    script = scripts(spark, sf_dir).withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return ent.parse_events(split_statements(script, "script", "at")).select("*", "at.o_orderdate", "at.o_orderkey")


ORDER = ["o_orderdate", "o_orderkey", "stmt_id"]

STATE_SQL = f"""{FORMS_SQL}, ev AS (
  SELECT d, k, CASE WHEN h <= 3 THEN 'GRANT' ELSE 'REVOKE' END AS action, role AS grantee, CASE h WHEN 6 THEN 'ALL' ELSE 'SELECT' END AS privilege, 'ONE' AS scope,
    'TABLE' AS object_kind, t AS object_name, CAST(NULL AS VARCHAR) AS container, s AS of FROM base WHERE h <= 3 OR h IN (5, 6)
  UNION ALL SELECT d, k, CASE h WHEN 4 THEN 'GRANT' ELSE 'REVOKE' END, role, p, 'ALL', 'TABLE', s, 'SCHEMA', s FROM base, (VALUES ('SELECT'), ('INSERT')) v(p) WHERE h = 4 OR (h = 7 AND p = 'SELECT')
  UNION ALL SELECT d, k, CASE h WHEN 8 THEN 'GRANT' ELSE 'REVOKE' END, CASE WHEN h = 8 AND odd THEN 'TOP_FR' ELSE up END, 'ROLE', 'ONE', 'ROLE', CASE WHEN h = 8 AND odd THEN up ELSE role END, NULL, NULL FROM base WHERE h IN (8, 9)),
made AS (SELECT grantee, privilege, scope, object_kind, object_name, container, of, count(*) AS times, max((d, k)) AS granted FROM ev WHERE action = 'GRANT' GROUP BY ALL),
state AS (SELECT m.grantee, m.privilege, m.scope, m.object_kind, m.object_name, m.container, m.times, bool_and(r.k IS NULL OR m.granted > (r.d, r.k)) AS active
  FROM made m LEFT JOIN ev r ON r.action = 'REVOKE' AND r.grantee = m.grantee AND r.object_kind = m.object_kind AND r.privilege IN (m.privilege, 'ALL')
    AND ((r.scope = m.scope AND r.object_name = m.object_name) OR (r.scope = 'ALL' AND m.scope = 'ONE' AND r.object_name = m.of)) GROUP BY ALL)"""

@query(f"WITH {STATE_SQL} SELECT grantee, privilege, scope, object_kind, object_name, container, times, active FROM state")
def grant_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every grant of the log."""
    return ent.replay(events(spark, sf_dir), ORDER).drop("grantee_kind", "granted_at", "revoked_at")


@query(
    f"""WITH RECURSIVE {STATE_SQL},
    held AS (SELECT grantee, privilege, scope, object_kind, object_name, container FROM state WHERE active AND object_kind <> 'ROLE'),
    want AS (SELECT 'N' || (c_custkey % 25) || '_FR' AS grantee, 'SELECT' AS privilege, 'ONE' AS scope, 'TABLE' AS object_kind, 'DB.S' || (c_custkey % 97) || '.T' || c_custkey || ';--' AS object_name,
      CAST(NULL AS VARCHAR) AS container FROM customer WHERE c_acctbal > 0),
    edges AS (SELECT object_name AS child, grantee AS parent FROM state WHERE active AND object_kind = 'ROLE'),
    ups AS (SELECT child, parent AS ancestor FROM edges UNION SELECT u.child, e.parent FROM ups u JOIN edges e ON e.child = u.ancestor),
    reach AS (SELECT grantee AS role, privilege, scope, object_kind, object_name FROM held UNION SELECT ancestor, privilege, scope, object_kind, object_name FROM held JOIN ups ON child = grantee)
    SELECT 'missing' AS finding, *, 1 AS n FROM (SELECT * FROM want EXCEPT SELECT * FROM held)
    UNION ALL SELECT 'extra', *, 1 FROM (SELECT * FROM held EXCEPT SELECT * FROM want)
    UNION ALL SELECT 'repeated', grantee, privilege, scope, object_kind, object_name, container, times FROM state WHERE times > 1 AND object_kind <> 'ROLE'
    UNION ALL SELECT 'idle revoke', grantee, privilege, scope, object_kind, object_name, container, count(*) FROM ev r WHERE action = 'REVOKE' AND scope <> 'ALL' AND privilege <> 'ALL'
      AND NOT EXISTS (SELECT 1 FROM made m WHERE m.grantee = r.grantee AND m.privilege = r.privilege AND m.scope = r.scope AND m.object_name = r.object_name) GROUP BY ALL
    UNION ALL SELECT 'effective', role, NULL, NULL, NULL, NULL, NULL, count(*) FROM reach GROUP BY role
    UNION ALL SELECT 'unparsed', NULL, NULL, NULL, NULL, NULL, NULL, count(*) FROM base WHERE h = 10"""
)
def entitlement_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log against what customers with money are owed: reading of their own table."""
    c = F.col("c_custkey")
    owed = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.format_string("N%d_FR", c % 25).alias("grantee"), F.lit("SELECT").alias("privilege"), F.lit("ONE").alias("scope"), F.lit("TABLE").alias("object_kind"),
        F.format_string("DB.S%d.T%d;--", c % 97, c).alias("object_name"), F.lit(None).cast("string").alias("container"),
    )
    return ent.audit(events(spark, sf_dir), ORDER, owed)
