"""Entitlements made from given tables: a nation is a role held by its region's
role, a customer a user of its nation's role, a part an object, and a supplier's
number decides the form of its grant statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import query, table
from millrace.operators.closure import role_closure as closure
from millrace.plans import entitlements as ent


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    role = F.concat(F.lit("N"), F.col("s_nationkey"), F.lit("_FR"))
    thing = F.concat(F.lit("DB.S"), s % 5)
    form = s % 6
    made = (
        F.when(form == 0, F.concat(F.lit("grant select, insert on all tables in schema "), thing, F.lit(" to role "), role))
        .when(form == 1, F.concat(F.lit("GRANT USAGE ON SCHEMA "), thing, F.lit(" TO ROLE "), role, F.lit(";")))
        .when(form == 2, F.concat(F.lit("GRANT CREATE DATABASE ON ACCOUNT TO ROLE "), role))
        .when(form == 3, F.concat(F.lit("GRANT SELECT ON FUTURE VIEWS IN DATABASE "), thing, F.lit(" TO ROLE "), role))
        .when(form == 4, F.concat(F.lit("GRANT IMPORTED PRIVILEGES "), thing))
        .otherwise(F.concat(F.lit("REVOKE SELECT ON TABLE "), thing, F.lit(" FROM ROLE "), role))
    )
    return table(spark, sf_dir, "supplier").select(s.alias("stmt_id"), made.alias("stmt_text"))


PARSED_SQL = """
SELECT s_suppkey AS stmt_id, 'SELECT' AS privilege, 'ALL' AS scope, 'TABLE' AS object_kind, 'DB.S' || (s_suppkey % 5) AS object_name,
       'SCHEMA' AS container, 'N' || s_nationkey || '_FR' AS grantee, 'parsed' AS status FROM supplier WHERE s_suppkey % 6 = 0
UNION ALL SELECT s_suppkey, 'INSERT', 'ALL', 'TABLE', 'DB.S' || (s_suppkey % 5), 'SCHEMA', 'N' || s_nationkey || '_FR', 'parsed' FROM supplier WHERE s_suppkey % 6 = 0
UNION ALL SELECT s_suppkey, 'USAGE', 'ONE', 'SCHEMA', 'DB.S' || (s_suppkey % 5), NULL, 'N' || s_nationkey || '_FR', 'parsed' FROM supplier WHERE s_suppkey % 6 = 1
UNION ALL SELECT s_suppkey, 'CREATE DATABASE', 'ONE', 'ACCOUNT', NULL, NULL, 'N' || s_nationkey || '_FR', 'parsed' FROM supplier WHERE s_suppkey % 6 = 2
UNION ALL SELECT s_suppkey, 'SELECT', 'FUTURE', 'VIEW', 'DB.S' || (s_suppkey % 5), 'DATABASE', 'N' || s_nationkey || '_FR', 'parsed' FROM supplier WHERE s_suppkey % 6 = 3
UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL, NULL, NULL, 'unparsed' FROM supplier WHERE s_suppkey % 6 = 4
"""


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.parse_grants(statements(spark, sf_dir))


@query(PARSED_SQL)
def grant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).select("stmt_id", "privilege", "scope", "object_kind", "object_name", "container", "grantee", "status")


EDGES_SQL = """(SELECT 'N' || n_nationkey || '_FR' AS child, 'R' || n_regionkey || '_FR' AS parent FROM nation
  UNION SELECT 'R' || r_regionkey || '_FR', 'TOP_FR' FROM region UNION SELECT 'TOP_FR', 'R0_FR')"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations below regions below the top, and a cycle: the top below region 0."""
    n = table(spark, sf_dir, "nation").select(F.format_string("N%d_FR", "n_nationkey").alias("child"), F.format_string("R%d_FR", "n_regionkey").alias("parent"))
    r = table(spark, sf_dir, "region").select(F.format_string("R%d_FR", "r_regionkey").alias("child"), F.lit("TOP_FR").alias("parent"))
    back = table(spark, sf_dir, "region").filter("r_regionkey = 0").select(F.lit("TOP_FR").alias("child"), F.lit("R0_FR").alias("parent"))
    return n.unionByName(r).unionByName(back)


CLOSURE_SQL = f"""WITH RECURSIVE e AS {EDGES_SQL}, up AS (SELECT child, parent AS ancestor, 1 AS depth FROM e
  UNION SELECT up.child, e.parent, depth + 1 FROM up JOIN e ON e.child = up.ancestor WHERE depth < 6)"""


@query(CLOSURE_SQL + " SELECT child, ancestor, min(depth) AS depth FROM up GROUP BY ALL")
def role_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closure(edges(spark, sf_dir))


EFFECTIVE_SQL = (
    CLOSURE_SQL
    + f""", direct AS (SELECT DISTINCT grantee AS role_name, privilege, scope, object_kind, object_name FROM ({PARSED_SQL}) WHERE status = 'parsed'),
  effective AS (SELECT * FROM direct UNION SELECT ancestor, privilege, scope, object_kind, object_name FROM direct JOIN up ON child = role_name)"""
)


@query(EFFECTIVE_SQL + " SELECT * FROM effective")
def effective_privileges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.effective_privileges(parsed(spark, sf_dir), closure(edges(spark, sf_dir)))


@query(
    EFFECTIVE_SQL
    + """ SELECT DISTINCT c_name AS user_name, privilege, scope, object_kind, object_name FROM customer
        JOIN effective ON role_name = (CASE WHEN c_nationkey % 2 = 0 THEN 'N' || c_nationkey ELSE 'R' || (c_nationkey % 5) END) || '_FR'"""
)
def user_privileges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_nationkey")
    role = F.when(k % 2 == 0, F.format_string("N%d_FR", k)).otherwise(F.format_string("R%d_FR", k % 5))
    users = table(spark, sf_dir, "customer").select(F.col("c_name").alias("user_name"), role.alias("role_name"))
    return ent.user_privileges(ent.effective_privileges(parsed(spark, sf_dir), closure(edges(spark, sf_dir))), users)


@query(
    """SELECT k AS nation, CASE WHEN a THEN 'extra' ELSE 'missing' END AS status FROM (
         SELECT k, bool_or(side) AS a, bool_or(NOT side) AS e FROM (
           SELECT c_nationkey AS k, false AS side FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey, true FROM supplier WHERE s_acctbal > 0) GROUP BY k)
       WHERE a <> e"""
)
def entitlement_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = table(spark, sf_dir, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    have = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_nationkey").alias("nation"))
    return ent.drift(want, have, ["nation"])


@query(
    EFFECTIVE_SQL
    + """, held AS (SELECT * FROM effective WHERE scope <> 'FUTURE')
       SELECT *, 'extra' AS status FROM (SELECT * FROM held EXCEPT SELECT * FROM direct)
       UNION ALL SELECT *, 'missing' FROM (SELECT * FROM direct EXCEPT SELECT * FROM held)"""
)
def privilege_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the statements grant a role, against what it holds on objects that exist:
    inherited privileges are extra, those on future objects are missing."""
    grants = parsed(spark, sf_dir)
    held = ent.effective_privileges(grants, closure(edges(spark, sf_dir))).filter("scope <> 'FUTURE'")
    direct = grants.filter("status = 'parsed'").withColumnRenamed("grantee", "role_name")
    return ent.drift(direct, held, ["role_name", "privilege", "scope", "object_kind", "object_name"])


@query(f"SELECT privilege, scope, object_kind, object_name, grantee, count(*) AS n FROM ({PARSED_SQL}) WHERE status = 'parsed' GROUP BY ALL HAVING count(*) > 1")
def statement_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.statement_duplicates(parsed(spark, sf_dir).filter("status = 'parsed'"))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates from parts (brand as object kind, size as access type) on nations as targets."""
    kind = F.when(F.col("p_size") % 2 == 0, "READ").otherwise("FULL")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("command_ordinal"),
        F.concat(F.lit("GRANT SELECT ON ALL "), F.upper(F.replace("p_brand", F.lit("#"), F.lit("_"))), F.lit("S IN SCHEMA <schema-name> TO ROLE <access-role-name>")).alias("command_text"),
        kind.alias("access_type"), F.lit(False).alias("first_time_setup_ind"),
    )
    targets = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") % 2 == 0, "READ").otherwise("FULL").alias("access_type"),
        F.col("n_name").alias("schema_name"), F.format_string("N%d_AR", "n_nationkey").alias("role_name"),
    )
    return ent.expand_templates(ent.load_templates(rows), targets)


COMMANDS_SQL = """SELECT p_partkey AS command_ordinal, n_name AS schema_name, '{verb} SELECT ON ALL ' || upper(replace(p_brand, '#', '_')) || 'S IN SCHEMA ' || n_name || ' {to} ROLE N' || n_nationkey || '_AR' AS command
  FROM part JOIN nation ON (p_size % 2) = (n_nationkey % 2)"""


@query(COMMANDS_SQL.format(verb="GRANT", to="TO"))
def template_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commands(spark, sf_dir).select(F.col("command_ordinal").cast("long").alias("command_ordinal"), "schema_name", "command")


@query(COMMANDS_SQL.format(verb="REVOKE", to="FROM"))
def derived_revokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.derive_revokes(commands(spark, sf_dir)).select(F.col("command_ordinal").cast("long").alias("command_ordinal"), "schema_name", "command")


CHAIN_SQL = COMMANDS_SQL.replace("SELECT p_partkey", "SELECT {place} AS place, CASE WHEN p_size % 2 = 0 THEN {read} ELSE {full} END AS rank, p_partkey", 1)


@query(
    f"""SELECT row_number() OVER (ORDER BY place, rank, schema_name, command_ordinal) AS step, CASE place WHEN 0 THEN 'revoke' ELSE 'grant' END AS phase, command
        FROM ({CHAIN_SQL.format(place=0, read=1, full=2, verb="REVOKE", to="FROM")} UNION ALL {CHAIN_SQL.format(place=1, read=2, full=1, verb="GRANT", to="TO")})"""
)
def command_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All revokes by access type and ordinal, then all grants, as one numbered run."""
    grants = commands(spark, sf_dir)
    phases = [("revoke", ent.derive_revokes(grants), ["READ", "FULL"]), ("grant", grants, ["FULL", "READ"])]
    return ent.command_chain(phases, ["schema_name", "command_ordinal"]).select("step", "phase", "command")


@query("SELECT p_brand AS object_kind, p_type AS access_type, count(*) AS n FROM part GROUP BY ALL")
def privilege_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.privilege_counts(table(spark, sf_dir, "part").select(F.col("p_brand").alias("object_kind"), F.col("p_type").alias("access_type")))


@query(
    """SELECT c_nationkey AS nation, max(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey % 4 END) AS "BUILDING",
       max(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey % 4 END) AS "MACHINERY" FROM customer GROUP BY 1"""
)
def access_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey"))
    return ent.access_matrix(c, ["nation"], "c_mktsegment", ["BUILDING", "MACHINERY"], F.col("c_custkey") % 4)


@query(
    """SELECT p_partkey, object_name, object_kind FROM (
         SELECT p_partkey, upper(replace(p_name, ' ', '_')) || CASE p_partkey % 3 WHEN 0 THEN '_VW' WHEN 1 THEN '_STG' ELSE '' END AS object_name,
                CASE p_size % 3 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'STAGE' ELSE 'PERMANENT TABLE' END AS object_kind FROM part)
       WHERE (object_kind = 'VIEW' AND NOT object_name LIKE '%\\_VW' ESCAPE '\\') OR (object_kind = 'STAGE' AND NOT object_name LIKE '%\\_STG' ESCAPE '\\')
          OR (object_kind = 'PERMANENT TABLE' AND (object_name LIKE '%\\_VW' ESCAPE '\\' OR object_name LIKE '%\\_STG' ESCAPE '\\'))"""
)
def naming_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, z = F.col("p_partkey") % 3, F.col("p_size") % 3
    suffix = F.when(k == 0, "_VW").when(k == 1, "_STG").otherwise("")
    named = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), suffix).alias("object_name"),
        F.when(z == 0, "VIEW").when(z == 1, "STAGE").otherwise("PERMANENT TABLE").alias("object_kind"),
    )
    return ent.naming_violations(named)


@query(
    """WITH made AS (SELECT DISTINCT 'A_' || c_custkey || '_R' AS role_name, c_custkey AS k FROM customer),
            gone AS (SELECT DISTINCT CASE WHEN s_suppkey % 2 = 0 THEN 'A_' || s_suppkey || '_R' ELSE 'R_A_' || s_suppkey END AS role_name, s_suppkey AS k FROM supplier)
       SELECT role_name, 'created only' AS side, k IN (SELECT k FROM gone WHERE k % 2 = 1) AS matches_reordered FROM made WHERE role_name NOT IN (SELECT role_name FROM gone)
       UNION ALL SELECT role_name, 'dropped only', k IN (SELECT k FROM made) FROM gone WHERE role_name NOT IN (SELECT role_name FROM made)"""
)
def teardown_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "customer").select(F.concat(F.lit("A_"), "c_custkey", F.lit("_R")).alias("role_name"))
    s = F.col("s_suppkey")
    gone = table(spark, sf_dir, "supplier").select(F.when(s % 2 == 0, F.concat(F.lit("A_"), s, F.lit("_R"))).otherwise(F.concat(F.lit("R_A_"), s)).alias("role_name"))
    return ent.teardown_gaps(made, gone)
