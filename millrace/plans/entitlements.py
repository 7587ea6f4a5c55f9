"""Entitlement queries over privilege templates and a log of grant statements."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import fill_placeholders
from millrace.operators.keys import duplicates
from millrace.operators.windows import dense_sequence
from millrace.storage import land

# Suffix of an object name per kind; a permanent table has none.
OBJECT_SUFFIXES = {
    "TRANSIENT TABLE": "TRN",
    "TEMPORARY TABLE": "TMP",
    "VIEW": "VW",
    "MATERIALIZED VIEW": "MVW",
    "SEQUENCE": "SQN",
    "FILE FORMAT": "FFM",
    "STAGE": "STG",
    "STREAM": "STM",
    "STORED PROCEDURE": "STP",
    "USER DEFINED FUNCTION": "UDF",
    "TASK": "TSK",
}
NAME_RULES = {
    "DATABASE": r"^[A-Z0-9]+_EDW_DB$",
    "SCHEMA ACCESS ROLE": r"^[A-Z0-9]+(_[A-Z0-9]+)+_(R|RW|FULL)_AR$",
    "WAREHOUSE ACCESS ROLE": r"^[A-Z0-9]+(_[A-Z0-9]+)*_(U|UW|O)_AR$",
    "FUNCTIONAL ROLE": r"^[A-Z0-9]+(_[A-Z0-9]+)*_FR$",
}
USERS_AT_ONCE = 50_000  # user rows of a task
FEW_TASKS = 8
READ_PRIVILEGE_NAMES = ("SELECT", "USAGE", "READ", "MONITOR")


def load_templates(file_rows: DataFrame, user: Column | None = None, now: Column | None = None) -> DataFrame:
    """Five-column template rows to the nine-column table; ids hash the text."""
    at = now if now is not None else F.current_timestamp()
    by = user if user is not None else F.current_user()
    return file_rows.select(
        F.sha1("command_text").alias("command_id"),
        F.col("command_ordinal").cast("int").alias("command_ordinal"),
        "command_text",
        "access_type",
        F.col("first_time_setup_ind").cast("boolean").alias("first_time_setup_ind"),
        at.alias("created_at_timestamp"),
        by.alias("created_by_user"),
        F.lit(None).cast("timestamp").alias("updated_at_timestamp"),
        F.lit(None).cast("string").alias("updated_by_user"),
    )


def expand_templates(
    templates: DataFrame,
    targets: DataFrame,
    values: dict[str, str] | None = None,
    setup: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """A concrete command for each template and each target of its access type.

    ``values`` maps a placeholder to the target column that fills it. A
    placeholder left over makes the row fail, so no half-filled command gets
    out.
    """
    values = values or {"schema-name": "schema_name", "access-role-name": "role_name"}
    chosen = templates if setup else templates.filter(~F.col("first_time_setup_ind"))
    if distinct:
        chosen = chosen.groupBy(*[c for c in chosen.columns if c != "command_ordinal"]).agg(
            F.min("command_ordinal").alias("command_ordinal")
        )
    both = targets.join(chosen, "access_type")
    text = fill_placeholders("command_text", dict(values))
    left = F.regexp_extract(text, r"<[a-z-]+>", 0)
    checked = F.when(left == "", text).otherwise(
        F.raise_error(F.concat(F.lit("placeholder without a value: "), left)).cast("string")
    )
    return both.withColumn("command", checked).drop("command_text")


def derive_revokes(commands: DataFrame, col: str = "command") -> DataFrame:
    """``REVOKE`` for each grant on ALL objects of a schema; other rows drop out."""
    text = F.regexp_replace(F.col(col), r"(?i)^(\s*)GRANT\b", "$1REVOKE")
    text = F.regexp_replace(text, r"(?i)\bTO(\s+)ROLE\b", "FROM$1ROLE")
    return commands.filter(F.col(col).ilike("%all%in schema%")).withColumn(col, text)


def command_chain(phases: Sequence[tuple[str, DataFrame, Sequence[str]]], order: Sequence[str], out: str = "step") -> DataFrame:
    """The commands of several phases as one list, numbered from 1 in the order they must run.

    A phase is a name, its commands, and the sequence of its access types; commands
    of an access type follow ``order`` (unique within one). A type that isn't listed makes
    the run fail instead of being left out.
    """
    parts = []
    for place, (name, commands, types) in enumerate(phases):
        rank = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("access_type"))
        known = F.when(rank > 0, rank).otherwise(
            F.raise_error(F.concat(F.lit("access type without a place: "), F.coalesce("access_type", F.lit("null")))).cast("bigint")
        )
        parts.append(commands.withColumns({"phase": F.lit(name), "__place": F.lit(place), "__rank": known}))
    run = land(reduce(DataFrame.unionByName, parts), "commands")
    return dense_sequence(run, ["__place", "__rank", *order], out=out).drop("__place", "__rank")


# A quoted piece or a comment that is never closed runs to the end of the script.
QUOTED = r"'[^']*+(?:'|\z)|\"[^\"]*+(?:\"|\z)|\$\$.*?(?:\$\$|\z)"
COMMENT = r"--[^\n]*+|/\*.*?(?:\*/|\z)"
# Possessive groups: the matcher loops over them without a stack frame per piece.
STATEMENT = rf"(?s)(?:[^;'\"$/-]++|{QUOTED}|{COMMENT}|[$/-])++"
# All up to the next gap of space and comments, then the gap.
UP_TO_GAP = rf"(?s)\G((?:[^'\"$/\s-]++|{QUOTED}|\$(?!\$)|-(?!-)|/(?!\*))*+)(?:\s++|{COMMENT})++"


def split_statements(scripts: DataFrame, text: str, script_id: str) -> DataFrame:
    """One row per statement of each script: script_id, stmt_id (from 0), stmt_text.

    Statements end at a ``;`` outside of ``'..'``, ``".."``, ``$$..$$`` and
    comments. Comments and runs of space outside of quotes become one space;
    quoted text stays as it is. Pieces of nothing else take a number but give no
    row, and neither does a script that is null.
    """
    pieces = F.regexp_extract_all(F.col(text), F.lit(STATEMENT), F.lit(0))
    return (
        scripts.select(script_id, F.posexplode(pieces).alias("stmt_id", "__text"))
        .select(script_id, "stmt_id", F.trim(F.regexp_replace("__text", UP_TO_GAP, "$1 ")).alias("stmt_text"))
        .filter(F.col("stmt_text") != "")
    )


# The object is matched lazily, because a space before TO may be missing.
GRANT_ROLE = r'(?i)^\s*GRANT\s+ROLE\s+"?([^\s"]+?)"?\s*TO\s+(ROLE|USER)\s+"?([^\s;"]+)"?'
GRANT_BULK = (
    r'(?i)^\s*GRANT\s+([A-Z][A-Z ,]*?)\s+ON\s+(ALL|FUTURE)\s+([A-Z][A-Z ]*?)S\s+IN\s+(SCHEMA|DATABASE)'
    r'\s+"?(\S+?)"?\s*TO\s+ROLE\s+"?([^\s;"]+)"?'
)
GRANT_ACCOUNT = r'(?i)^\s*GRANT\s+([A-Z][A-Z ,]*?)\s+ON\s+ACCOUNT\s+TO\s+ROLE\s+"?([^\s;"]+)"?'
GRANT_ONE = r'(?i)^\s*GRANT\s+([A-Z][A-Z ,]*?)\s+ON\s+([A-Z][A-Z ]*?)\s+"?(\S+?)"?\s*TO\s+ROLE\s+"?([^\s;"]+)"?'


def parse_grants(statements: DataFrame, text: str = "stmt_text") -> DataFrame:
    """Grant statements as columns, in upper case, one row per privilege of a list.

    privilege, scope (ALL, FUTURE or ONE), object_kind, object_name,
    container (SCHEMA or DATABASE of a bulk grant), grantee_kind, grantee, and
    status: ``parsed``, or ``unparsed`` with nulls for a GRANT of another form.
    Statements that are no GRANT drop out.
    """
    raw = F.col(text)

    def parts(pattern: str, n: int) -> Column:
        return F.array(*[F.upper(F.regexp_extract(raw, pattern, i)) for i in range(1, n + 1)])

    forms = (
        F.when(raw.rlike(GRANT_ROLE), F.struct(F.lit("role").alias("form"), parts(GRANT_ROLE, 3).alias("p")))
        .when(raw.rlike(GRANT_BULK), F.struct(F.lit("bulk").alias("form"), parts(GRANT_BULK, 6).alias("p")))
        .when(raw.rlike(GRANT_ACCOUNT), F.struct(F.lit("account").alias("form"), parts(GRANT_ACCOUNT, 2).alias("p")))
        .when(raw.rlike(GRANT_ONE), F.struct(F.lit("one").alias("form"), parts(GRANT_ONE, 4).alias("p")))
    )
    form, p = F.col("__f.form"), F.col("__f.p")

    def pick(role: Column, bulk: Column, account: Column, one: Column) -> Column:
        return F.when(form == "role", role).when(form == "bulk", bulk).when(form == "account", account).when(form == "one", one)

    lone, none = F.lit("ONE"), F.lit(None).cast("string")
    matched = statements.filter(raw.rlike(r"(?i)^\s*GRANT\b")).withColumn("__f", forms)
    listed = matched.withColumn("__one", F.explode(F.coalesce(F.split(pick(F.lit("ROLE"), p[0], p[0], p[0]), r"\s*,\s*"), F.array(none))))
    return listed.withColumns(
        {
            "privilege": F.col("__one"),
            "scope": pick(lone, p[1], lone, lone),
            "object_kind": pick(F.lit("ROLE"), p[2], F.lit("ACCOUNT"), p[1]),
            "object_name": pick(p[0], p[4], none, p[2]),
            "container": F.when(form == "bulk", p[3]),
            "grantee_kind": pick(p[1], F.lit("ROLE"), F.lit("ROLE"), F.lit("ROLE")),
            "grantee": pick(p[2], p[5], p[1], p[3]),
            "status": F.when(form.isNull(), "unparsed").otherwise("parsed"),
        }
    ).drop("__f", "__one")


def role_edges(grants: DataFrame) -> DataFrame:
    """child -> parent edges from parsed role grants: the parent holds the child."""
    held = grants.filter((F.col("object_kind") == "ROLE") & (F.col("grantee_kind") == "ROLE"))
    return held.select(F.col("object_name").alias("child"), F.col("grantee").alias("parent")).distinct()


def effective_privileges(grants: DataFrame, closure: DataFrame) -> DataFrame:
    """(role, privilege, object) pairs a role holds itself or through the roles
    granted to it."""
    direct = grants.filter((F.col("object_kind") != "ROLE") & (F.col("status") == "parsed")).select(
        F.col("grantee").alias("role_name"), "privilege", "scope", "object_kind", "object_name"
    ).distinct()
    ups = closure.select(F.col("child").alias("role_name"), F.col("ancestor").alias("__up"))
    inherited = direct.join(ups, "role_name").drop("role_name").withColumnRenamed("__up", "role_name")
    return direct.unionByName(inherited).distinct()


def user_privileges(effective: DataFrame, users: DataFrame) -> DataFrame:
    """(user, privilege, object) through the user's roles.

    Users with the same roles have the same privileges, so these are made distinct
    once per set of roles; the join to users, which grows with both, only streams.
    """
    held = users.select("user_name", "role_name").filter("role_name IS NOT NULL")
    tasks = max(1, -(-held.count() // USERS_AT_ONCE))
    sets = held.repartition(tasks, "user_name").groupBy("user_name").agg(F.sort_array(F.collect_set("role_name")).alias("roles"))
    kinds = sets.select("roles").distinct().withColumn("role_name", F.explode("roles"))
    privileges = kinds.join(effective, "role_name").drop("role_name").distinct()
    # a set that many users have is dealt in parts
    dealt = sets.withColumn("part", F.pmod(F.xxhash64("user_name"), F.lit(tasks)))
    wanted = dealt.select("roles", "part").distinct().join(privileges, "roles")
    number = [tasks] if tasks > FEW_TASKS else []  # a few are left to the adaptive plan
    both = [side.repartition(*number, "roles", "part") for side in (dealt, wanted)]
    return both[0].join(both[1], ["roles", "part"]).drop("roles", "part")


def drift(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected but absent (``missing``) and present but not expected (``extra``)."""
    side = F.when(F.max("__e") & ~F.max("__a"), "missing").when(~F.max("__e") & F.max("__a"), "extra")
    both = expected.select(*keys, F.lit(True).alias("__e"), F.lit(False).alias("__a")).unionByName(
        actual.select(*keys, F.lit(False).alias("__e"), F.lit(True).alias("__a"))
    )
    # one shuffle with map-side combine; null keys compare equal, unlike in a join
    return both.groupBy(*keys).agg(side.alias("status")).filter(F.col("status").isNotNull())


def statement_duplicates(grants: DataFrame) -> DataFrame:
    """(privilege, scope, object, grantee) granted more than once."""
    return duplicates(grants, ["privilege", "scope", "object_kind", "object_name", "grantee"])


def access_matrix(
    effective: DataFrame, row_keys: Sequence[str], column: str, column_values: Sequence[str], level: Column
) -> DataFrame:
    """Highest access level per row and column; the columns are given, so Spark
    needs no extra pass to find them."""
    return effective.withColumn("__level", level).groupBy(*row_keys).pivot(column, list(column_values)).agg(
        F.max("__level")
    )


def read_up_violations(access: DataFrame, env_rank: DataFrame) -> DataFrame:
    """Accesses that break the environment rule.

    ``access``: role_name, persona, home_env, object_env, privilege. Any role
    may act in its home environment. Engineers may read in a higher one. A
    write outside home, a read down, and any other persona's read outside home
    are violations. The rank table has one row per environment.
    """
    ranks = env_rank.select("env", "rank")
    home = ranks.select(F.col("env").alias("home_env"), F.col("rank").alias("__home"))
    there = ranks.select(F.col("env").alias("object_env"), F.col("rank").alias("__there"))
    seen = access.join(home, "home_env", "left").join(there, "object_env", "left")
    reads = F.col("privilege").isin(*READ_PRIVILEGE_NAMES)
    away = F.col("home_env") != F.col("object_env")
    rule = (
        F.when(away & ~reads, "write outside home")
        .when(away & (F.col("persona") != "ENGINEER"), "read-up by other persona")
        .when(away & ~F.coalesce(F.col("__there") > F.col("__home"), F.lit(False)), "read down")
    )
    return seen.withColumn("violation", rule).filter(F.col("violation").isNotNull()).drop("__home", "__there")


def naming_violations(objects: DataFrame, name: str = "object_name", kind: str = "object_kind") -> DataFrame:
    """Objects whose name breaks the rule of their kind.

    A kind with a suffix must end in ``_<suffix>``; a permanent table must end
    in none of the suffixes; databases and roles follow a pattern. Kinds
    without a rule pass.
    """
    upper_name, upper_kind = F.upper(name), F.upper(kind)
    broken = F.when(
        upper_kind == "PERMANENT TABLE", upper_name.rlike("_(" + "|".join(OBJECT_SUFFIXES.values()) + ")$")
    )
    for rule_kind, suffix in OBJECT_SUFFIXES.items():
        broken = broken.when(upper_kind == rule_kind, ~upper_name.rlike(f"^.+_{suffix}$"))
    for rule_kind, pattern in NAME_RULES.items():
        broken = broken.when(upper_kind == rule_kind, ~upper_name.rlike(pattern))
    return objects.filter(F.coalesce(broken, F.lit(False)))


def normal_name(name: str) -> Column:
    """The parts of a name in sorted order: the same name with parts moved compares equal."""
    return F.array_join(F.array_sort(F.split(F.upper(F.replace(F.col(name), F.lit('"'), F.lit(""))), "_")), "_")


def teardown_gaps(created: DataFrame, dropped: DataFrame, name: str = "role_name") -> DataFrame:
    """Created but never dropped, dropped but never created, and names that match
    only after their parts are reordered (``renamed``)."""
    made = created.select(F.upper(name).alias(name)).distinct()
    gone = dropped.select(F.upper(name).alias(name)).distinct()
    never_dropped = made.join(gone, name, "left_anti").withColumn("__key", normal_name(name))
    never_made = gone.join(made, name, "left_anti").withColumn("__key", normal_name(name))
    both = never_dropped.withColumn("side", F.lit("created only")).unionByName(
        never_made.withColumn("side", F.lit("dropped only"))
    )
    sides = both.groupBy("__key").agg(F.count_distinct("side").alias("__sides"))
    return both.join(sides, "__key").select(
        name, "side", (F.col("__sides") > 1).alias("matches_reordered")
    )


def privilege_counts(commands: DataFrame) -> DataFrame:
    """Commands per object kind and access type."""
    return commands.groupBy("object_kind", "access_type").agg(F.count(F.lit(1)).alias("n"))


