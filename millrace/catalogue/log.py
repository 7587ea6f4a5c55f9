"""Call log over telemetry rows made from ``events``.

The event type stands for the executable: a signup starts a call, clicks and
views are its child procedures, a purchase is another procedure and an error a
function, so both filters have something to drop. Start times are cut to the
minute, which plants ties. Purchases aside, a row records two statements and a
note; a click with an even reading records none and vanishes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import query, table
from millrace.plans.call_log import call_log as build_call_log
from millrace.plans.call_log import executions

PROCEDURES = ("COPY_ALL", "GRANT_ALL", "REVOKE_ALL")
MARKER = "%copy_all%"


def telemetry(events: DataFrame) -> DataFrame:
    def quoted(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    kind = F.col("event_type")
    name = (
        F.when(kind == "signup", "COPY_ALL(VARCHAR)")
        .when(kind == "click", "GRANT_ALL(VARCHAR)")
        .when(kind == "view", "REVOKE_ALL(VARCHAR, VARCHAR)")
        .when(kind == "purchase", "OTHER_PROC()")
        .otherwise("GRANT_ALL(VARCHAR)")
    )
    reading = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    resource = F.create_map(
        F.lit("snow.executable.name"), quoted(name),
        F.lit("snow.executable.type"), quoted(F.when(kind == "error", "FUNCTION").otherwise("PROCEDURE")),
        F.lit("snow.query.id"), quoted(F.lpad(F.col("event_id").cast("string"), 12, "0")),
        F.lit("db.user"), quoted(F.concat(F.lit("USER"), F.col("user_id").cast("string"))),
        F.lit("snow.session.role.primary.name"), quoted(F.lit("OPS")),
        F.lit("snow.database.name"), quoted(F.lit("QA_EDW_DB")),
        F.lit("snow.schema.name"), quoted(F.lit("UTIL")),
    )
    statements = F.create_map(
        F.concat(F.lit("query"), reading.cast("string")), quoted(F.concat(kind, F.lit(" first"))),
        F.concat(F.lit("query"), (reading + 1).cast("string")), quoted(F.concat(kind, F.lit(" second"))),
        F.lit("note"), quoted(F.col("props")),
    )
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    quiet = (kind == "click") & (reading % 2 == 0)
    start = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return events.select(
        start.alias("start_timestamp"),
        F.timestamp_add("MICROSECOND", (F.col("value") * 1000000).cast("bigint"), start).alias("timestamp"),
        resource.alias("resource_attributes"),
        F.when(quiet, none).otherwise(statements).alias("record_attributes"),
    )


RUNS_SQL = """
WITH base AS (
  SELECT event_id, event_type, user_id, props,
         date_trunc('minute', ts) AS st,
         date_trunc('minute', ts) + to_microseconds(CAST(trunc(value * 1000000) AS BIGINT)) AS en,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS reading
  FROM events WHERE event_type IN ('signup', 'click', 'view')
), calls AS (
  SELECT *, count(CASE WHEN event_type = 'signup' THEN 1 END) OVER (ORDER BY st) AS call_number FROM base
), runs AS (
  SELECT *, row_number() OVER (PARTITION BY call_number ORDER BY st, event_id) AS call_subsequence_number FROM calls
)
"""


@query(
    RUNS_SQL
    + """
, flat AS (
  SELECT *, 'query' || reading AS k, event_type || ' first' AS v FROM runs
  UNION ALL SELECT *, 'query' || (reading + 1), event_type || ' second' FROM runs
  UNION ALL SELECT *, 'note', props FROM runs
)
SELECT st AS execution_start_timestamp, en AS execution_end_timestamp,
       date_diff('second', st, en) AS execution_duration_seconds,
       call_number, call_subsequence_number,
       lpad(CAST(event_id AS VARCHAR), 12, '0') AS execution_query_id,
       'USER' || user_id AS executing_user_name, 'OPS' AS executing_role_name,
       'QA_EDW_DB' AS database_name, 'UTIL' AS schema_name,
       CASE event_type WHEN 'signup' THEN 'COPY_ALL' WHEN 'click' THEN 'GRANT_ALL' ELSE 'REVOKE_ALL' END
         AS executable_object_name,
       'PROCEDURE' AS executable_object_type,
       TRY_CAST(replace(k, 'query', '') AS BIGINT) AS query_sequence_number, v AS query_text
FROM flat WHERE NOT (event_type = 'click' AND reading % 2 = 0)
"""
)
def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_call_log(telemetry(table(spark, sf_dir, "events")), PROCEDURES, MARKER)


@query(
    RUNS_SQL
    + """
SELECT call_number, count(*) AS executions, min(st) AS first_start, max(st) AS last_start,
       max(call_subsequence_number) AS last_place
FROM runs GROUP BY call_number
"""
)
def call_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = executions(telemetry(table(spark, sf_dir, "events")), PROCEDURES, MARKER)
    return runs.groupBy("call_number").agg(
        F.count(F.lit(1)).alias("executions"),
        F.min("execution_start_timestamp").alias("first_start"),
        F.max("execution_start_timestamp").alias("last_start"),
        F.max("call_subsequence_number").alias("last_place"),
    )


@query(
    """
SELECT event_id, k AS attribute_key, v AS attribute_value,
       TRY_CAST(replace(k, 'query', '') AS BIGINT) AS query_sequence_number
FROM (
  SELECT event_id, 'query' || regexp_extract(props, '([0-9]+)', 1) AS k, event_type || ' first' AS v, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS reading FROM events
  UNION ALL
  SELECT event_id, 'query' || (CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) + 1), event_type || ' second',
         event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) FROM events
  UNION ALL
  SELECT event_id, 'note', props, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) FROM events
) WHERE NOT (event_type = 'click' AND reading % 2 = 0)
"""
)
def flatten_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.functions.text import unquote

    rows = telemetry(table(spark, sf_dir, "events"))
    flat = rows.select(
        unquote(F.col("resource_attributes")["snow.query.id"]).cast("bigint").alias("event_id"),
        F.explode("record_attributes").alias("key", "value"),
    )
    return flat.select(
        "event_id",
        F.col("key").alias("attribute_key"),
        unquote("value").alias("attribute_value"),
        F.replace(unquote("key"), F.lit("query"), F.lit("")).try_cast("bigint").alias("query_sequence_number"),
    )
