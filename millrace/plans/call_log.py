"""Call log: which statements each run of a job issued, from telemetry rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import unquote
from millrace.functions.timetext import second_boundaries
from millrace.operators.windows import dense_sequence, marker_sessions
from millrace.storage import land

# Telemetry attribute keys and the columns they fill.
ATTRIBUTE_COLUMNS = {
    "execution_query_id": "snow.query.id",
    "executing_user_name": "db.user",
    "executing_role_name": "snow.session.role.primary.name",
    "database_name": "snow.database.name",
    "schema_name": "snow.schema.name",
    "executable_object_type": "snow.executable.type",
}
EXECUTABLE_NAME = "snow.executable.name"

CALL_LOG_COLUMNS = [
    "execution_start_timestamp",
    "execution_end_timestamp",
    "execution_duration_seconds",
    "call_number",
    "call_subsequence_number",
    "execution_query_id",
    "executing_user_name",
    "executing_role_name",
    "database_name",
    "schema_name",
    "executable_object_name",
    "executable_object_type",
    "query_sequence_number",
    "query_text",
]


def executions(
    events: DataFrame, procedures: Sequence[str], marker_pattern: str, rows_per_slot: int | None = None
) -> DataFrame:
    """One row per execution of the given procedures, numbered by call.

    A call starts at each execution whose name matches ``marker_pattern``
    (case-insensitive); rows before the first one belong to call 0.
    """
    attrs = F.col("resource_attributes")
    named = events.select(
        F.col("start_timestamp").alias("execution_start_timestamp"),
        F.col("timestamp").alias("execution_end_timestamp"),
        second_boundaries("start_timestamp", "timestamp").alias("execution_duration_seconds"),
        *[unquote(attrs[key]).alias(name) for name, key in ATTRIBUTE_COLUMNS.items()],
        F.split_part(unquote(attrs[EXECUTABLE_NAME]), F.lit("("), F.lit(1)).alias("executable_object_name"),
        attrs[EXECUTABLE_NAME].ilike(marker_pattern).alias("__starts"),
        "record_attributes",
    )
    wanted = named.filter(
        (F.col("executable_object_type") == "PROCEDURE")
        & F.col("executable_object_name").isin(*procedures)
        & F.col("execution_start_timestamp").isNotNull()
    )
    start, tie = "execution_start_timestamp", "execution_query_id"
    # landed, because numbering reads its input for cut points, carries and rows
    base = land(wanted, "executions")
    numbered = marker_sessions(base, F.col("__starts"), start, [tie], rows_per_slot=rows_per_slot)
    calls = land(numbered.drop("__starts"), "calls")
    return dense_sequence(
        calls, [start, tie], by=["call_number"], out="call_subsequence_number", rows_per_slot=rows_per_slot
    )


def call_log(
    events: DataFrame,
    procedures: Sequence[str],
    marker_pattern: str,
    ordered: bool = False,
    rows_per_slot: int | None = None,
) -> DataFrame:
    """One row per recorded statement, with its call and place in the call.

    Executions without recorded statements vanish. ``ordered`` sorts newest
    first; leave it off when the result is stored or aggregated.
    """
    runs = executions(events, procedures, marker_pattern, rows_per_slot)
    flat = runs.select("*", F.explode("record_attributes").alias("key", "value"))
    log = flat.withColumns(
        {
            "query_sequence_number": F.replace(unquote("key"), F.lit("query"), F.lit("")).try_cast("bigint"),
            "query_text": unquote("value"),
        }
    ).select(*CALL_LOG_COLUMNS)
    if ordered:
        return log.orderBy(
            F.col("execution_start_timestamp").desc_nulls_first(), F.col("query_sequence_number").desc_nulls_first()
        )
    return log
