"""Copy the tables of an environment into a user's own set of databases."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Environments that may be cloned, and the layers of each.
SOURCE_ENVIRONMENTS = ("DEV", "QA", "PROD")
LAYERS = ("raw", "stage", "model")

COPIES_AT_ONCE = 4


class CloneError(RuntimeError):
    """A copy failed; ``done`` names every table that was copied."""

    def __init__(self, message: str, done: list[str]):
        super().__init__(message)
        self.done = done


def _checked_environment(env: str) -> str:
    name = env.replace(" ", "").upper()
    if name not in SOURCE_ENVIRONMENTS:
        raise ValueError(f"invalid environment {env!r}: allowed are {', '.join(SOURCE_ENVIRONMENTS)}")
    return name.lower()


def clone_schema(
    spark: SparkSession,
    src: str,
    user: str,
    layers: Sequence[str] = LAYERS,
    location: str | None = None,
) -> DataFrame:
    """Copy every table of ``<src>_<layer>`` to ``<user>_<layer>``, replacing it.

    The rows are written by the executors; a plain table format has no
    zero-copy clone, so the cost is one full read and write. After a failure no
    further copy starts. Returns schema, table, rows_source, rows_target, ok.
    """
    env = _checked_environment(src)
    if not re.fullmatch(r"[A-Za-z0-9_]+", user):
        raise ValueError("user must be a plain name")
    if user.upper() in SOURCE_ENVIRONMENTS:
        raise ValueError(f"{user} is an environment, not a user: its tables would be replaced")
    pairs = []
    for layer in layers:
        source_db, target_db = f"{env}_{layer}", f"{user.lower()}_{layer}"
        if not spark.catalog.databaseExists(source_db):
            continue
        at = f" LOCATION '{location}/{target_db}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {target_db}{at}")
        names = [t.name for t in spark.catalog.listTables(source_db) if not t.isTemporary]
        pairs += [(target_db, n, f"{source_db}.`{n}`", f"{target_db}.`{n}`") for n in sorted(names)]
    if not pairs:
        raise ValueError(f"environment {src!r} has no tables")

    def copy(pair):
        spark.table(pair[2]).write.format("parquet").mode("overwrite").saveAsTable(pair[3])
        return pair[3]

    with ThreadPoolExecutor(COPIES_AT_ONCE) as pool:
        jobs = [pool.submit(copy, pair) for pair in pairs]
        wait(jobs, return_when=FIRST_EXCEPTION)
        for job in jobs:
            job.cancel()
    # copies that were running at the failure have ended by now
    errors = {pair[2]: job.exception() for job, pair in zip(jobs, pairs) if not job.cancelled() and job.exception()}
    if errors:
        done = [job.result() for job in jobs if not job.cancelled() and not job.exception()]
        told = "; ".join(f"{table}: {error}" for table, error in errors.items())
        raise CloneError(f"copying failed: {told}", done) from next(iter(errors.values()))
    return clone_report(spark, pairs)


def clone_report(spark: SparkSession, pairs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Row counts of source and target per table."""
    counts = [
        spark.table(table).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(schema).alias("schema"), F.lit(name).alias("table"), F.lit(side).alias("side"), "n"
        )
        for schema, name, source, target in pairs
        for side, table in (("source", source), ("target", target))
    ]
    both = reduce(DataFrame.union, counts)
    return (
        both.groupBy("schema", "table")
        .agg(
            F.max(F.when(F.col("side") == "source", F.col("n"))).alias("rows_source"),
            F.max(F.when(F.col("side") == "target", F.col("n"))).alias("rows_target"),
        )
        .withColumn("ok", F.col("rows_source") == F.col("rows_target"))
    )
