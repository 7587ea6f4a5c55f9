"""Table creation and loading in the modes a warehouse script uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MODES = ("create_if_absent", "replace", "append", "overwrite")


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType) -> None:
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet")


def create_like(spark: SparkSession, table: str, like: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} LIKE {like} USING parquet")


def save(df: DataFrame, table: str, mode: str) -> None:
    """Write ``df`` to ``table``.

    ``create_if_absent`` leaves an existing table alone, ``replace`` drops and
    remakes it, ``append`` and ``overwrite`` insert into the existing table and
    match columns by name.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = df.sparkSession
    if mode == "create_if_absent":
        if not spark.catalog.tableExists(table):
            df.write.format("parquet").saveAsTable(table)
    elif mode == "replace":
        df.write.format("parquet").mode("overwrite").saveAsTable(table)
    else:
        insert_by_name(df, table, overwrite=mode == "overwrite")


def insert_by_name(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """``INSERT`` with columns matched by name, ignoring case."""
    target = df.sparkSession.table(table).columns
    have = {c.lower(): c for c in df.columns}
    odd = {c.lower() for c in target} ^ set(have)
    if odd:
        raise ValueError(f"columns of the frame and of {table} differ: {sorted(odd)}")
    ordered = df.select(*[f"`{have[c.lower()]}`" for c in target])
    ordered.write.option("partitionOverwriteMode", "static").insertInto(table, overwrite=overwrite)
