"""File names, lineage columns and the manifest of written files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import base_name, date_of, extension, ordinal_of


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and time of the files below ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", F.col("length").alias("bytes"), "modificationTime")


def with_lineage(
    df: DataFrame,
    container: str,
    path: str | None = None,
    name: str | None = None,
    prefix: str = "source",
) -> DataFrame:
    """Add container, folder and file name to each row.

    Without ``path`` and ``name`` they come from the file each row was read
    from, so ``df`` must be a file scan; on write, pass them.
    """
    whole = F.col("_metadata.file_path")
    folder: Column = F.lit(path) if path is not None else F.regexp_replace(whole, r"[^/]*$", "")
    file: Column = F.lit(name) if name is not None else base_name(whole)
    return df.select(
        "*",
        F.lit(container).alias(f"{prefix}_container_name"),
        folder.alias(f"{prefix}_path"),
        file.alias(f"{prefix}_name"),
    )


def file_name(date: Column, ordinal: Column, stem: str = "posts", ext: str = "csv") -> Column:
    """``<stem>_<yyyy-MM-dd>_<ordinal>.<ext>``"""
    return F.concat(
        F.lit(f"{stem}_"), F.date_format(date, "yyyy-MM-dd"), F.lit("_"), ordinal.cast("string"), F.lit(f".{ext}")
    )


def next_ordinal(names: DataFrame, name_col: str, ext: str = "csv") -> DataFrame:
    """Per date in the names, one more than the largest ordinal (compared as a number)."""
    parsed = names.filter(F.lower(extension(name_col)) == ext).select(
        date_of(name_col).alias("date"), ordinal_of(name_col).alias("__n")
    )
    return (
        parsed.filter("date IS NOT NULL AND __n IS NOT NULL").groupBy("date").agg((F.max("__n") + 1).alias("next_n"))
    )


def next_ordinal_for(names: DataFrame, name_col: str, date: str) -> int:
    """The next ordinal of one date, 1 where the date has no file yet."""
    row = next_ordinal(names, name_col).filter(F.col("date") == F.lit(date).cast("date")).first()
    return row["next_n"] if row else 1
