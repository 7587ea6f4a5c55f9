"""First-per-key, watermark and lookup operators.

Joins carry no broadcast hint on a side that grows with the data. The small
side is landed first, so Spark knows its size: under the auto-broadcast
threshold the join is a broadcast join, beyond it a shuffle join whose hot
partitions the adaptive planner splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.storage import land


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key in ``order``; repeatable if the order is total.

    ``row_number() = 1`` lets Spark drop all but one row per key on the map
    side (WindowGroupLimit), so a key with very many copies shuffles one row
    per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def watermark_by(df: DataFrame, key: str, ts: str, out: str = "max_created_ts") -> DataFrame:
    """Newest time per key, as a maximum over timestamps."""
    return df.groupBy(key).agg(F.max(ts).alias(out))


def after_watermark(
    posts: DataFrame,
    watermark: DataFrame,
    key: str,
    ts: str,
    mark: str = "max_created_ts",
) -> DataFrame:
    """Rows strictly newer than their key's watermark, and every row of a key without one.

    A row without a time can't be compared once its key has a watermark: see ``untimed``.

    ``watermark`` should be a stored table (or ``land``-ed), so its size is known.
    """
    marks = watermark.select(F.col(key), F.col(mark).alias("__mark"))
    return posts.join(marks, key, "left").filter(F.col("__mark").isNull() | (F.col(ts) > F.col("__mark"))).drop("__mark")


def untimed(posts: DataFrame, ts: str) -> DataFrame:
    """The rows that a watermark can't judge, to be stored aside and counted."""
    return posts.filter(F.col(ts).isNull())


def latest_attribute(
    df: DataFrame, key: str, attr: str, order: Sequence[str], out: str | None = None
) -> DataFrame:
    """The attribute on the newest row of each key."""
    return df.groupBy(key).agg(F.max_by(attr, F.struct(*order)).alias(out or attr))


def split_known(new: DataFrame, seen: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key was seen before, rows whose key is new)."""
    known = seen.select(*on).distinct()
    return new.join(known, list(on), "left_semi"), new.join(known, list(on), "left_anti")


def skip_existing(new: DataFrame, manifest: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose name is not in the manifest."""
    names = [on] if isinstance(on, str) else list(on)
    return new.join(manifest.select(*names).distinct(), names, "left_anti")


def first_per(df: DataFrame, col: str, by: str, order: Sequence[str], out: str) -> DataFrame:
    """First non-null ``col`` of each ``by`` value, in ``order``."""
    known = F.when(F.col(col).isNotNull(), F.struct(*order))
    return df.groupBy(by).agg(F.min_by(col, known).alias(out))


def daily_first(
    df: DataFrame, col: str, ts: str, tie: Sequence[str] = (), day: str = "day", out: str = "open"
) -> DataFrame:
    """Spread each day's first non-null value over the rows of the day."""
    dated = df.withColumn(day, F.to_date(ts))
    opens = land(first_per(dated, col, day, [ts, *tie], out), "daily-first")
    return dated.join(opens, day, "left")


def latest_partition(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest date. On a date-partitioned table the scalar subquery
    prunes the scan to one partition."""
    return df.filter(F.col(date_col) == df.agg(F.max(date_col)).scalar())


def duplicates(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)
