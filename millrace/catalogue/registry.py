"""Registered queries: a Spark callable over a data folder, and the same query
in SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(fn: Query) -> Query:
        if fn.__name__ in ENTRIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        ENTRIES[fn.__name__] = Entry(fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def md5_uniform(seed: str, key: str) -> str:
    """SQL text of the seeded draw, for the SQL side of a query."""
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 8))::UBIGINT / 4294967296.0)"
