"""Time, text, draw and projection helpers over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import md5_uniform, query, table
from millrace.functions import seeded, text, timetext
from millrace.operators.stacking import stack_days as stack
from millrace.operators.stacking import stack_tables
from millrace.plans.ticks import only_where
from millrace.sources.csv_files import chunk_plan as plan_chunks
from millrace.sources.csv_files import frame_bytes, load_csv_by_name, restart_plan, write_chunked
from millrace.sources.generate import time_spine
from millrace.storage import scratch_path


@query("SELECT event_id, ts, ts AS back, ts AS back_by_parts FROM events")
def d_timestamp_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = table(spark, sf_dir, "events").select("event_id", "ts", timetext.to_d_text("ts").alias("d"))
    return shown.select("event_id", "ts", timetext.from_d_text("d").alias("back"), timetext.from_d_parts("d").alias("back_by_parts"))


@query(
    """SELECT event_id, ts + to_seconds(CAST(user_id AS BIGINT)) AS later, ts - INTERVAL 5 HOUR AS shifted,
       date_diff('second', ts, ts + to_seconds(CAST(user_id AS BIGINT))) AS boundaries, ts + INTERVAL 3 DAY AS days FROM events"""
)
def shift_and_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("later", timetext.shift_seconds("ts", "user_id"))
    return e.select(
        "event_id", "later", timetext.shift_hours("ts", -5).alias("shifted"),
        timetext.second_boundaries("ts", "later").alias("boundaries"), timetext.shift_days("ts", 3).alias("days"),
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S%f') || user_id AS seq_key FROM events")
def seq_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", timetext.time_key("ts", "user_id").alias("seq_key"))


@query("SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS value, event_type FROM events")
def masked_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = only_where(F.col("event_type") == "purchase", value=F.col("value"))
    return table(spark, sf_dir, "events").withColumns(masked).select("event_id", "value", "event_type")


@query("SELECT * EXCLUDE (o_totalprice, o_orderpriority) FROM orders")
def projection_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").drop("o_totalprice", "o_orderpriority")


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC NULLS FIRST, event_id LIMIT 100")
def top_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "value").orderBy(F.desc_nulls_first("ts"), "event_id").limit(100)


@query(
    f"""SELECT event_id, CASE WHEN u * 10.0 < 6.0 THEN 'a' WHEN u * 10.0 < 9.0 THEN 'b' ELSE 'c' END AS pick,
        u < 0.3 AS hit, value + (u * 2.0 - 1.0) * 0.5 AS moved FROM (SELECT *, {md5_uniform("draw", "event_id")} AS u FROM events)"""
)
def seeded_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = seeded.hash_uniform("draw", "event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", seeded.weighted_choice(u, ["a", "b", "c"], [6, 3, 1]).alias("pick"), seeded.bernoulli(u, 0.3).alias("hit"),
        seeded.jitter("value", u, volatility=0.5, relative=False).alias("moved"),
    )


@query(
    f"""SELECT event_id, ts + to_microseconds(CAST(round_even((u * 2.0 - 1.0) * 1000000.0, 0) AS BIGINT)) AS moved
        FROM (SELECT *, {md5_uniform("time", "event_id")} AS u FROM events)"""
)
def jittered_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", seeded.jitter_time("ts", seeded.hash_uniform("time", "event_id")).alias("moved"))


@query("SELECT event_id, k AS copy, ts + to_days(CAST(k AS INTEGER)) AS ts FROM events, range(5) r(k)")
def stack_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack(table(spark, sf_dir, "events").select("event_id", "ts"), 5, ["ts"], offset="copy").select("event_id", F.col("copy").cast("long").alias("copy"), "ts")


@query(
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return stack_tables(c, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).select("id", "name", "segment")


@query(
    """SELECT o_orderkey, 'part' || (o_orderkey % 7) || '_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || o_custkey || '.csv' AS name,
       'csv' AS extension, o_custkey AS ordinal, CAST(o_orderdate AS DATE) AS day FROM orders"""
)
def file_name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("box/in/part"), F.col("o_orderkey") % 7, F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"), "o_custkey", F.lit(".csv"))
    named = table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
    return named.select("o_orderkey", text.base_name("path").alias("name"), text.extension("path").alias("extension"), text.ordinal_of("path").alias("ordinal"), text.date_of("path").alias("day"))


@query("SELECT doc_id, text, lang, n_chars FROM documents")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through quoted CSV files cut by size, and back by column name."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    path = scratch_path(spark, "csv")
    write_chunked(docs, path, ["doc_id"], 2_000_000)
    return load_csv_by_name(spark, path, docs.select("doc_id", "text", "lang", "n_chars").schema)


@query(
    """SELECT doc_id, CAST(floor((s - n_chars) / 100000) + 1 AS BIGINT) AS file_no
       FROM (SELECT doc_id, n_chars, sum(n_chars) OVER (ORDER BY doc_id) AS s FROM documents)"""
)
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return plan_chunks(docs, ["doc_id"], 100_000, "n_chars").select("doc_id", "file_no")


LINES_SQL = """lines AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r,
  length(doc_id::VARCHAR) + strlen(replace(coalesce(text, ''), '"', '""')) + 6 AS size FROM documents)"""


@query(
    f"""WITH RECURSIVE {LINES_SQL}, ends AS (SELECT *, sum(size) OVER (ORDER BY r) AS e FROM lines),
       starts AS (SELECT 1 AS file_no, CAST(1 AS BIGINT) AS r, CAST(0 AS HUGEINT) AS before
         UNION ALL SELECT file_no + 1, n.r + 1, n.e FROM starts s, LATERAL (SELECT min(r) AS r, min(e) AS e FROM ends WHERE e >= s.before + 100000) n WHERE n.r IS NOT NULL)
       SELECT doc_id, CAST((SELECT max(file_no) FROM starts s WHERE s.r <= e.r) AS BIGINT) AS file_no FROM ends e"""
)
def restart_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of at least 100 kB of CSV lines, each begun where the one before was full."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return restart_plan(docs, ["doc_id"], 100_000).select("doc_id", "file_no")


@query(f"WITH {LINES_SQL} SELECT CAST(sum(size) AS BIGINT) AS total_bytes FROM lines")
def csv_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    """SELECT h AS hour, count(event_id) AS n FROM
       (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS h FROM events)
       LEFT JOIN events ON date_trunc('hour', ts) = h GROUP BY h"""
)
def hourly_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    first, last = e.agg(F.min("hour"), F.max("hour")).first()
    spine = time_spine(spark, first, last, 3_600_000_000, out="hour").select("hour")
    counted = e.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counted, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    """SELECT CAST(ts AS DATE) AS day, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1"""
)
def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close")
    )
