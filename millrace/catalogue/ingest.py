"""Two ingestion runs over ``events``: a first one over the first half of January, and one that fetches everything anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.feed import HALF, POSTS_SQL, posts
from millrace.catalogue.registry import query
from millrace.plans.ingest_run import Feed
from millrace.storage import scratch_path


def _ingested(spark: SparkSession, sf_dir: str) -> Feed:
    feed = Feed(scratch_path(spark, "feed"), "user_id", "ts", ["event_id"], [F.desc("copy")])
    every = posts(spark, sf_dir)
    feed.ingest(every.filter(f"ts < TIMESTAMP_NTZ '{HALF}'"), "first half")
    feed.ingest(every, "all")
    return feed


RUNS_SQL = f"""posts AS {POSTS_SQL},
marks AS (SELECT user_id, max(ts) AS mark FROM posts WHERE ts < TIMESTAMP '{HALF}' GROUP BY user_id),
read AS (SELECT *, 1 AS ordinal FROM posts WHERE ts < TIMESTAMP '{HALF}' UNION ALL SELECT *, 2 FROM posts),
fresh AS (SELECT r.* FROM read r LEFT JOIN marks m ON m.user_id IS NOT DISTINCT FROM r.user_id
  WHERE r.ts IS NOT NULL AND (r.ordinal = 1 OR m.mark IS NULL OR r.ts > m.mark)),
landed AS (SELECT ordinal, event_id, any_value(user_id) AS user_id, max(copy) AS copy FROM fresh GROUP BY ordinal, event_id)"""


@query(f"WITH {RUNS_SQL} SELECT event_id, user_id, copy, ordinal AS run_ordinal FROM landed")
def ingest_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir).rows(spark).select("event_id", "user_id", "copy", "run_ordinal")


@query(
    f"""WITH {RUNS_SQL}, counts AS (
  SELECT ordinal, 'read' AS step, count(*) AS n FROM read GROUP BY ordinal
  UNION ALL SELECT ordinal, 'fresh', count(*) FROM fresh GROUP BY ordinal
  UNION ALL SELECT ordinal, 'landed', count(*) FROM landed GROUP BY ordinal
  UNION ALL SELECT ordinal, 'rejected', count(*) FILTER (ts IS NULL) FROM read GROUP BY ordinal)
SELECT CASE ordinal WHEN 1 THEN 'first half' ELSE 'all' END AS run, ordinal, step, n FROM counts"""
)
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir).report(spark)
