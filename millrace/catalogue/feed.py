"""Post feed over ``events``: a user is an author, an event a post.

Copies are planted: every event with an even reading occurs twice, captured at
two times. The stored watermark is each author's newest post of the first half of
January.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import query, table
from millrace.functions.text import null_tokens, token_to_null
from millrace.operators import keys
from millrace.plans import feed
from millrace.storage import land, scratch_path
from millrace.streaming.ingest import batches, read_landing, stream_ingest

HALF = "2024-01-16 00:00:00"
READING = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a copy of every even reading, one minute later by ``seen``."""
    e = table(spark, sf_dir, "events").withColumn("reading", F.expr(READING))
    copies = F.when(F.col("reading") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return e.withColumn("copy", F.explode(copies)).select("event_id", "user_id", "event_type", "value", "ts", "copy")


POSTS_SQL = f"""(SELECT event_id, user_id, event_type, value, ts, 0 AS copy FROM events
  UNION ALL SELECT event_id, user_id, event_type, value, ts, 1 FROM events WHERE {READING} % 2 = 0)"""


@query("SELECT user_id, max(ts) AS max_created_ts FROM events GROUP BY user_id")
def watermark_by_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.watermark_by(table(spark, sf_dir, "events"), "user_id", "ts")


@query(
    f"""SELECT p.event_id, p.user_id, p.copy FROM {POSTS_SQL} p LEFT JOIN
    (SELECT user_id, max(ts) AS mark FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY user_id) m USING (user_id)
    WHERE mark IS NULL OR ts > mark"""
)
def incremental_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "events").filter(f"ts < TIMESTAMP_NTZ '{HALF}'")
    marks = land(keys.watermark_by(old, "user_id", "ts"), "marks")
    return keys.after_watermark(posts(spark, sf_dir), marks, "user_id", "ts").select("event_id", "user_id", "copy")


@query(f"SELECT event_id, max(copy) AS copy FROM {POSTS_SQL} GROUP BY event_id")
def dedup_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.dedup_first(posts(spark, sf_dir), ["event_id"], [F.desc("copy")]).select("event_id", "copy")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def latest_handle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.latest_attribute(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"])


SPLIT_SQL = f"""SELECT event_id, user_id FROM events WHERE user_id {{}} IN
  (SELECT user_id FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '{HALF}')"""


def _signed_up(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events")
    return keys.split_known(e, e.filter(f"event_type = 'signup' AND ts < TIMESTAMP_NTZ '{HALF}'"), ["user_id"])


@query(SPLIT_SQL.format(""))
def known_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed_up(spark, sf_dir)[0].select("event_id", "user_id")


@query(SPLIT_SQL.format("NOT"))
def new_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed_up(spark, sf_dir)[1].select("event_id", "user_id")


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_day_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.latest_partition(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), "day").select("event_id")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("SELECT l.* FROM lineitem l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "l_orderkey")
    return keys.skip_existing(table(spark, sf_dir, "lineitem"), done, "l_orderkey").select(*table(spark, sf_dir, "lineitem").columns)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('NULL', 'null', 'nan', '', '5-LOW') THEN o_orderpriority END AS priority,
       CASE WHEN o_orderstatus NOT IN ('NULL', 'null', 'nan', '') THEN o_orderstatus END AS status FROM orders"""
)
def null_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = null_tokens(table(spark, sf_dir, "orders"), ["o_orderstatus"])
    low = token_to_null("o_orderpriority", ("NULL", "null", "nan", "", "5-LOW"))
    return o.select("o_orderkey", low.alias("priority"), F.col("o_orderstatus").alias("status"))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per user, with the user's events as feed items; errors have no embed."""
    e = table(spark, sf_dir, "events")
    link = F.struct(F.col("event_type").alias("title"), F.lit("about").alias("description"), F.concat(F.lit("u/"), "event_id").alias("uri"))
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("props").alias("text"),
        F.array("event_type").alias("tags"),
        F.struct(F.when(F.col("event_type") != "error", link).alias("external")).alias("embed"),
    )
    user = F.col("user_id").cast("string")
    author = F.struct(user.alias("did"), F.concat(F.lit("h"), user).alias("handle"), F.concat(F.lit("Name "), user).alias("display_name"), F.lit("2023-05-01T00:00:00Z").alias("created_at"))
    count = F.col("event_id")
    post = F.struct(
        F.col("event_id").cast("string").alias("cid"), F.concat(F.lit("at://"), "event_id").alias("uri"),
        count.alias("like_count"), (count + 1).alias("quote_count"), (count + 2).alias("reply_count"), (count + 3).alias("repost_count"),
        author.alias("author"), record.alias("record"),
    )
    # pages hold a hundred events each, however many a user has
    page = F.floor(F.col("event_id") / 100)
    return e.groupBy(user.alias("feed_owner_did"), page.alias("cursor")).agg(F.collect_list(F.struct(post.alias("post"))).alias("feed"))


FLAT_SQL = """SELECT CAST(event_id AS VARCHAR) AS content_id, event_id AS like_count, event_id + 3 AS repost_count,
  epoch_us(ts) AS created_us, props AS text, event_type AS tag,
  CASE WHEN event_type <> 'error' THEN 'u/' || event_id END AS link, 'h' || user_id AS handle, CAST(user_id AS VARCHAR) AS owner FROM events"""


@query(FLAT_SQL)
def flatten_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    landed_pages(spark, sf_dir).write.json(path)
    flat = feed.flatten_feed(feed.feed_pages(spark, path))
    return flat.select(
        "content_id", "like_count", "repost_count", F.unix_micros("post_created_timestamp").alias("created_us"), "text",
        F.col("tags")[0].alias("tag"), F.col("embedded_link_uri").alias("link"), F.col("post_author_username").alias("handle"),
        F.col("feed_owner_did").alias("owner"),
    )


@query(FLAT_SQL)
def raw_to_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages to text rows to typed rows."""
    flat = feed.flatten_feed(landed_pages(spark, sf_dir)).withColumn("owner", F.col("feed_owner_did"))
    raw = feed.to_raw(flat, "box", "feeds", "f_1.csv").withColumn("owner", F.split_part("post_author_username", F.lit("h"), F.lit(2)))
    staged = feed.to_stage(raw)
    return staged.select(
        "content_id", "like_count", "repost_count", F.unix_micros("post_created_timestamp").alias("created_us"), "text",
        F.col("tags")[0].alias("tag"), F.col("embedded_link_uri").alias("link"), F.col("author_username").alias("handle"),
        F.col("author_did").alias("owner"),
    )


@query("SELECT event_id, user_id FROM events")
def stream_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``events`` through the stream, twice: with a new checkpoint the second run adds nothing."""
    source, target, marks = (scratch_path(spark, x) for x in ("landing", "target", "marks"))
    table(spark, sf_dir, "events").write.parquet(source)
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        stream = read_landing(spark, source, schema, "parquet")
        stream_ingest(stream, target, marks, scratch_path(spark, "checkpoint"), "user_id", "event_id", "ts", [F.col("value")]).awaitTermination()
    return batches(spark, target, schema).select("event_id", "user_id")
