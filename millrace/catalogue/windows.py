"""Running, filled and numbered columns over ``events``.

A purchase is a trade and its value the price; other rows have no price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import md5_uniform, query, table
from millrace.operators import windows as w
from millrace.operators.keys import daily_first
from millrace.plans.ticks import FIRST_FEED_NUMBER, open_high_low
from millrace.plans.ticks import bid_ask as add_quotes

ORDER = ["ts", "event_id"]
PRICE_SQL = "CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END"


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a decimal ``price`` on purchases only."""
    price = F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(18,2)"))
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", price.alias("price"))


@query(
    f"""
SELECT event_id, CAST({PRICE_SQL} AS DOUBLE) AS volume,
       CAST(sum(coalesce({PRICE_SQL}, 0)) OVER (ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS acc_volume
FROM events
"""
)
def acc_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = w.running_sum(trades(spark, sf_dir), "price", ORDER, out="acc")
    return out.select(
        "event_id", F.col("price").cast("double").alias("volume"), F.col("acc").cast("double").alias("acc_volume")
    )


@query(
    f"""
SELECT event_id, user_id,
       CAST(sum(coalesce({PRICE_SQL}, 0)) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS acc_volume
FROM events
"""
)
def acc_volume_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = w.running_sum(trades(spark, sf_dir), "price", ORDER, by=["user_id"], out="acc")
    return out.select("event_id", "user_id", F.col("acc").cast("double").alias("acc_volume"))


FILLED_SQL = f"""
  SELECT event_id, user_id, event_type, ts,
         coalesce(
           last_value(p IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(p IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS filled
  FROM (SELECT *, {PRICE_SQL} AS p FROM events)
"""


@query(f"SELECT event_id, user_id, CAST(filled AS DOUBLE) AS filled_price FROM ({FILLED_SQL})")
def ffill_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = w.forward_fill(trades(spark, sf_dir), "price", ORDER, by=["user_id"], out="filled")
    return out.select("event_id", "user_id", F.col("filled").cast("double").alias("filled_price"))


@query(
    f"""
SELECT event_id,
       CAST(filled + CASE WHEN b * 366.0 < 60.0 THEN -2 WHEN b * 366.0 < 180.0 THEN -1
                          WHEN b * 366.0 < 360.0 THEN 0 ELSE 1 END AS DOUBLE) AS bid_price,
       CAST(1 + floor(bs * 6) AS BIGINT) AS bid_size,
       CAST(filled + CASE WHEN a * 18.0 < 9.0 THEN 0 WHEN a * 18.0 < 15.0 THEN 1 ELSE 2 END AS DOUBLE) AS ask_price,
       CAST(1 + floor(asz * 6) AS BIGINT) AS ask_size
FROM (SELECT event_id, filled, {md5_uniform("quote-bid", "event_id")} AS b,
             {md5_uniform("quote-bidsize", "event_id")} AS bs, {md5_uniform("quote-ask", "event_id")} AS a,
             {md5_uniform("quote-asksize", "event_id")} AS asz
      FROM ({FILLED_SQL}))
"""
)
def bid_ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = w.forward_fill(trades(spark, sf_dir), "price", ORDER, by=["user_id"], out="filled")
    quoted = add_quotes(out, "filled", ["event_id"])
    return quoted.select(
        "event_id",
        F.col("bid_price").cast("double").alias("bid_price"),
        "bid_size",
        F.col("ask_price").cast("double").alias("ask_price"),
        "ask_size",
    )


OPEN_SQL = """
  SELECT e.event_id, CAST(e.ts AS DATE) AS day, o.open FROM events e LEFT JOIN (
    SELECT CAST(ts AS DATE) AS d, arg_min(value, ts) AS open FROM events WHERE event_type = 'purchase' GROUP BY 1
  ) o ON o.d = CAST(e.ts AS DATE)
"""


def opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("event_type") == "purchase", F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", price.alias("price"))
    return daily_first(events, "price", "ts", ["event_id"], out="open").select("event_id", "day", "open")


@query(OPEN_SQL)
def daily_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opened(spark, sf_dir)


@query(
    f"""
SELECT event_id, day_open, day_open * (1 + h * 0.001::DOUBLE) AS day_high, day_open * (1 + -(l * 0.001::DOUBLE)) AS day_low
FROM (SELECT event_id, open * (1 + (o * 2.0::DOUBLE - 1.0::DOUBLE) * 0.001::DOUBLE) AS day_open, h, l
      FROM (SELECT event_id, open, {md5_uniform("day-open", "day")} AS o,
                   {md5_uniform("day-high", "event_id")} AS h, {md5_uniform("day-low", "event_id")} AS l
            FROM ({OPEN_SQL})))
"""
)
def high_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = open_high_low(opened(spark, sf_dir), "open", "day", ["event_id"])
    return out.select("event_id", "day_open", "day_high", "day_low")


@query(
    f"""
SELECT event_id, CAST(44650.56::DECIMAL(18,2) + (n - first_n) * 0.002::DECIMAL(18,3) AS DOUBLE) AS walk
FROM (SELECT event_id, sum(s) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n,
             first_value(s) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_n
      FROM (SELECT *, CAST(CASE WHEN {md5_uniform("walk", "event_id")} < 0.75 THEN 1 ELSE -1 END AS BIGINT) AS s
            FROM events))
"""
)
def signed_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return w.signed_walk(events, ORDER, ["event_id"], "44650.56", "0.002", 0.75).select("event_id", F.col("walk").cast("double").alias("walk"))


@query(
    """SELECT event_id, user_id, CAST(1000.00::DECIMAL(18,2) + CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,0)) * 0.01::DECIMAL(18,2) AS DOUBLE) AS balance
       FROM (SELECT *, CAST(round(value * 100) AS BIGINT) * CASE WHEN event_type = 'purchase' THEN -1 ELSE 1 END AS cents FROM events)"""
)
def running_from_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's balance from a start of 1000: purchases take, all else gives; summed in whole cents."""
    cents = F.round(F.col("value") * 100).cast("bigint") * F.when(F.col("event_type") == "purchase", -1).otherwise(1)
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", cents.alias("cents"))
    out = w.running_sum(events, "cents", ORDER, by=["user_id"], start=100_000, out="n")
    return out.select("event_id", "user_id", F.expr("CAST(CAST(n AS DECIMAL(20,0)) * 0.01BD AS DOUBLE)").alias("balance"))


@query(
    f"SELECT event_id, {FIRST_FEED_NUMBER - 1} + row_number() OVER (ORDER BY ts, event_id) AS feed_number FROM events"
)
def dense_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return w.dense_sequence(events, ORDER, start=FIRST_FEED_NUMBER, out="feed_number").select(
        "event_id", "feed_number"
    )


@query(
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS newest_rank "
    "FROM events"
)
def newest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return w.newest_rank(events, ["user_id"], "ts", ["event_id"]).select("event_id", "user_id", "newest_rank")


@query(
    """
SELECT call_number, count(*) AS n, count(DISTINCT st) AS n_times, min(event_id) AS first_id FROM (
  SELECT event_id, date_trunc('hour', ts) AS st,
         count(CASE WHEN event_type = 'error' THEN 1 END) OVER (ORDER BY date_trunc('hour', ts)) AS call_number
  FROM events) GROUP BY call_number
"""
)
def marker_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions on hourly times: nearly every row is tied with others."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("st")
    )
    numbered = w.marker_sessions(events, F.col("event_type") == "error", "st", ["event_id"])
    return numbered.groupBy("call_number").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("st").alias("n_times"),
        F.min("event_id").alias("first_id"),
    )
