"""Tick table: typed load, enrichment of trades and quotes, day stacking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.seeded import hash_uniform, jitter, uniform_int, weighted_choice
from millrace.functions.text import token_to_null
from millrace.functions.timetext import from_d_text, to_d_text
from millrace.operators.keys import first_per
from millrace.operators.stacking import stack_days
from millrace.operators.windows import add_running, filled, number_from, sum_of
from millrace.schemas import TICK, TICK_COLUMNS, TICK_TIMES
from millrace.storage import land

# Weights of the price offsets of a quote, and the spreads.
BID_OFFSETS, BID_WEIGHTS = (-2, -1, 0, 1), (60, 120, 180, 6)
ASK_OFFSETS, ASK_WEIGHTS = (0, 1, 2), (9, 6, 3)
OPEN_SPREAD = 0.001
FIRST_FEED_NUMBER = 259_237
SALE_CONDITION_SHARE = 0.08

# columns the rounding load turns into whole numbers
ROUNDED = ("FEEDSEQNUM", "SEQNUM", "PRICE", "VOLUME", "ACCVOLUME", "MARKETVWAP", "OPEN", "HIGH", "LOW")


def load_typed(text: DataFrame, rounding: bool = False, sentinels: Sequence[str] = ("nan",)) -> DataFrame:
    """Text ticks to the typed table.

    Times may be written ``dateDtime``. The default keeps the cents;
    ``rounding`` casts prices and numbers to whole numbers, half away from zero.
    """
    whole = "decimal(38,0)"
    cols = []
    for field in TICK:
        kind = field.dataType.typeName()
        source = token_to_null(field.name, (*sentinels, ""))
        if kind == "date":
            source = F.to_date(source)
        elif kind == "timestamp_ntz":
            source = from_d_text(source)
        elif rounding and field.name in ROUNDED:
            # through a wide decimal, so a half is the half that was written
            source = source.cast("decimal(38,10)").cast(whole)
        elif kind in ("long", "double"):
            source = source.cast(field.dataType)
        cols.append(source.alias(field.name))
    return text.select(*cols)


def to_text(ticks: DataFrame) -> DataFrame:
    """Typed ticks back to text, times as ``dateDtime``."""
    return ticks.select(
        *[(to_d_text(c) if c in TICK_TIMES else F.col(c).cast("string")).alias(c) for c in TICK_COLUMNS]
    )


def stack_ticks(text: DataFrame, n: int = 90) -> DataFrame:
    """Text ticks, ``n`` times, copy k moved by k days in all six date columns."""
    typed = text.withColumns({"DATE": F.to_date("DATE"), **{c: from_d_text(c) for c in TICK_TIMES}})
    moved = stack_days(typed, n, ["DATE", *TICK_TIMES])
    shown = {"DATE": F.date_format("DATE", "yyyy-MM-dd"), **{c: to_d_text(c) for c in TICK_TIMES}}
    return moved.withColumns(shown).select(*TICK_COLUMNS)


def all_null(names: Sequence[str], kind: str = "string") -> list[Column]:
    """Columns that hold nothing, by design."""
    return [F.lit(None).cast(kind).alias(name) for name in names]


def only_where(mask: Column, **values: Column) -> dict[str, Column]:
    """Columns that have a value only where ``mask`` holds."""
    return {name: F.when(mask, value) for name, value in values.items()}


def bid_ask(df: DataFrame, price: str, key: Sequence[str], seed: str = "quote") -> DataFrame:
    """Quote prices and sizes around a filled price."""
    bid = weighted_choice(hash_uniform(f"{seed}-bid", *key), BID_OFFSETS, BID_WEIGHTS)
    ask = weighted_choice(hash_uniform(f"{seed}-ask", *key), ASK_OFFSETS, ASK_WEIGHTS)
    return df.withColumns(
        {
            "bid_price": F.col(price) + bid,
            "bid_size": uniform_int(hash_uniform(f"{seed}-bidsize", *key), 1, 7),
            "ask_price": F.col(price) + ask,
            "ask_size": uniform_int(hash_uniform(f"{seed}-asksize", *key), 1, 7),
        }
    )


def open_high_low(df: DataFrame, open_col: str, day: str, key: Sequence[str], seed: str = "day") -> DataFrame:
    """Jittered open (one draw per day), and a high above and a low below it per row."""
    opened = jitter(open_col, hash_uniform(f"{seed}-open", day), 0, OPEN_SPREAD)
    return df.withColumn("day_open", opened).withColumns(
        {
            "day_high": jitter("day_open", hash_uniform(f"{seed}-high", *key), 1, OPEN_SPREAD),
            "day_low": jitter("day_open", hash_uniform(f"{seed}-low", *key), -1, OPEN_SPREAD),
        }
    )


def enrich(
    df: DataFrame,
    ts: str,
    tie: str,
    price: str,
    volume: str,
    seed: str = "tick",
) -> DataFrame:
    """Accumulated volume, feed number, filled price, bid and ask, and the day's
    open, high and low, over all rows in ``(ts, tie)`` order.

    The three running columns share one set of cut points, one carry table and
    one shuffle. The daily opens are landed and joined.
    """
    order = [ts, tie]
    running = [
        sum_of(volume, df.schema[volume].dataType, out="acc_volume"),
        filled(price, order, out="filled_price"),
        number_from(FIRST_FEED_NUMBER, out="feed_number"),
    ]
    quoted = bid_ask(add_running(df, running, order), "filled_price", [tie], f"{seed}-quote")
    dated = df.select(F.to_date(ts).alias("day"), ts, tie, price)
    opens = land(first_per(dated, price, "day", order, "first_price"), "daily-open")
    days = quoted.withColumn("day", F.to_date(ts)).join(opens, "day", "left")
    return open_high_low(days, "first_price", "day", [tie], f"{seed}-day")
