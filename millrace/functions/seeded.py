"""Seeded draws as column expressions.

A draw is a function of a seed and the row's key, never of the partition or of
a generator's state, so a lost task gives the same rows again and any engine
with md5 can repeat the numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIRECTIONS = (-1, 0, 1)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hash_token(seed: str, *keys: Column | str, length: int = 32) -> Column:
    """The first ``length`` hex digits of md5(seed|key|key...)."""
    text = F.concat_ws("|", F.lit(seed), *[_col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, length)


def hash_uniform(seed: str, *keys: Column | str) -> Column:
    """A double in [0, 1) from the first 32 bits of md5(seed|key...)."""
    return F.conv(hash_token(seed, *keys, length=8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform_int(u: Column, low: int, high: int) -> Column:
    """A whole number in [low, high)."""
    if high <= low:
        raise ValueError("high must be above low")
    return (F.lit(low) + F.floor(u * F.lit(high - low))).cast("bigint")


def weighted_choice(u: Column, values: Sequence, weights: Sequence[int]) -> Column:
    """Pick one of ``values``; ``u`` falls into the running share of the weights."""
    if len(values) != len(weights) or not values:
        raise ValueError("values and weights must pair up")
    if any(w < 0 for w in weights) or not sum(weights):
        raise ValueError("weights must be >= 0 and not all zero")
    total, reached, choice = sum(weights), 0, None
    for value, weight in list(zip(values, weights))[:-1]:
        reached += weight
        hit = u * F.lit(float(total)) < F.lit(float(reached))
        choice = F.when(hit, F.lit(value)) if choice is None else choice.when(hit, F.lit(value))
    return F.lit(values[-1]) if choice is None else choice.otherwise(F.lit(values[-1]))


def bernoulli(u: Column, p: float) -> Column:
    """True with chance ``p``."""
    if not 0 <= p <= 1:
        raise ValueError("p must lie between 0 and 1")
    return u < F.lit(p)


def jitter(
    col: Column | str,
    u: Column,
    direction: int = 0,
    volatility: float = 0.01,
    relative: bool = True,
    discrete: bool = False,
) -> Column:
    """Shift a number by a draw from [-v, v], [0, v) or (-v, 0], by ``direction``.

    ``relative`` scales the value by 1 + draw, otherwise the draw is added.
    ``discrete`` rounds the draw to a whole number (half to even).
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    v = F.lit(float(volatility))
    draw = {0: (u * F.lit(2.0) - F.lit(1.0)) * v, 1: u * v, -1: -(u * v)}[direction]
    if discrete:
        draw = F.rint(draw).cast("bigint")
    return _col(col) * (F.lit(1) + draw) if relative else _col(col) + draw


def jitter_time(
    ts: Column | str, u: Column, direction: int = 0, micros: float = 1_000_000, kind: T.DataType | None = None
) -> Column:
    """Shift a timestamp by up to ``micros`` microseconds, in whole microseconds."""
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    span = F.lit(float(micros))
    draw = {0: (u * F.lit(2.0) - F.lit(1.0)) * span, 1: u * span, -1: -(u * span)}[direction]
    shifted = F.timestamp_add("MICROSECOND", F.rint(draw).cast("bigint"), _col(ts))
    return shifted.cast(kind) if kind else shifted
