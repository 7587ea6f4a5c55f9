"""Cutting an ordered table where a buffer that restarts at each cut fills up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import add_running, forward_fill, number_from, sum_of
from millrace.storage import land


def _next_starts(laid: DataFrame, limit: int, rows_per_slot: int | None) -> DataFrame:
    """(row, to): a buffer that starts at ``row`` is cut so that the next starts at ``to``.

    The cut falls at the first row whose end is at or past start + limit: ends and
    wanted ends are laid out together from the highest down, and each wanted end takes the
    last row end above it.
    """
    ends = laid.select((-F.col("__end")).alias("down"), F.lit(0).alias("kind"), (-F.col("__row")).alias("tie"), F.col("__row").alias("hit"))
    wanted = laid.select(
        (F.col("__size") - F.col("__end") - limit).alias("down"), F.lit(1).alias("kind"), F.col("__row").alias("tie"), F.lit(None).cast("bigint").alias("hit")
    )
    met = forward_fill(ends.unionByName(wanted), "hit", ["down", "kind", "tie"], fill_head=False, out="cut", rows_per_slot=rows_per_slot)
    return met.filter("kind = 1 AND cut IS NOT NULL").select(F.col("tie").alias("row"), (F.col("cut") + 1).alias("to"))


def number_by_restart(
    df: DataFrame,
    size: str,
    order: Sequence[str],
    limit: int,
    out: str = "file_no",
    rows_per_slot: int | None = None,
) -> DataFrame:
    """Number (from 1) the buffer each row goes to: rows are added in ``order``
    until their sizes sum to ``limit`` or more; the row that reaches it is the
    buffer's last, and the next row starts an empty one.

    ``size`` is an integer column of values from 0 up; null counts as 0. Rows that
    tie in ``order`` follow each other in any order. An empty table stays empty.

    Where a buffer starts hangs on where the one before it ended, so the rule looks
    sequential. Instead each row gets the start that would follow if a buffer
    started there; links of 1, 2, 4, ... cuts come from joining links with links; and
    the real starts are found from the longest links down, each round doubling how many
    are known. Rounds grow with the logarithm of the number of buffers.
    """
    if limit <= 0:
        raise ValueError("limit must be above 0")
    sized = df.withColumn("__size", F.coalesce(F.col(size).cast("bigint"), F.lit(0)))
    running = [sum_of("__size", sized.schema["__size"].dataType, out="__end"), number_from(1, out="__row")]
    laid = land(add_running(sized, running, order, rows_per_slot=rows_per_slot), "laid")
    links = [land(_next_starts(laid.select("__row", "__size", "__end"), limit, rows_per_slot), "links")]
    while not links[-1].filter("row = 1").isEmpty():
        far = links[-1].select(F.col("row").alias("to"), F.col("to").alias("__far"))
        links.append(land(links[-1].join(far, "to").select("row", F.col("__far").alias("to")), "links"))
    starts = df.sparkSession.range(1, 2).select(F.col("id").alias("row"), F.lit(1).cast("bigint").alias("no"))
    for power in range(len(links) - 2, -1, -1):
        onward = starts.join(links[power], "row").select(F.col("to").alias("row"), (F.col("no") + (1 << power)).alias("no"))
        starts = land(starts.unionByName(onward), "starts")
    begun = laid.join(starts.select(F.col("row").alias("__row"), F.col("no").alias("__no")), "__row", "left")
    numbered = forward_fill(begun, "__no", ["__row"], fill_head=False, out=out, rows_per_slot=rows_per_slot)
    return numbered.drop("__size", "__end", "__row", "__no")
