"""Running, filled and numbered columns on globally ordered rows.

Every function takes a frame and returns it with one more column. The work is
cut into slots (see ``slots``), so neither a global order nor a hot key ends
up in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.seeded import bernoulli, hash_uniform
from millrace.operators.slots import SLOT, Carry, SlotPlan, in_slot, plan_slots, with_carries


def marker_sessions(
    df: DataFrame,
    marker: Column,
    order: str,
    tie: Sequence[str] = (),
    out: str = "call_number",
    rows_per_slot: int | None = None,
) -> DataFrame:
    """Number each row by the markers seen up to its ``order`` value.

    Rows with equal ``order`` share a number, as a RANGE frame gives them. A
    null ``order`` is refused: such rows have no place. ``tie`` columns only help to cut a hot ``order`` value into slots.
    """
    known = F.when(F.col(order).isNull(), F.raise_error(F.lit(f"{order} is null")).cast(df.schema[order].dataType))
    work = df.withColumns({"__mark": F.coalesce(marker, F.lit(False)), order: known.otherwise(F.col(order))})
    plan = plan_slots(work, [order, *tie], rows_per_slot=rows_per_slot)
    slotted = work.withColumn(SLOT, plan.slot())
    mark = F.col("__mark")
    local = F.count(F.when(mark, 1)).over(
        Window.partitionBy(SLOT).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if not plan.cuts:
        return slotted.withColumn(out, local).drop(SLOT, "__mark")

    # rows that are no marker fall into one group per slot here
    edges = (
        slotted.groupBy(SLOT, F.when(mark, F.col(order)).alias("__at"))
        .agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count_if(mark).alias("n"))
        .groupBy(SLOT)
        .agg(
            F.min("lo").alias("__lo"),
            F.max("hi").alias("__hi"),
            F.sum("n").alias("__n"),
            F.min("__at").alias("__first_at"),
            F.min_by("n", "__at").alias("__first_n"),
        )
        .withColumn("__head", F.when(F.col("__first_at") == F.col("__lo"), F.col("__first_n")).otherwise(0))
    )
    # a tie may run on into later slots: add the markers it holds there. Those
    # slots all start with the tied value and follow without a gap.
    along = Window.orderBy(SLOT)
    same_lo = Window.partitionBy("__lo")
    so_far = F.sum("__head").over(same_lo.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0))
    folded = edges.withColumns(
        {
            "__base": F.coalesce(
                F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")
            ),
            "__tied": F.sum("__head").over(same_lo),
            "__left": F.sum("__head").over(same_lo) - so_far,
        }
    )
    following = F.lead(F.struct("__lo", "__tied")).over(along)
    table = folded.select(
        SLOT,
        "__base",
        "__hi",
        F.when(F.col("__lo") == F.col("__hi"), F.col("__left"))
        .when(following["__lo"] == F.col("__hi"), following["__tied"])
        .otherwise(0)
        .alias("__more"),
    )
    more = F.when(F.col(order) == F.col("__hi"), F.col("__more")).otherwise(0)
    return (
        slotted.join(F.broadcast(table), SLOT, "left")
        .withColumn(out, F.col("__base") + local + more)
        .drop(SLOT, "__mark", "__base", "__hi", "__more")
    )


@dataclass(frozen=True)
class Running:
    """One running column: what it carries between slots, and its value."""

    out: str
    carries: tuple[Carry, ...]
    value: Callable[[Sequence[str], Sequence[str]], Column]
    inputs: dict[str, Column] = field(default_factory=dict)


def sum_of(col: str, kind: T.DataType, start: Column | int | Decimal = 0, out: str = "running_sum") -> Running:
    """``start`` plus the sum of ``col`` (of type ``kind``) so far; null counts as 0."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        raise TypeError(f"{col}: cast to a decimal or integer first; a sum of doubles depends on the grouping")
    value, carried = f"__v_{out}", f"__c_{out}"
    zero = F.lit(0).cast(kind)
    begin = start if isinstance(start, Column) else F.lit(start)

    def total(by, order):
        return begin + F.sum(value).over(in_slot(by, order)) + F.coalesce(F.col(carried), zero)

    return Running(out, (Carry(carried, F.sum(value), "sum"),), total, {value: F.coalesce(F.col(col), zero)})


def number_from(start: int = 1, out: str = "seq") -> Running:
    """``start``, ``start + 1``, ... without gaps."""
    carried = f"__c_{out}"

    def number(by, order):
        place = F.row_number().over(Window.partitionBy(SLOT, *by).orderBy(*order))
        return F.coalesce(F.col(carried), F.lit(0)) + place + F.lit(start - 1).cast("bigint")

    return Running(out, (Carry(carried, F.count(F.lit(1)), "sum"),), number)


def filled(col: str, order: Sequence[str], fill_head: bool = True, out: str | None = None) -> Running:
    """The last known value; before the first one, the first one."""
    out = out or f"{col}_filled"
    past, ahead = f"__p_{out}", f"__a_{out}"
    known = F.when(F.col(col).isNotNull(), F.struct(*order))
    carries = [Carry(past, F.max_by(col, known), "last")]
    if fill_head:
        carries.append(Carry(ahead, F.min_by(col, known), "next"))

    def value(by, order):
        parts = [F.last(col, ignorenulls=True).over(in_slot(by, order)), F.col(past)]
        if fill_head:
            whole = in_slot(by, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            parts += [F.first(col, ignorenulls=True).over(whole), F.col(ahead)]
        return F.coalesce(*parts)

    return Running(out, tuple(carries), value)


def add_running(
    df: DataFrame,
    columns: Sequence[Running],
    order: Sequence[str],
    by: Sequence[str] = (),
    rows_per_slot: int | None = None,
    plan: SlotPlan | None = None,
) -> DataFrame:
    """Add several running columns over one order: one carry table, one shuffle."""
    plan = plan or plan_slots(df, order, by, rows_per_slot)
    inputs = {name: c for column in columns for name, c in column.inputs.items()}
    carries = [carry for column in columns for carry in column.carries]
    work = with_carries(df.withColumns(inputs), plan, by, carries)
    out = work.withColumns({column.out: column.value(by, order) for column in columns})
    return out.drop(SLOT, *inputs, *[carry.name for carry in carries])


def running_sum(
    df: DataFrame,
    col: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    start: Column | int | Decimal = 0,
    out: str = "running_sum",
    rows_per_slot: int | None = None,
    plan: SlotPlan | None = None,
) -> DataFrame:
    """``start`` plus the sum of ``col`` over the rows so far; null counts as 0.

    Give an integer or decimal column where the sum must be exact: a sum of
    doubles depends on how rows are grouped.
    """
    column = sum_of(col, df.schema[col].dataType, start, out)
    return add_running(df, [column], order, by, rows_per_slot, plan)


def dense_sequence(
    df: DataFrame,
    order: Sequence[str],
    start: int = 1,
    by: Sequence[str] = (),
    out: str = "seq",
    rows_per_slot: int | None = None,
    plan: SlotPlan | None = None,
) -> DataFrame:
    """Number rows ``start``, ``start + 1``, ... without gaps, per ``by`` group."""
    return add_running(df, [number_from(start, out)], order, by, rows_per_slot, plan)


def newest_rank(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    tie: Sequence[str] = (),
    out: str = "newest_rank",
    rows_per_slot: int | None = None,
) -> DataFrame:
    """Rank 1 for the newest row of each group. Equal times follow ``tie``."""
    age = -F.unix_micros(F.col(ts).cast("timestamp"))
    ranked = dense_sequence(
        df.withColumn("__age", age), ["__age", *tie], by=by, out=out, rows_per_slot=rows_per_slot
    )
    return ranked.drop("__age")


def forward_fill(
    df: DataFrame,
    col: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    fill_head: bool = True,
    out: str | None = None,
    rows_per_slot: int | None = None,
    plan: SlotPlan | None = None,
) -> DataFrame:
    """Repeat the last known value; before the first one, use the first one."""
    return add_running(df, [filled(col, order, fill_head, out)], order, by, rows_per_slot, plan)


def signed_walk(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str],
    start: Decimal | str,
    step: Decimal | str,
    p: float,
    seed: str = "walk",
    out: str = "walk",
    rows_per_slot: int | None = None,
) -> DataFrame:
    """A walk from ``start`` that goes up by ``step`` with chance ``p``, else down.

    The first row sits at ``start``. The sign hangs on the row's ``key``, so the
    walk is the same on every run. Steps are counted as integers: exact.
    """
    if not 0 <= p <= 1:
        raise ValueError("p must lie between 0 and 1")
    sign = F.when(bernoulli(hash_uniform(seed, *key), p), 1).otherwise(-1).cast("bigint")
    plan = plan_slots(df, order, rows_per_slot=rows_per_slot)
    work = running_sum(df.withColumn("__sign", sign), "__sign", order, out="__steps", plan=plan)
    first = df.agg(F.min_by(sign, F.struct(*order)).alias("s")).scalar()
    path = F.lit(Decimal(str(start))) + (F.col("__steps") - first) * F.lit(Decimal(str(step)))
    return work.withColumn(out, path).drop("__sign", "__steps")
