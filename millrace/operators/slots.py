"""Running aggregates over one global order, without a single-task window.

``Window.orderBy(...)`` with no partition sends every row to one task, and
``Window.partitionBy(user)`` does the same to a user who owns a third of the
rows. Here the key space (``by`` columns, then ``order`` columns) is cut into
*slots* of about equal row count:

1. sample the keys and let Spark's range partitioner cut the sample; the lower
   bound of each range is kept, at most ``MAX_SLOTS`` of them;
2. aggregate per slot, which gives one row per slot: the carry table;
3. fold the carry table along the slot order and broadcast it (its size is
   bounded by the slot count, not by the data);
4. run an ordinary window inside each slot and add the carried value.

A hot user, a hot day or a hot timestamp is cut like anything else, because the
cut looks at the whole key. ``by + order`` should identify a row; rows that
share a whole key always land in the same slot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT = "__slot"
ROWS_PER_SLOT = 2_000_000
FEWEST_ROWS = 1_000
MAX_SLOTS = 10_000
SAMPLES_PER_SLOT = 60
SAMPLE_SEED = 20_011


@dataclass(frozen=True)
class SlotPlan:
    """Cut points of a key space; ``bounds`` is a SQL array of key structs."""

    keys: tuple[str, ...]
    bounds: str | None
    cuts: int

    @property
    def slots(self) -> int:
        return self.cuts + 1

    def slot(self) -> Column:
        """Slot number of a row: how many cut points are at or below its key.

        A binary search over a constant array, so a row costs log2(slots)
        comparisons and no shuffle or join.
        """
        if not self.cuts:
            return F.lit(0)
        steps = ",".join(str(1 << b) for b in reversed(range(self.cuts.bit_length())))
        key = _key_struct(self.keys)
        return F.expr(
            f"aggregate(array({steps}), 0, (pos, step) -> "
            f"CASE WHEN get({self.bounds}, pos + step - 1) <= {key} THEN pos + step ELSE pos END)"
        )


def _key_struct(keys: Sequence[str]) -> str:
    fields = ", ".join(f"'k{i}', `{name}`" for i, name in enumerate(keys))
    return f"named_struct({fields})"


def _literal(value: str | None, type_name: str) -> str:
    if value is None:
        return f"CAST(NULL AS {type_name})"
    hexed = value.encode("utf-8").hex()
    return f"CAST(decode(X'{hexed}', 'UTF-8') AS {type_name})"


def plan_slots(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    rows_per_slot: int | None = None,
    max_slots: int = MAX_SLOTS,
) -> SlotPlan:
    """Choose cut points for ``df`` ordered by ``by`` then ``order``.

    Reads the key columns only. The driver receives the cut points and nothing
    else. Without ``rows_per_slot`` there are two slots per core, of at least
    ``FEWEST_ROWS`` and at most ``ROWS_PER_SLOT`` rows.
    """
    keys = (*by, *order)
    only_keys = df.select(*keys)
    rows = only_keys.count()
    if not rows_per_slot:
        per_core = math.ceil(rows / (2 * df.sparkSession.sparkContext.defaultParallelism))
        rows_per_slot = min(ROWS_PER_SLOT, max(FEWEST_ROWS, per_core))
    slots = min(max_slots, math.ceil(rows / rows_per_slot))
    if slots <= 1:
        return SlotPlan(keys, None, 0)
    sample = only_keys
    fraction = slots * SAMPLES_PER_SLOT / rows
    if fraction < 0.5:
        sample = only_keys.sample(fraction, seed=SAMPLE_SEED)
    types = [field.dataType.simpleString() for field in only_keys.schema]
    cut_rows = (
        sample.repartitionByRange(slots, *keys)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(F.expr(_key_struct(keys))).alias("low"))
        .select("low", *[F.col(f"low.k{i}").cast("string").alias(f"t{i}") for i in range(len(keys))])
        .distinct()
        .orderBy("low")
        .drop("low")
        .collect()
    )
    structs = [
        "named_struct("
        + ", ".join(f"'k{i}', {_literal(value, kind)}" for i, (value, kind) in enumerate(zip(row, types)))
        + ")"
        for row in cut_rows[1:]
    ]
    if not structs:
        return SlotPlan(keys, None, 0)
    return SlotPlan(keys, f"array({', '.join(structs)})", len(structs))


@dataclass(frozen=True)
class Carry:
    """A value handed from slot to slot.

    ``tail`` aggregates the rows of one (slot, by) group. ``fold`` says how the
    tails of earlier slots with the same ``by`` value combine: ``sum``, or
    ``last`` (the last non-null). ``next`` looks the other way and takes the
    first non-null of the later slots.
    """

    name: str
    tail: Column
    fold: str


def with_carries(df: DataFrame, plan: SlotPlan, by: Sequence[str], carries: Sequence[Carry]) -> DataFrame:
    """Add ``SLOT`` and one column per carry, null where nothing is carried in."""
    slotted = df.withColumn(SLOT, plan.slot())
    if not plan.cuts:
        # one slot has no neighbours: every carry is null
        types = df.agg(*[c.tail.alias(c.name) for c in carries]).schema
        return slotted.withColumns({c.name: F.lit(None).cast(types[c.name].dataType) for c in carries})

    group = F.struct(*by) if by else F.lit(0)
    values = F.struct(*[c.name for c in carries])
    edges = (
        slotted.groupBy(SLOT, *by)
        .agg(*[c.tail.alias(c.name) for c in carries])
        .groupBy(SLOT)
        .agg(
            F.min(group).alias("__first"),
            F.max(group).alias("__last"),
            F.min_by(values, group).alias("__head"),
            F.max_by(values, group).alias("__tail"),
        )
    )
    along = Window.orderBy(SLOT)
    same_last = Window.partitionBy("__last").orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0)
    same_first = Window.partitionBy("__first").orderBy(F.col(SLOT).desc()).rowsBetween(Window.unboundedPreceding, 0)

    folded, carried = {}, []
    for c in carries:
        if c.fold == "next":
            folded[f"__run_{c.name}"] = F.last(F.col(f"__head.{c.name}"), ignorenulls=True).over(same_first)
            near = F.lead(F.struct("__first", f"__run_{c.name}")).over(along)
            arrives = near["__first"].eqNullSafe(F.col("__last"))
        else:
            tail = F.col(f"__tail.{c.name}")
            folded[f"__run_{c.name}"] = (
                F.sum(tail) if c.fold == "sum" else F.last(tail, ignorenulls=True)
            ).over(same_last)
            near = F.lag(F.struct("__last", f"__run_{c.name}")).over(along)
            arrives = near["__last"].eqNullSafe(F.col("__first"))
        carried.append(F.when(arrives, near[f"__run_{c.name}"]).alias(c.name))
    table = edges.withColumns(folded).select(SLOT, "__first", "__last", *carried)

    joined = slotted.join(F.broadcast(table), SLOT, "left")
    out = {}
    for c in carries:
        edge = "__last" if c.fold == "next" else "__first"
        out[c.name] = F.when(group.eqNullSafe(F.col(edge)), F.col(c.name)) if by else F.col(c.name)
    return joined.withColumns(out).drop("__first", "__last")


def in_slot(by: Sequence[str], order: Sequence[str]):
    """Rows so far, inside the slot and the ``by`` group."""
    return (
        Window.partitionBy(SLOT, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
