"""Running values over an ordered sequence without one task per sequence.

A plain ``Window.partitionBy(path).orderBy(line_no)`` puts a whole file into one task, so a file that
holds a third of the rows stops the job. Here every sequence comes cut into blocks (a file split, or a
fixed range of line numbers), and a running value is computed in two phases:

1. inside each block, a window over ``(sequence, block)``;
2. over one summary row per block, a window over the sequence gives what each block inherits.

Both meet in an equi-join on ``(sequence, block)``, the partitioning the first window already has, so the
rows are shuffled once and no group is larger than a block. The summaries are aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderline.session import stage

ROWS_PER_BLOCK = 1 << 16


@dataclass(frozen=True)
class Running:
    """One running value: ``how`` is ``sum`` or ``last`` (the last non-NULL value).

    ``inclusive`` decides whether a row sees itself; ``backward`` runs from the end of the sequence, so a
    backward ``last`` is the first following value.
    """

    how: str
    value: Column
    inclusive: bool = True
    backward: bool = False


def with_blocks(lines: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, position: str = "line_no") -> DataFrame:
    """Cut sequences with (nearly) dense positions into blocks of positions."""
    return lines.withColumn("block", F.expr(f"`{position}` div {rows_per_block}"))


def block_offsets(counts: DataFrame, block: str, value: str = "n") -> DataFrame:
    """``(block, before)``: the sum of ``value`` over all earlier blocks of one long sequence.

    A tree of two levels: blocks are dealt to ranges of blocks, as many as Spark shuffles to, and summed up within their
    range; the ranges' own sums, one row each, are added up on the driver. So no task sees more than a range, and the
    counts may be many."""
    spark = counts.sparkSession
    ranges = stage(counts.repartitionByRange(block).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = sorted(map(tuple, ranges.groupBy("__range").agg(F.sum(value)).collect()))
    starts, total = [], 0
    for number, size in sums:
        starts.append((number, total))
        total += size
    above = spark.createDataFrame(starts, "`__range` int, `__above` bigint")
    earlier = Window.partitionBy("__range").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    within = ranges.withColumn("__within", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    return within.join(F.broadcast(above), "__range").select(block, (F.col("__within") + F.col("__above")).alias("before"))


def running(
    rows: DataFrame,
    sequence: list[str],
    order: str,
    values: dict[str, Running],
    block: str = "block",
    blocks: DataFrame | None = None,
    facts: tuple[str, ...] = (),
    setters: Column | None = None,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``rows`` with one extra column per entry of ``values``.

    Order inside a sequence is ``(block, order)``; sequence and block columns must not be NULL. ``rows`` is read again for the summaries; stage it
    first when what lies behind it is expensive. A known list of ``blocks`` (sequence and block columns)
    saves finding it; its columns named in ``facts`` reach every row of the block on the same join,
    and a column ``__sum_<name>`` is taken as the block's total of a ``sum``.
    ``setters`` may name a cheap condition that holds for every row with a value for some ``last``.
    ``deal`` may spread the rows to be put in order by sequence and block itself.
    """
    keys = [*sequence, block]
    held = {name: f"__held_{name}" for name in values}
    prepared = rows.select("*", *[_held(v).alias(held[name]) for name, v in values.items()])

    within = (deal(prepared) if deal else prepared).select(
        "*", *[_within(v, held[name], keys, order).alias(f"__in_{name}") for name, v in values.items()]
    )
    totals = [f"__sum_{n}" for n, v in values.items() if v.how == "sum"]
    if blocks is not None:
        totals = [t for t in totals if t in blocks.columns]
    known = blocks.select(*keys, *facts, *totals) if blocks is not None else None
    summary = _summaries(prepared, keys, order, values, held, known, setters)
    inherited = summary.select(
        *keys, *facts, *[_across(v, name, sequence, block).alias(f"__from_{name}") for name, v in values.items()]
    )
    joined = within.join(inherited, keys, "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        *facts,
        *[_total(v, name).alias(name) for name, v in values.items()],
    )


def _held(v: Running) -> Column:
    """Values of a ``last`` travel in a struct, so that "nothing yet" differs from a NULL field."""
    return v.value if v.how == "sum" else F.when(v.value.isNotNull(), F.struct(v.value.alias("v")))


def _within(v: Running, held: str, keys: list[str], order: str) -> Column:
    ordering = F.col(order).desc() if v.backward else F.col(order).asc()
    window = Window.partitionBy(*keys).orderBy(ordering)
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow if v.inclusive else -1)
    return F.sum(held).over(frame) if v.how == "sum" else F.last(held, ignorenulls=True).over(frame)


def _summaries(
    rows: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, Running],
    held: dict[str, str],
    known: DataFrame | None,
    setters: Column | None,
) -> DataFrame:
    """One row per block. Sums and the block list hash-aggregate over all rows; the last values, whose
    aggregation has to sort, see only the rows that set one."""
    sums = [F.sum(held[n]).alias(f"__sum_{n}") for n, v in values.items() if v.how == "sum"]
    lasts = {n: v for n, v in values.items() if v.how == "last"}
    if known is not None and all(f"__sum_{n}" in known.columns for n, v in values.items() if v.how == "sum"):
        blocks = known
    else:
        blocks = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *sums)
    if not lasts:
        return blocks
    condition = setters if setters is not None else _any_of([F.col(held[n]).isNotNull() for n in lasts])
    at = {n: F.when(F.col(held[n]).isNotNull(), F.col(order)) for n in lasts}
    ends = rows.filter(condition).groupBy(*keys).agg(
        *[
            (F.min_by if v.backward else F.max_by)(F.col(held[n]), at[n]).alias(f"__sum_{n}")
            for n, v in lasts.items()
        ]
    )
    return blocks.join(ends, keys, "left")


def _across(v: Running, name: str, sequence: list[str], block: str) -> Column:
    ordering = F.col(block).desc() if v.backward else F.col(block).asc()
    window = Window.partitionBy(*sequence).orderBy(ordering).rowsBetween(Window.unboundedPreceding, -1)
    summary = F.col(f"__sum_{name}")
    return F.sum(summary).over(window) if v.how == "sum" else F.last(summary, ignorenulls=True).over(window)


def _total(v: Running, name: str) -> Column:
    inside, inherited = F.col(f"__in_{name}"), F.col(f"__from_{name}")
    if v.how == "sum":
        zero = F.lit(0)
        return F.coalesce(inside, zero) + F.coalesce(inherited, zero)
    return F.coalesce(inside, inherited)["v"]


def _any_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result
