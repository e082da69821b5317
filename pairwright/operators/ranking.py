"""Positions and running sums in a global order, without sorting anything in one task.

Rows are dealt to ranges of the order and written with the number of their range. What
comes before a range is a sum over the ranges before it, a table of one row per range (and
group); what comes before a row inside its range is a window over that range alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

_RANGE = "_range"


def _ranged(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    return materialize(rows.repartitionByRange(*order).withColumn(_RANGE, F.spark_partition_id()))


def with_rank(rows: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the row's position, from 1, in an order that leaves no two rows equal."""
    ranged = _ranged(rows, order)
    # One row per range: this window is over a handful of rows.
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n")))
    offsets = sizes.select(_RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(_RANGE).orderBy(*order)
    placed = ranged.withColumn("_place", F.row_number().over(inside))
    return placed.join(F.broadcast(offsets), _RANGE).withColumn(name, F.col("_before") + F.col("_place")).drop(_RANGE, "_before", "_place")


def with_running_sums(rows: DataFrame, group: str, order: Column, sums: Mapping[str, Column]) -> DataFrame:
    """Add sums over all rows of the same ``group`` that come before the row.

    ``order`` must tell the rows of a group apart. A group may hold any share of the
    rows; it then covers several ranges.
    """
    valued = rows.withColumns({f"_{name}": value for name, value in sums.items()})
    ranged = _ranged(valued, [F.col(group), order])
    totals = ranged.groupBy(group, _RANGE).agg(*[F.sum(f"_{name}").alias(f"_t_{name}") for name in sums])
    ranges_before = Window.partitionBy(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(totals).select(
        group, _RANGE, *[F.coalesce(F.sum(f"_t_{name}").over(ranges_before), F.lit(0)).alias(f"_o_{name}") for name in sums]
    )
    rows_before = Window.partitionBy(group, _RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = {f"_i_{name}": F.coalesce(F.sum(f"_{name}").over(rows_before), F.lit(0)) for name in sums}
    joined = ranged.withColumns(inside).join(offsets, [group, _RANGE])
    return joined.select(*rows.columns, *[(F.col(f"_o_{name}") + F.col(f"_i_{name}")).alias(name) for name in sums])
