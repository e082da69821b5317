"""Spreading hot groups over many tasks.

A self-join needs all rows of a group to meet. When one group holds a large part
of the data, no single task may receive it. Its rows are dealt to tiles by a hash
of their id, and each pair of tiles becomes a join key of its own: every row pair
still meets exactly once, and no key holds more than about one tile per side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

TILE_ROWS = 4096
BROADCAST_KEYS = 50_000


def checked_broadcast(table: DataFrame, limit: int = BROADCAST_KEYS) -> DataFrame:
    """Mark a written table for broadcast if a count shows it to be small enough."""
    return F.broadcast(table) if table.count() <= limit else table


def hot_groups(rows: DataFrame, key: str, limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows; None when there are none.

    Counting combines inside each task first, so a hot group costs one row per task.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select(key)
    return None if sizes.isEmpty() else checked_broadcast(materialize(sizes))


def _tiles(size: str, tile_rows: int) -> Column:
    return F.greatest(F.ceil(F.coalesce(F.col(size), F.lit(1)) / tile_rows), F.lit(1)).cast("int")


def unspread(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What :func:`spread` yields when no key is hot: constant tiles, nothing copied."""
    flat = {"left_tile": F.lit(0), "right_tile": F.lit(0)}
    return left.withColumns(flat), right.withColumns(flat)


def spread(
    left: DataFrame, right: DataFrame, key: str, salt: str, tile_rows: int = TILE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Prepare two sides for a join on ``key, left_tile, right_tile``.

    ``key`` is one column (a struct for several parts); struct fields compare
    null-safely, so missing key parts match each other.
    """
    one, none = F.lit(1), F.lit(0)
    sizes = (
        left.select(key, one.alias("on_left"), none.alias("on_right"))
        .unionByName(right.select(key, none.alias("on_left"), one.alias("on_right")))
        .groupBy(key)
        .agg(F.sum("on_left").alias("on_left"), F.sum("on_right").alias("on_right"))
        .where((F.greatest("on_left", "on_right") > tile_rows) & (F.least("on_left", "on_right") > 0))
    )
    if sizes.isEmpty():
        return unspread(left, right)
    sizes = checked_broadcast(materialize(sizes))

    def dealt(rows: DataFrame, own: str, own_size: str, other: str, other_size: str) -> DataFrame:
        tile = F.pmod(F.xxhash64(salt), _tiles(own_size, tile_rows)).cast("int")
        others = F.explode(F.sequence(F.lit(0), _tiles(other_size, tile_rows) - 1))
        sized = rows.join(sizes, key, "left").withColumn(own, tile).withColumn(other, others)
        return sized.drop("on_left", "on_right")

    return (
        dealt(left, "left_tile", "on_left", "right_tile", "on_right"),
        dealt(right, "right_tile", "on_right", "left_tile", "on_left"),
    )
