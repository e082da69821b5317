"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 50_000
HOT_COPIES = 16


_KEPT: dict[str, tuple] = {}


def kept(kind: str, key: object, make: Callable[[], object]) -> object:
    """A Python worker's heavy helper (an encoder, a scanner), made once for many tasks.

    Workers outlive stages, so a worker keeps one helper at a time: making another one
    lets go of what an earlier stage needed.
    """
    if kind not in _KEPT or _KEPT[kind][0] != key:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _KEPT[kind] = key, make()
    return _KEPT[kind][1]


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the data set, narrowed to the columns asked for."""
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return scan.select(*columns) if columns else scan


def whole(text: str | Column) -> Column:
    """The text, empty where it is missing."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def add_columns(rows: DataFrame, table: DataFrame, key: str, salt: str | None) -> DataFrame:
    """Left-join a table with one row per ``key`` onto rows among which keys may be hot.

    A table counted to be small is broadcast; a larger one is copied ``HOT_COPIES``
    times and the rows of each key are dealt among the copies by ``salt``. No
    ``salt``: no key is hot.
    """
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), key, "left")
    if salt is None:
        return rows.join(table, key, "left")
    copies = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(HOT_COPIES - 1))))
    dealt = rows.withColumn("_copy", F.pmod(F.xxhash64(salt), F.lit(HOT_COPIES)).cast("int"))
    return dealt.join(copies, [key, "_copy"], "left").drop("_copy")
