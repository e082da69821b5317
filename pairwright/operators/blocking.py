"""Blocking: which records may be compared with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..session import materialize
from .keys import baseline_key
from .tiles import TILE_ROWS, spread


def block_of(keys: Sequence[str]) -> Column:
    """The block as one struct column. Rows whose keys are all missing share a block."""
    return F.struct(*keys)


def block_sizes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per block, and the number of record pairs an exhaustive comparison would visit."""
    n = F.col("block_rows")
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("block_rows"))
        .withColumn("candidate_pairs", (n * (n - 1) / 2).cast("long"))
    )


def with_block_facts(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records of a table bucketed by ``block_id`` with ``block_rows`` and ``first_id`` of their block.

    Both the grouping and the join find the rows where they are.
    """
    own = F.struct(*keys)
    facts = blocks.groupBy("block_id", own.alias("own")).agg(F.count(F.lit(1)).alias("block_rows"), F.min("id").alias("first_id"))
    # One entry per block of the same hash, nearly always a single one, so that block_id alone joins.
    listed = facts.groupBy("block_id").agg(F.collect_list(F.struct("own", "block_rows", "first_id")).alias("facts"))
    fact = F.get(F.filter("facts", lambda f: f["own"].eqNullSafe(own)), F.lit(0))
    joined = blocks.hint("merge").join(listed.hint("merge"), "block_id")
    return joined.select("id", *keys, fact["block_rows"].alias("block_rows"), fact["first_id"].alias("first_id"))


def block_pairs(rows: DataFrame, keys: Sequence[str], tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every unordered pair of ids inside each block, ``lid < rid``.

    The output is quadratic in block size by definition. Matching does not use
    it; see :mod:`.matching` for the pruned join.
    """
    slim = rows.select(block_of(keys).alias("key"), "id")
    left, right = spread(slim, slim, "key", "id", tile_rows)
    return (
        left.withColumnRenamed("id", "lid")
        .join(right.withColumnRenamed("id", "rid"), ["key", "left_tile", "right_tile"])
        .where(F.col("lid") < F.col("rid"))
        .select("lid", "rid")
    )


def adaptive_blocks(
    rows: DataFrame, keys: Sequence[str], max_rows: int = fixed.ADAPTIVE_BLOCK_ROWS
) -> DataFrame:
    """Refine only oversized blocks by one more key, until they fit or keys run out.

    Adds ``block_level`` (how many keys count) and ``block`` (those keys; the
    others are null). All prefix sizes come from one count per full key, so the
    rows themselves are shuffled once, to meet their level. They are read twice:
    hand in a written table when computing the keys is costly.
    """
    full = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    levels = full.select(F.struct(*keys).alias("full_key"), *keys, "n")
    for depth in range(1, len(keys)):
        prefix = F.struct(*keys[:depth])
        sizes = levels.groupBy(prefix.alias("prefix")).agg(F.sum("n").alias(f"n{depth}"))
        levels = levels.withColumn("prefix", prefix).join(sizes, "prefix").drop("prefix")
    level = F.coalesce(
        *[F.when(F.col(f"n{d}") <= max_rows, F.lit(d)) for d in range(1, len(keys))], F.lit(len(keys))
    )
    chosen = levels.select("full_key", level.alias("block_level"))
    block = F.struct(
        F.col("block_level").alias("level"),
        *[F.when(F.col("block_level") > i, F.col(k)).alias(k) for i, k in enumerate(keys)],
    )
    return (
        rows.withColumn("full_key", F.struct(*keys))
        .join(chosen, "full_key")
        .withColumn("block", block)
        .drop("full_key")
    )


def baseline_blocks(products: DataFrame, text: str) -> DataFrame:
    """Products with a baseline key, as ``block_key`` beside the row."""
    return products.withColumn("block_key", baseline_key(F.col(text))).where(F.col("block_key") != "")
