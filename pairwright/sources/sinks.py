"""Writing tables and results. Settings go beside the data, not into it."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.evaluate import enrich_pairs


def write_table(df: DataFrame, path: str, settings: dict | None = None, file_format: str = "csv") -> None:
    """Write a table (CSV with header, or another format) and its settings beside it."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(file_format).save(path)
    if settings is not None:
        line = [(json.dumps(settings, sort_keys=True),)]
        note = df.sparkSession.createDataFrame(line, "value string")
        note.coalesce(1).write.mode("overwrite").text(path.rstrip("/") + ".meta")


def write_blocks(df: DataFrame, keys: Sequence[str], path: str, settings: dict | None = None) -> None:
    """Write a blocked table with each block's rows next to each other.

    Rows are range-partitioned by key and id, so a huge block simply takes
    several files.
    """
    ordered = df.repartitionByRange(*keys, "id").sortWithinPartitions(*keys, "id")
    write_table(ordered, path, settings)


def write_pairs(pairs: DataFrame, path: str, read_limit: int | None, dataset: object) -> None:
    """Write result pairs with the settings they were computed with. No pairs: header only."""
    write_table(pairs.select("lid", "rid"), path, {"read_limit": read_limit, "dataset": dataset})


def write_evaluation(outcomes: DataFrame, products: DataFrame, path: str) -> None:
    """Write classified pairs with their products, one folder per outcome.

    Known pairs are the true positives and false negatives together; reported
    pairs are the true and false positives.
    """
    enrich_pairs(outcomes, products).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).partitionBy("outcome").csv(path)


def write_outcome(pairs: DataFrame, outcome: str, path: str) -> None:
    """Replace one outcome's folder of a table partitioned by outcome; the others stay as they are."""
    rows = pairs.withColumn("outcome", F.lit(outcome))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("outcome").parquet(path)


def write_bucketed_blocks(df: DataFrame, keys: Sequence[str], table: str, path: str, buckets: int) -> DataFrame:
    """Write blocked records as a bucketed table and return it, with ``block_id`` for the block.

    Whatever groups or joins by ``block_id`` afterwards finds its rows together and moves
    none. The hash that names a block takes missing keys like any other value; rows of
    different blocks that share it are told apart by the keys themselves.
    """
    named = df.withColumn("block_id", F.xxhash64(*[F.struct(k) for k in keys]))
    writer = named.repartition(buckets, "block_id").write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "block_id").sortBy("block_id").saveAsTable(table)
    return df.sparkSession.table(table)
