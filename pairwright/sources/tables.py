"""Reading products, truth pairs and results."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators.evaluate import sorted_pairs
from ..operators.ranking import with_rank

TOP_ROWS = 100_000

UNSTRUCTURED_SCHEMA = StructType([StructField("id", LongType()), StructField("title", StringType())])
STRUCTURED_SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("price", DoubleType()),
        StructField("brand", StringType()),
        StructField("description", StringType()),
        StructField("category", StringType()),
    ]
)
PAIR_SCHEMA = StructType([StructField("lid", LongType()), StructField("rid", LongType())])


def choose(paths: Mapping[object, str], dataset: object) -> str:
    """Path of a dataset variant; unknown variants are an error."""
    if dataset not in paths:
        raise ValueError(f"no path for dataset {dataset!r}, known are {sorted(map(str, paths))}")
    return paths[dataset]


def _csv_reader(spark: SparkSession, **options: object) -> DataFrameReader:
    return spark.read.options(header=True, escape='"', **options)


def read_products(
    spark: SparkSession,
    path: str,
    schema: StructType,
    read_limit: int | None = None,
    quoted_newlines: bool = True,
) -> DataFrame:
    """Scan a product table; columns are found by name, ``read_limit`` keeps the smallest ids.

    CSV columns may come in any order; schema columns the file lacks are null.
    Text with line breaks inside quotes makes a CSV file unsplittable. Switch
    ``quoted_newlines`` off for large files without such text, or use parquet.
    """
    if path.rstrip("/").endswith(".parquet"):
        products = spark.read.schema(schema).parquet(path)
    else:
        reader = _csv_reader(spark, multiLine=quoted_newlines, enforceSchema=False)
        present = _csv_reader(spark, multiLine=quoted_newlines).csv(path).columns
        types = {f.name: f for f in schema}
        scan = reader.schema(StructType([types.get(c, StructField(c, StringType())) for c in present])).csv(path)
        products = scan.select(
            *[
                F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema
            ]
        )
    return products if read_limit is None else first_by_id(products, read_limit)


BROKEN = "_broken"


def read_products_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Scan a CSV table of one record a line: its rows, and the lines that break the schema.

    A line with a value of the wrong type, or too few or too many values, goes to the
    second table as ``(line string)`` instead of becoming a row with nulls. Files are
    split, so quoted line breaks are not understood; they show up as broken lines, and
    :func:`read_products` reads such files, one task each.
    """
    present = _csv_reader(spark).csv(path).columns
    types = {f.name: f for f in schema}
    fields = [types.get(c, StructField(c, StringType())) for c in present]
    scan = (
        _csv_reader(spark, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, enforceSchema=False)
        .schema(StructType([*fields, StructField(BROKEN, StringType())]))
        .csv(path)
    )
    # Lines are parsed only as far as columns are asked for: this condition, always true, asks for all.
    parsed = F.hash(*present) >= F.lit(-(2**31))
    good = scan.where(F.col(BROKEN).isNull() & parsed).select(
        *[F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    )
    bad = scan.where(F.col(BROKEN).isNotNull() & parsed).select(F.col(BROKEN).alias("line"))
    return good, bad


def first_by_id(products: DataFrame, read_limit: int) -> DataFrame:
    """The ``read_limit`` rows with the smallest ids.

    A small limit is a top-k of every task; a large one goes by ranges of the id, so that
    no task holds all of it.
    """
    if read_limit <= TOP_ROWS:
        return products.orderBy("id").limit(read_limit)
    ranked = with_rank(products.withColumn("_tie", F.monotonically_increasing_id()), [F.asc("id"), F.asc("_tie")], "_rank")
    return ranked.where(F.col("_rank") <= read_limit).drop("_rank", "_tie")


def within_limit(pairs: DataFrame, read_limit: int | None) -> DataFrame:
    """Pairs whose present ids fit a table read with ``read_limit`` (two below it)."""
    if read_limit is None:
        return pairs
    bound = read_limit - 2
    fits = [F.col(c).isNull() | (F.col(c) <= bound) for c in ("rid", "lid")]
    return pairs.where(fits[0] & fits[1])


def truth_pairs(pairs: DataFrame, read_limit: int | None = None) -> DataFrame:
    """Known pairs as every job expects them: bounded, oriented, sorted."""
    return sorted_pairs(within_limit(pairs, read_limit))


def read_truth(spark: SparkSession, path: str, read_limit: int | None = None) -> DataFrame:
    """Scan a table of known pairs."""
    return truth_pairs(read_products(spark, path, PAIR_SCHEMA), read_limit)


def _text_lines(spark: SparkSession, path: str) -> list[str]:
    return [row["value"] for row in spark.read.text(path).limit(2).collect()]


def read_metadata(spark: SparkSession, path: str) -> dict | None:
    """Settings a result was computed with; None when none are stored beside it."""
    try:
        lines = _text_lines(spark, path.rstrip("/") + ".meta")
    except AnalysisException:
        return None
    return json.loads(lines[0]) if lines else None


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, dict | str | None]:
    """Result pairs, oriented and sorted, with their settings.

    Reads results written by this package (settings beside the data) and single
    CSV files that end in a ``#`` comment line, which is then returned as text.
    A missing path raises ``FileNotFoundError``.
    """
    try:
        pairs = _csv_reader(spark, comment="#").schema(PAIR_SCHEMA).csv(path)
    except AnalysisException as missing:
        raise FileNotFoundError(f"no results at {path}") from missing
    settings = read_metadata(spark, path)
    if settings is None:
        footer = spark.read.text(path).where(F.col("value").startswith("#")).limit(1).collect()
        settings = footer[0]["value"] if footer else None
    return sorted_pairs(pairs), settings
