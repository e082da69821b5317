"""Describing product tables and known matches."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.similarity import (
    price_gap,
    relative_price_gap,
    same_text,
    token_jaccard,
)
from ..functions.text import words
from ..session import materialize
from .cluster import connected_components, pairs_among
from .evaluate import enrich_pairs
from .ranking import with_running_sums
from .tiles import spread

QUANTILE_BINS = 1024


def token_counts(products: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each word occurs in the given columns. Counting starts before the shuffle."""
    return (
        products.select(F.explode(F.array(*columns)).alias("text"))
        .where(F.col("text").isNotNull())
        .select(F.explode(words(F.col("text"))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def token_frequency(products: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Word counts, most frequent first."""
    return token_counts(products, columns).orderBy(F.desc("count"), "token")


def top_tokens(products: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent words."""
    return token_frequency(products, columns).limit(n)


def distinct_count(products: DataFrame, column: str, name: str) -> DataFrame:
    """Number of distinct present values."""
    return products.agg(F.countDistinct(column).alias(name))


def top_values(products: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent present values."""
    counted = products.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), column).limit(n)


def _order_statistics(values: DataFrame, low: float, high: float, ranks: Sequence[int]) -> dict[int, float]:
    """Exact values at 0-based ranks, by repeatedly narrowing the interval around each.

    Every pass cuts the open intervals into bins and counts them with partial
    aggregation, so values are neither sorted nor shuffled, and only bin counts
    (a fixed number) reach the driver. A bin holding one value ends its search.
    """
    value = F.col("value")
    found: dict[int, float] = {}
    intervals = {rank: (low, high, 0) for rank in ranks}
    while intervals:
        for rank, (a, b, _) in list(intervals.items()):
            if a == b:
                found[rank] = a
                del intervals[rank]
        if not intervals:
            break
        spans = sorted({(a, b) for a, b, _ in intervals.values()})
        bins = []
        for number, (a, b) in enumerate(spans):
            width = (b - a) / QUANTILE_BINS
            bin_of = F.least(F.floor((value - a) / width), F.lit(QUANTILE_BINS - 1)) if width > 0 else F.lit(0)
            bin_of = F.when(value == b, QUANTILE_BINS - 1).otherwise(bin_of)
            inside = (value >= a) & (value <= b)
            bins.append(F.when(inside, F.struct(F.lit(number).alias("span"), bin_of.cast("int").alias("bin"))))
        counted = (
            values.select("value", F.explode(F.array(*bins)).alias("place"))
            .where(F.col("place").isNotNull())
            .groupBy("place")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .collect()
        )
        for rank, (a, b, below) in list(intervals.items()):
            number = spans.index((a, b))
            seen = below
            for row in sorted((r for r in counted if r["place"]["span"] == number), key=lambda r: r["place"]["bin"]):
                if seen + row["n"] > rank:
                    intervals[rank] = (row["low"], row["high"], seen)
                    break
                seen += row["n"]
    return found


def describe(products: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum as ``(statistic, value)`` rows.

    Quartiles are exact with linear interpolation.
    """
    spark = products.sparkSession
    values = products.select(F.col(column).cast("double").alias("value")).where("value is not null and not isnan(value)")
    basic = values.agg(
        F.count("value").alias("count"),
        F.mean("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ).first()
    count = basic["count"]
    quartiles: dict[str, float | None] = {"25%": None, "50%": None, "75%": None}
    if count:
        places = {"25%": 0.25 * (count - 1), "50%": 0.5 * (count - 1), "75%": 0.75 * (count - 1)}
        ranks = {r for p in places.values() for r in (math.floor(p), math.ceil(p))}
        at = _order_statistics(values, basic["min"], basic["max"], sorted(ranks))
        for name, p in places.items():
            a, b = at[math.floor(p)], at[math.ceil(p)]
            quartiles[name] = a + (b - a) * (p - math.floor(p))
    rows = [
        ("count", float(count)),
        ("mean", basic["mean"]),
        ("std", basic["std"]),
        ("min", basic["min"]),
        *quartiles.items(),
        ("max", basic["max"]),
    ]
    return spark.createDataFrame(rows, "statistic string, value double")


def dataset_summary(products: DataFrame, brand: str | None, texts: Sequence[str]) -> DataFrame:
    """One row: records, distinct brands (if there are brands), word occurrences."""
    occurrences = sum((F.coalesce(F.size(words(F.col(c))), F.lit(0)) for c in texts), F.lit(0))
    brands = [] if brand is None else [F.countDistinct(brand).alias("brands")]
    return products.agg(
        F.count(F.lit(1)).alias("records"), *brands, F.sum(occurrences).cast("long").alias("tokens")
    )


def pair_profile(pairs: DataFrame, products: DataFrame, texts: Sequence[str], structured: bool) -> DataFrame:
    """Per-pair differences and similarities of the two products of each pair."""
    enriched = enrich_pairs(pairs.select("lid", "rid"), products)
    measures: dict[str, Column] = {}
    if structured:
        left, right = F.col("lprice"), F.col("rprice")
        measures["price_diff"] = price_gap(left, right)
        measures["price_rel_diff"] = relative_price_gap(left, right)
        measures["brand_match"] = same_text(F.col("lbrand"), F.col("rbrand"))
    for c in texts:
        measures[f"{c}_token_overlap"] = token_jaccard(F.col("l" + c), F.col("r" + c))
    return enriched.withColumns(measures)


def profile_means(profiled: DataFrame) -> DataFrame:
    """Number of pairs and the mean of every measure, missing values left out."""
    names = [
        c
        for c in profiled.columns
        if c in ("price_diff", "price_rel_diff", "brand_match") or c.endswith("_token_overlap")
    ]
    return profiled.agg(
        F.count(F.lit(1)).alias("pairs"), *[F.avg(F.col(c).cast("double")).alias(c) for c in names]
    )


def truth_profile(
    truth: DataFrame, products: DataFrame, texts: Sequence[str], structured: bool
) -> DataFrame:
    """Profile of the closed truth: each record of a cluster measured against the cluster's smallest id.

    Linear in records; the pairs inside a cluster are not listed.
    """
    members = connected_components(truth).where("id <> cluster_id")
    pairs = members.select(F.col("cluster_id").alias("lid"), F.col("id").alias("rid"))
    return pair_profile(pairs, products, texts, structured)


def closed_truth_means(
    truth: DataFrame, products: DataFrame, texts: Sequence[str], structured: bool
) -> DataFrame:
    """Number of closed pairs of the truth and the mean of every measure over them; one row.

    The measures are those of :func:`pair_profile`, over every pair of records whose
    known links reach each other. Pairs are not listed:

    * price gaps come from running sums over the prices of a cluster in order. A price v
      with c smaller ones summing to s adds v*c - s to the absolute gaps and c - s/v to the
      relative ones;
    * equal brands are counted per cluster and brand;
    * records of a cluster with equal token sets are one class; only different classes of
      one cluster are compared, tile by tile, and summed where they meet.

    Measures a pair lacks (a missing price, a larger price of 0) are left out of its mean.
    """
    members = materialize(
        connected_components(truth).withColumnRenamed("cluster_id", "cluster").join(products, "id", "left")
    )
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    means = [sizes.agg(F.coalesce(F.sum(pairs_among("n")), F.lit(0)).alias("pairs"))]
    if structured:
        means += [_price_means(members), _brand_mean(members)]
    means += [_overlap_mean(members, c) for c in texts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), means)  # one row each
    row = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    shares = [c for c in row.columns if c == "brand_match" or c.endswith("_token_overlap")]
    return row.withColumns({c: F.try_divide(F.col(c), F.col("pairs")) for c in shares})


def _price_means(members: DataFrame) -> DataFrame:
    prices = members.select("cluster", F.col("price").cast("double").alias("price")).where("price is not null and not isnan(price)")
    counted = prices.groupBy("cluster", "price").agg(F.count(F.lit(1)).alias("n"))
    below = with_running_sums(counted, "cluster", F.col("price"), {"c": F.col("n"), "s": F.col("price") * F.col("n")})
    n, c, s, v = (F.col(x) for x in ("n", "c", "s", "price"))
    met = n * c + pairs_among("n")
    summed = below.agg(
        F.sum(met).alias("gaps"),
        F.sum(n * (v * c - s)).alias("gap"),
        F.sum(F.when(v != 0, met)).alias("shares"),
        F.sum(F.when(v != 0, n * (c - s / v))).alias("share"),
    )
    return summed.select(F.try_divide("gap", "gaps").alias("price_diff"), F.try_divide("share", "shares").alias("price_rel_diff"))


def _brand_mean(members: DataFrame) -> DataFrame:
    brand = F.coalesce(F.lower("brand"), F.lit(""))
    same = members.groupBy("cluster", brand.alias("brand")).agg(F.count(F.lit(1)).alias("n"))
    return same.agg(F.coalesce(F.sum(pairs_among("n")), F.lit(0)).alias("brand_match"))


def _overlap_mean(members: DataFrame, text: str) -> DataFrame:
    """Sum of the token Jaccard over all pairs of a cluster, by classes of equal token sets."""
    tokens = F.sort_array(F.array_distinct(words(F.coalesce(F.col(text), F.lit("nan")))))
    classes = materialize(
        members.groupBy("cluster", tokens.alias("tokens")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    )
    filled = classes.where(F.size("tokens") > 0).withColumn("key", F.struct("cluster")).drop("cluster")
    alike = classes.where(F.size("tokens") > 0).select(pairs_among("n").cast("double").alias("total"))
    left, right = spread(filled, filled, "key", "id")
    left = left.withColumnsRenamed({"tokens": "a", "n": "l_n", "id": "l_id"})
    right = right.withColumnsRenamed({"tokens": "b", "n": "r_n", "id": "r_id"})
    shared = F.size(F.array_intersect("a", "b"))
    across = left.join(right, ["key", "left_tile", "right_tile"]).where("l_id < r_id").select(
        (F.col("l_n") * F.col("r_n") * shared / (F.size("a") + F.size("b") - shared)).alias("total")
    )
    return alike.unionByName(across).agg(F.coalesce(F.sum("total"), F.lit(0.0)).alias(f"{text}_token_overlap"))
