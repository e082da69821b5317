"""Matching new records against earlier ones without reading the earlier texts again.

An index keeps what matching needs of the records seen so far: per distinct histogram of a
block one row (its representative), the rows prepared for the join with their similarities
to the pivots, the pivots themselves, and the clusters. An extension

1. turns the new texts into histograms; those the index knows become links at once,
2. prepares the others as the index was prepared, against the same pivots,
3. joins them with the index and with one another: a pair has a new row on its left, so no
   two earlier rows meet,
4. closes the links it found over clusters instead of records, and relabels what changed.

The result equals matching everything at once. Prepared rows are added to the index as a
further folder; the earlier ones are not written again. A commit of the index is whole or
not there (see :mod:`..sources.store`).

Thresholds that rise with the size of a block are refused: they could part what an earlier
run had joined. New ids must not occur among the earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from ..sources import store
from . import matching
from .cluster import connected_components, lookup
from .matching import CROWD_ROWS, JoinRows, Threshold
from .pivots import PIVOTS, compare, draw, ties
from .tiles import TILE_ROWS, hot_groups

NO_PIVOTS = "none int"


@dataclass(frozen=True)
class MatchIndex:
    """A committed index. ``clusters``: ``(id, cluster_id)`` of all records that match another."""

    spark: SparkSession
    path: str
    manifest: store.Manifest

    def table(self, name: str) -> DataFrame:
        return store.read_table(self.spark, self.manifest, name)

    def folders(self, name: str) -> list[str]:
        return self.manifest.tables[name]["folders"]

    @property
    def clusters(self) -> DataFrame:
        return self.table("clusters")


def open_index(spark: SparkSession, path: str) -> MatchIndex | None:
    """The index last committed at ``path``, if any."""
    manifest = store.latest(spark, path)
    return None if manifest is None else MatchIndex(spark, path, manifest)


def _settings(keys: Sequence[str], threshold: Threshold) -> dict:
    if threshold.large is not None:
        raise ValueError("an index needs one threshold for blocks of any size")
    return {"keys": list(keys), "threshold": threshold.base}


def _prepared(placed: DataFrame) -> DataFrame:
    """What is kept of placed rows for later joins."""
    return placed.select("key", "block", "band", "home", *[c for c in matching._PAYLOAD if c not in ("group", "main", "signatures")])


def build_index(
    products: DataFrame, keys: Sequence[str], text: str, threshold: Threshold, path: str
) -> MatchIndex:
    """Match ``products`` and commit an index of them at ``path``."""
    spark = products.sparkSession
    settings = _settings(keys, threshold)
    prints, reps = matching._prepare(products, keys, text, threshold)
    floor = threshold.floor
    placed = materialize(matching._place(reps, floor))
    pivots = draw(placed, matching._HISTOGRAM)
    measured = materialize(compare(placed, pivots, matching._HISTOGRAM, matching.SIMILARITY))
    labels = matching.representative_clusters(reps, floor, measured=measured)
    tables = {
        "representatives": reps.select("block", "hist", "id"),
        "prepared": _prepared(measured),
        "pivots": spark.createDataFrame([], NO_PIVOTS) if pivots is None else pivots,
        "clusters": matching.named_members(prints, reps, labels),
    }
    return MatchIndex(spark, path, store.commit(spark, path, tables, settings))


def extend_index(
    index: MatchIndex,
    products: DataFrame,
    keys: Sequence[str],
    text: str,
    threshold: Threshold,
    tile_rows: int = TILE_ROWS,
) -> MatchIndex:
    """Match new ``products`` with one another and with the index; commit the index with them added."""
    spark, floor = index.spark, threshold.floor
    settings = _settings(keys, threshold)
    if settings != index.manifest.settings:
        raise ValueError(f"index was built with {index.manifest.settings}, not {settings}")
    prints, reps = matching._prepare(products, keys, text, threshold)
    known = index.table("representatives").withColumnRenamed("id", "old")
    met = materialize(reps.join(known, ["block", "hist"], "left"))
    fresh = met.where("old is null").drop("old")
    repeated = met.where("old is not null").select(F.col("old").alias("lid"), F.col("id").alias("rid"))

    placed = materialize(matching._place(fresh, floor))
    pivots = index.table("pivots")
    pivots = pivots if "key" in pivots.columns else None
    measured = materialize(compare(placed, pivots, matching._HISTOGRAM, matching.SIMILARITY))
    tied, _ = ties(measured)

    # From here on an earlier record is its cluster.
    clusters = index.clusters.withColumnRenamed("cluster_id", "group")
    sure = repeated.unionByName(tied).unionByName(matching.copy_edges(prints, reps).select("lid", "rid"))
    groups = connected_components(materialize(lookup(materialize(sure), "lid", clusters, "group")))
    own = groups.withColumnRenamed("cluster_id", "own")
    regrouped = materialize(lookup(clusters, "group", groups, "cluster_id"))
    new = measured.join(own, "id", "left").withColumn("group", F.coalesce("own", "id"))
    # Only earlier rows of keys that new rows have are moved.
    touched = measured.select("key").distinct()
    old = index.table("prepared").join(touched, "key", "left_semi")
    old = old.join(regrouped, "id", "left").join(own, "id", "left")
    old = old.withColumn("group", F.coalesce("group", "own", "id"))
    found = _delta(new, old, tile_rows, floor).select(F.col("lgroup").alias("lid"), F.col("rgroup").alias("rid"))
    star = groups.select(F.col("cluster_id").alias("lid"), F.col("id").alias("rid"))
    merged = connected_components(materialize(found.unionByName(star)))

    earlier = lookup(index.clusters, "cluster_id", merged, "cluster_id")
    added = merged.join(index.clusters.select("id"), "id", "left_anti")
    tables = {
        "representatives": fresh.select("block", "hist", "id"),
        "prepared": _prepared(measured),
        "clusters": earlier.select("id", "cluster_id").unionByName(added.select("id", "cluster_id")),
    }
    keep = {name: index.folders(name) for name in ("representatives", "prepared", "pivots")}
    return MatchIndex(spark, index.path, store.commit(spark, index.path, tables, settings, keep))


def _delta(new: DataFrame, old: DataFrame, tile_rows: int, floor: float) -> DataFrame:
    """Matches among new rows and between new and earlier ones."""
    plain = {
        "main": F.lit(False),
        "segment": F.lit(0),
        "cell": F.lit(0),
        "signatures": F.array(F.lit(0).cast("long")),
    }
    columns = ["key", "home", "segment", "cell", *matching._PAYLOAD]
    fresh = materialize(new.withColumns(plain).select(*columns, F.lit(True).alias("fresh")))
    earlier = old.withColumns(plain).select(*columns, F.lit(False).alias("fresh"))
    both = materialize(fresh.unionByName(earlier))
    crowded = hot_groups(both, "key", min(CROWD_ROWS, tile_rows)) is not None
    once = F.when(F.col("fresh"), F.col("l_home") & (~F.col("r_home") | (F.col("l_id") < F.col("r_id"))))
    allowed = once.otherwise(F.col("l_home") | F.col("r_home"))
    return matching.found_matches(fresh.drop("fresh"), both, allowed, floor, tile_rows if crowded else None)
