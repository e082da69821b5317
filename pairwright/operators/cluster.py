"""Transitive closure of match edges, and what is read off its clusters."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, materialize, scratch_path
from .tiles import BROADCAST_KEYS, TILE_ROWS, spread

HOT_COPIES = 16
# So many edges are left to one task: a few megabytes, less than the jobs of another round cost.
LAST_EDGES = 20_000


def lookup(rows: DataFrame, key: str, table: DataFrame, value: str, size: int | None = None) -> DataFrame:
    """Replace ``key`` by the value ``table`` (one row ``id, value`` per id) has for it.

    Keys without an entry keep their own value. Both sides are written tables.
    Keys with more than a tile of rows are counted first, combined map-side, and
    answered by a broadcast of their few entries; should there be too many of
    them for a broadcast, the entries are copied and the rows dealt among the copies.
    ``size`` is the number of rows, if known.
    """
    found = table.select(F.col("id").alias(key), F.col(value).alias("_value"))
    replaced = F.coalesce("_value", key).alias(key)
    others = [c for c in rows.columns if c != key]
    plain = lambda part: part.join(found, key, "left").select(*others, replaced)
    if (rows.count() if size is None else size) <= TILE_ROWS:
        return plain(rows)
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > TILE_ROWS).select(key)
    hot = materialize(hot.join(found, key))
    count = hot.count()
    if not count:
        return plain(rows)
    if count <= BROADCAST_KEYS:
        few = F.broadcast(hot)
        busy = rows.join(few, key).select(*others, replaced)
        return busy.unionByName(plain(rows.join(few.select(key), key, "left_anti")))
    copies = found.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(HOT_COPIES - 1))))
    dealt = rows.withColumn("_copy", F.pmod(F.xxhash64(*others), F.lit(HOT_COPIES)).cast("int"))
    return dealt.join(copies, [key, "_copy"], "left").select(*others, replaced)


def _close_few(edges: DataFrame) -> DataFrame:
    """``(id, into)`` of a counted, small number of edges: each vertex and the smallest it reaches."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
                parent[max(a, b)] = min(a, b)
        if parent:
            ids = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array([root(x) for x in ids], kind)], names=["id", "into"])

    kind = edges.schema["lid"].dataType.simpleString()
    return edges.select("lid", "rid").coalesce(1).mapInArrow(close, f"id {kind}, into {kind}")


def connected_components(pairs: DataFrame) -> DataFrame:
    """Label every id on an edge with the smallest id it is connected to: ``(id, cluster_id)``.

    Rounds of contraction: every vertex is merged into the lowest vertex among
    itself and its neighbours, the edges are renamed to the merged vertices, and
    closed or repeated ones disappear. Lowest goes by id and by a fresh random rank
    in turn: by id a star collapses at once, by rank a constant share of any shape
    does, so later rounds work on ever smaller tables. The last ``LAST_EDGES`` are
    closed by one task. Missing ids and self-pairs link nothing.
    """
    spark = pairs.sparkSession
    clean = pairs.where(
        F.col("lid").isNotNull() & F.col("rid").isNotNull() & (F.col("lid") != F.col("rid"))
    ).select(F.least("lid", "rid").alias("lid"), F.greatest("lid", "rid").alias("rid"))
    path = scratch_path(spark)
    edges = materialize(clean.distinct(), path)
    merges: list[tuple[DataFrame, str]] = []
    while left := edges.count():
        if left <= LAST_EDGES:
            merge_path = scratch_path(spark)
            closed = materialize(_close_few(edges), merge_path)
            if not merges:
                discard(spark, path)
                return closed.withColumnRenamed("into", "cluster_id")
            merges.append((closed, merge_path))
            break
        salt = F.lit(len(merges))
        both = F.array(F.struct("lid", "rid"), F.struct(F.col("rid").alias("lid"), F.col("lid").alias("rid")))

        def rank(c: str) -> Column:
            return F.struct((F.xxhash64(c, salt) if len(merges) % 2 else F.lit(0)).alias("rank"), F.col(c).alias("id"))

        lowest = (
            edges.select(F.explode(both).alias("edge"))
            .select("edge.*")
            .groupBy(F.col("lid").alias("id"))
            .agg(F.min(rank("rid")).alias("near"))
            .select("id", F.least(rank("id"), F.col("near"))["id"].alias("into"))
        )
        merge_path = scratch_path(spark)
        merge = materialize(lowest, merge_path)
        merges.append((merge, merge_path))
        renamed = lookup(edges, "lid", merge, "into", left)
        renamed = lookup(renamed if left <= TILE_ROWS else materialize(renamed), "rid", merge, "into", left)
        shrunk = renamed.where("lid <> rid").select(
            F.least("lid", "rid").alias("lid"), F.greatest("lid", "rid").alias("rid")
        )
        next_path = scratch_path(spark)
        edges = materialize(shrunk.distinct(), next_path)
        discard(spark, path)
        path = next_path
    if not merges:
        return edges.select(F.col("lid").alias("id"), F.col("lid").alias("cluster_id"))
    roots = merges[-1][0]
    for merge, _ in reversed(merges[:-1]):
        roots = materialize(lookup(merge, "into", roots, "into"))
    smallest = roots.groupBy(F.col("into").alias("id")).agg(F.min("id").alias("smallest"))
    least = materialize(smallest.select("id", F.least("id", "smallest").alias("smallest")))
    named = materialize(lookup(roots, "into", least, "smallest").select("id", F.col("into").alias("cluster_id")))
    for _, merge_path in merges:
        discard(spark, merge_path)
    discard(spark, path)
    return named


def cluster_members(clusters: DataFrame) -> DataFrame:
    """Clusters by smallest member, members ascending, one row each.

    The listing stays one row per member, so a cluster of any size is sorted by
    many tasks and never gathered into one array.
    """
    return clusters.select("cluster_id", "id").orderBy("cluster_id", "id")


def with_singletons(clusters: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ids without any link as clusters of their own."""
    return ids.select("id").distinct().join(clusters, "id", "left").select(
        "id", F.coalesce("cluster_id", "id").alias("cluster_id")
    )


def pairs_among(n: str) -> Column:
    """Number of 2-combinations of ``n`` records, in whole numbers throughout."""
    return F.expr(f"({n} * ({n} - 1)) div 2")


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    """Members and closed pairs (all 2-combinations) per cluster, without listing them."""
    return (
        clusters.groupBy("cluster_id")
        .agg(F.count(F.lit(1)).alias("members"))
        .withColumn("closed_pairs", pairs_among("members"))
    )


def expand_pairs(clusters: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """All pairs ``lid < rid`` inside each cluster.

    Quadratic in cluster size by definition; :func:`cluster_sizes` counts them
    beforehand without listing any. Large clusters are spread over tiles.
    """
    rows = clusters.select(F.col("cluster_id").alias("key"), "id")
    left, right = spread(rows, rows, "key", "id", tile_rows)
    return (
        left.withColumnRenamed("id", "lid")
        .join(right.withColumnRenamed("id", "rid"), ["key", "left_tile", "right_tile"])
        .where("lid < rid")
        .select("lid", "rid")
    )


def open_components(pairs: DataFrame) -> DataFrame:
    """Components of a pair table that lack transitive pairs: ``(cluster_id, members, pairs, missing)``.

    A component of n members is closed when it has n(n-1)/2 different pairs, so counting
    per component tells, and nothing missing is listed. Turned, repeated, incomplete and
    self-pairs do not count.
    """
    clean = pairs.where("lid <> rid").select(F.least("lid", "rid").alias("lid"), F.greatest("lid", "rid").alias("rid"))
    distinct = materialize(clean.distinct())
    labels = connected_components(distinct)
    placed = lookup(distinct.select("lid"), "lid", labels, "cluster_id")
    counted = placed.groupBy(F.col("lid").alias("cluster_id")).agg(F.count(F.lit(1)).alias("pairs"))
    sizes = cluster_sizes(labels).join(counted, "cluster_id").where(F.col("pairs") < F.col("closed_pairs"))
    return sizes.select("cluster_id", "members", "pairs", (F.col("closed_pairs") - F.col("pairs")).alias("missing"))
