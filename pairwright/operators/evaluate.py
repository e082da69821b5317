"""Comparing found matches with known ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .cluster import cluster_sizes, connected_components, pairs_among
from .tiles import TILE_ROWS, spread


def orient_pairs(pairs: DataFrame) -> DataFrame:
    """Smaller id to ``lid``. A pair with a missing side stays as it is."""
    swap = F.col("lid") > F.col("rid")
    return pairs.withColumns(
        {
            "lid": F.when(swap, F.col("rid")).otherwise(F.col("lid")),
            "rid": F.when(swap, F.col("lid")).otherwise(F.col("rid")),
        }
    )


def sorted_pairs(pairs: DataFrame) -> DataFrame:
    """Oriented pairs in order, missing ids last."""
    return orient_pairs(pairs).orderBy(F.asc_nulls_last("lid"), F.asc_nulls_last("rid"))


def classify_pairs(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Every distinct pair of either table with its ``outcome``.

    One shuffle yields all three classes: ``true_positive``, ``false_negative``,
    ``false_positive``.
    """
    marked = truth.select("lid", "rid", F.lit(True).alias("known"), F.lit(False).alias("reported")).unionByName(
        found.select("lid", "rid", F.lit(False).alias("known"), F.lit(True).alias("reported"))
    )
    both = marked.groupBy("lid", "rid").agg(
        F.bool_or("known").alias("known"), F.bool_or("reported").alias("reported")
    )
    outcome = (
        F.when(F.col("known") & F.col("reported"), "true_positive")
        .when(F.col("known"), "false_negative")
        .otherwise("false_positive")
    )
    return both.select("lid", "rid", outcome.alias("outcome"))


def true_positives(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs in both tables."""
    return truth.select("lid", "rid").join(found.select("lid", "rid"), ["lid", "rid"])


def false_negatives(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Known pairs that were not found."""
    return truth.select("lid", "rid").join(found.select("lid", "rid"), ["lid", "rid"], "left_anti")


def false_positives(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Found pairs that are not known."""
    return false_negatives(found, truth)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _metrics(counts: DataFrame) -> DataFrame:
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return (
        counts.select(
            "tp", "fp", "fn", _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall")
        )
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )


def evaluate_clusters(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Counts, precision, recall and F1 of two clusterings over all their closed pairs.

    Pairs are counted, not listed: a cluster of n members closes n(n-1)/2 pairs,
    and a group of n ids that share both clusters accounts for n(n-1)/2 pairs in
    both. Linear work, whatever the cluster sizes.
    """
    both = truth.select("id", F.col("cluster_id").alias("truth_cluster")).join(
        found.select("id", F.col("cluster_id").alias("found_cluster")), "id"
    )
    n = F.col("n")
    shared = both.groupBy("truth_cluster", "found_cluster").agg(F.count(F.lit(1)).alias("n"))
    tp = shared.agg(F.coalesce(F.sum((n * (n - 1) / 2).cast("long")), F.lit(0)).alias("tp"))

    counts = [
        tp.select("tp", F.lit(0).alias("known"), F.lit(0).alias("reported")),
        cluster_sizes(truth).agg(
            F.lit(0).alias("tp"), F.sum("closed_pairs").alias("known"), F.lit(0).alias("reported")
        ),
        cluster_sizes(found).agg(
            F.lit(0).alias("tp"), F.lit(0).alias("known"), F.sum("closed_pairs").alias("reported")
        ),
    ]
    total = counts[0].unionByName(counts[1]).unionByName(counts[2]).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "known", "reported")]
    )
    return _metrics(
        total.select("tp", (F.col("reported") - F.col("tp")).alias("fp"), (F.col("known") - F.col("tp")).alias("fn"))
    )


def evaluate_pairs(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Close both pair tables transitively, then evaluate the clusterings."""
    return evaluate_clusters(connected_components(truth), connected_components(found))


def evaluate_baseline(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Evaluate pair tables as sets, without closing or re-orienting them."""
    counted = classify_pairs(truth, found).agg(
        *[
            F.count_if(F.col("outcome") == outcome).alias(name)
            for name, outcome in (("tp", "true_positive"), ("fp", "false_positive"), ("fn", "false_negative"))
        ]
    )
    return _metrics(counted)


def enrich_pairs(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Attach both products' columns, prefixed ``l`` and ``r``; pairs without a product are kept."""
    left = products.select([F.col(c).alias("l" + c) for c in products.columns])
    right = products.select([F.col(c).alias("r" + c) for c in products.columns])
    return pairs.join(left, "lid", "left").join(right, "rid", "left").select(
        *pairs.columns,
        *[c for c in left.columns if c != "lid"],
        *[c for c in right.columns if c != "rid"],
    )


def outcome_members(truth: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, truth_cluster, found_cluster)`` of every record in either clustering."""
    return truth.select("id", F.col("cluster_id").alias("truth_cluster")).join(
        found.select("id", F.col("cluster_id").alias("found_cluster")), "id", "full"
    )


def outcome_cells(members: DataFrame) -> DataFrame:
    """Records per truth cluster and found cluster: ``(truth_cluster, found_cluster, n)``.

    All closed pairs follow from the cells. Those inside a cell with both clusters are the
    true positives, those between cells of one truth cluster the false negatives, those
    between cells of one found cluster the false positives. A record outside of one
    clustering has no pairs there; it is missing in that column.
    """
    return members.groupBy("truth_cluster", "found_cluster").agg(F.count(F.lit(1)).alias("n"))


def cell_metrics(cells: DataFrame) -> DataFrame:
    """Counts, precision, recall and F1 over closed pairs, from cells."""
    in_both = F.col("truth_cluster").isNotNull() & F.col("found_cluster").isNotNull()
    tp = cells.where(in_both).select(pairs_among("n").alias("tp"), F.lit(0).alias("known"), F.lit(0).alias("reported"))
    sides = [tp]
    for side, name in (("truth_cluster", "known"), ("found_cluster", "reported")):
        sizes = cells.where(F.col(side).isNotNull()).groupBy(side).agg(F.sum("n").alias("n"))
        zero = {c: F.lit(0) for c in ("tp", "known", "reported") if c != name}
        sides.append(sizes.select(pairs_among("n").alias(name)).withColumns(zero))
    total = sides[0].unionByName(sides[1]).unionByName(sides[2]).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "known", "reported")]
    )
    return _metrics(
        total.select("tp", (F.col("reported") - F.col("tp")).alias("fp"), (F.col("known") - F.col("tp")).alias("fn"))
    )


def outcome_pairs(members: DataFrame, outcome: str, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The pairs of one outcome, ``lid < rid``, for those who need the list.

    As many rows as there are such pairs; nothing else in this package asks for it.
    """
    side = "found_cluster" if outcome == "false_positive" else "truth_cluster"
    other = "truth_cluster" if side == "found_cluster" else "found_cluster"
    rows = members.where(F.col(side).isNotNull()).select(F.struct(side).alias("key"), "id", F.col(other).alias("other"))
    left, right = spread(rows, rows, "key", "id", tile_rows)
    met = left.withColumnsRenamed({"id": "lid", "other": "l_other"}).join(
        right.withColumnsRenamed({"id": "rid", "other": "r_other"}), ["key", "left_tile", "right_tile"]
    )
    together = F.coalesce(F.col("l_other") == F.col("r_other"), F.lit(False))
    wanted = together if outcome == "true_positive" else ~together
    return met.where((F.col("lid") < F.col("rid")) & wanted).select("lid", "rid")


def evaluate_links(truth: DataFrame, links: DataFrame, members: DataFrame) -> DataFrame:
    """Evaluate matches given as class links and members, as a set of pairs ``lid < rid``.

    ``links``: ``(lid, rid, pairs)`` between classes, a class with itself for its inner
    pairs; ``members``: ``(id, class_id)``. Known pairs are looked up as they stand,
    without closing or turning them; repeated ones count once.
    """
    known = materialize(truth.select("lid", "rid").distinct())
    of = lambda side, name: members.select(F.col("id").alias(side), F.col("class_id").alias(name))
    placed = known.where("lid < rid").join(of("lid", "a"), "lid").join(of("rid", "b"), "rid")
    linked = links.select(F.col("lid").alias("low"), F.col("rid").alias("high"))
    hits = placed.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).join(linked, ["low", "high"])
    counts = [
        hits.agg(F.count(F.lit(1)).alias("tp")).select("tp", F.lit(0).alias("known"), F.lit(0).alias("reported")),
        known.agg(F.lit(0).alias("tp"), F.count(F.lit(1)).alias("known"), F.lit(0).alias("reported")),
        links.agg(F.lit(0).alias("tp"), F.lit(0).alias("known"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("reported")),
    ]
    total = counts[0].unionByName(counts[1]).unionByName(counts[2]).agg(*[F.sum(c).alias(c) for c in ("tp", "known", "reported")])
    return _metrics(
        total.select("tp", (F.col("reported") - F.col("tp")).alias("fp"), (F.col("known") - F.col("tp")).alias("fn"))
    )
