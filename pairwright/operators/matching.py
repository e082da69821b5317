"""Similar pairs inside blocks, found exactly and without comparing everything.

The similarity of two texts depends on their character histograms only, and
"Jaccard >= t" is the same as "the histograms' L1 distance is at most
(1-t)/(1+t) of the summed lengths". That gives four exact reductions:

1. Records of a block with equal histograms are one *representative* (the
   smallest id). Copies are tied to it by one edge each, so a huge group of
   copies costs a linear number of rows.
2. Lengths may differ by a factor of t at most: representatives join within a
   geometric length band and its neighbour only.
3. If at most r characters may differ and the alphabet is cut into r+1 segments,
   some segment agrees completely. Where many short texts share a block and band,
   they join on a segment's signature.
4. A few sums over groups of characters bound the distance from below; they are
   compared inside the join condition before any histogram is.
5. 1 - Jaccard is a metric. In crowded bands every row knows its distances to some
   pivots (see :mod:`.pivots`); a pair whose distances to one of them differ by more
   than a match may is ruled out, most by an equal cell in the join key, others by
   the condition.

Hot join keys are spread over tiles (see :mod:`.tiles`). When only the clusters
are wanted, rows within reach of a pivot are tied to it, and only rows of different
tied groups are compared afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.histogram import char_histogram
from ..functions.similarity import histogram_length, name_tokens, token_overlap
from ..session import discard, materialize, scratch_path
from .blocking import baseline_blocks, block_of
from .cluster import connected_components, lookup, pairs_among
from .dense import dense_keys, dense_matches, to_pivots
from .pivots import PIVOTS, Similarity, cells, main_groups, measure, outside_reach, tie, visited_cells
from .ranking import with_rank
from .tiles import TILE_ROWS, checked_broadcast, hot_groups, spread, unspread

GROUP_SUMS = 20
MAX_SEGMENTS = 8
CROWD_ROWS = 1024
# Characters with a fixed place in the count array, by falling frequency. Neighbours in
# this order go to different segments and sums. All other characters are in a map.
COMMON_CHARACTERS = " etaoinsrhldcumfpgwybvkxjqz0123456789-.,"


@dataclass(frozen=True)
class Threshold:
    """Smallest score of a match; blocks above ``large_rows`` rows may ask for more."""

    base: float
    large: float | None = None
    large_rows: int | None = None

    @property
    def floor(self) -> float:
        return self.base if self.large is None else min(self.base, self.large)


UNSTRUCTURED = Threshold(fixed.UNSTRUCTURED_THRESHOLD)
STRUCTURED = Threshold(fixed.STRUCTURED_THRESHOLD)


def fingerprints(products: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``(id, block, hist)``; all later stages work on histograms, never on whole texts."""
    return products.select(
        "id", block_of(keys).alias("block"), char_histogram(F.coalesce(F.col(text), F.lit(""))).alias("hist")
    )


def representatives(prints: DataFrame) -> DataFrame:
    """One row per distinct histogram of a block: smallest id and number of records."""
    return prints.groupBy("block", "hist").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))


def copy_edges(prints: DataFrame, reps: DataFrame) -> DataFrame:
    """One edge from each record to the representative it equals."""
    target = reps.where(F.col("copies") > 1).select("block", "hist", F.col("id").alias("lid"))
    return (
        prints.join(target, ["block", "hist"])
        .where(F.col("id") != F.col("lid"))
        .select("lid", F.col("id").alias("rid"), F.lit(1.0).alias("score"))
    )


def _ranked() -> Column:
    """The characters of a placed row as ``array<struct<rank,n>>``: common ones by place, then rare ones by character."""
    placed = F.transform("common", lambda n, place: F.struct((place + 1).alias("rank"), n.alias("n")))
    rare = F.transform(F.map_entries("rare"), lambda x: F.struct(F.ascii(x["key"]).alias("rank"), x["value"].alias("n")))
    return F.concat(F.filter(placed, lambda x: x["n"] > 0), rare)


_SUMS = (*[f"sum{g}" for g in range(GROUP_SUMS)], "sum_rare")
_HISTOGRAM = ("length", "sum_rare", "common", "rare")
_PAYLOAD = ("id", "group", "main", "length", *_SUMS, "common", "rare", "signatures", *PIVOTS, "min_score")


@dataclass(frozen=True)
class JoinRows:
    """Rows ready to be joined on ``key``; ``crowded`` if some key may hold many of them."""

    rows: DataFrame
    crowded: bool


def _place(reps: DataFrame, floor: float) -> DataFrame:
    """Representatives with their sums, once at home in their length band and once visiting the next.

    A pair is found in the band of its longer text: the shorter one is at home there or
    a visitor.
    """
    ratio = floor - 1e-6
    step = math.log(1 / ratio)
    counts = F.map_from_entries("hist")
    common = F.array(*[F.coalesce(F.element_at("counts", F.lit(c)), F.lit(0)) for c in COMMON_CHARACTERS])
    rare = F.map_filter("counts", lambda c, n: F.position(c, F.lit(COMMON_CHARACTERS)) == 0)

    def group_sum(group: int) -> Column:
        chosen = F.filter("common", lambda _, place: place % GROUP_SUMS == group)
        return F.aggregate(chosen, F.lit(0), lambda acc, n: acc + n).cast("double")

    described = (
        # Doubles are exact here and, unlike integers, compared without overflow checks.
        reps.withColumn("length", histogram_length(F.col("hist")).cast("double"))
        .where(F.col("length") > 0)
        .withColumn("counts", counts)
        .withColumn("common", common)
        .withColumn("rare", rare)
        .withColumns({f"sum{g}": group_sum(g) for g in range(GROUP_SUMS)})
        .withColumn("sum_rare", F.aggregate(F.map_values("rare"), F.lit(0), lambda acc, n: acc + n).cast("double"))
        .withColumn("own_band", F.floor(F.log(F.col("length")) / step).cast("int"))
        .drop("hist", "copies", "counts")
    )
    placed = (
        described.withColumn("visit", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("band", F.col("own_band") + F.col("visit"))
        .withColumn("home", F.col("visit") == 0)
        .withColumn("key", F.struct("block", "band"))
    )
    return placed.drop("visit", "own_band")


def _similarity(a: Column, b: Column) -> Column:
    """Exact character-multiset Jaccard of two non-empty texts given as structs of ``_HISTOGRAM``."""
    total = a["length"] + b["length"]
    apart = F.aggregate(F.zip_with(a["common"], b["common"], lambda x, y: F.abs(x - y)), F.lit(0), lambda acc, n: acc + n)
    rare = F.map_zip_with(a["rare"], b["rare"], lambda _, x, y: F.abs(F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0))))
    none_rare = (a["sum_rare"] == 0) & (b["sum_rare"] == 0)
    apart = apart + F.when(none_rare, F.lit(0)).otherwise(F.aggregate(F.map_values(rare), F.lit(0), lambda acc, n: acc + n))
    return (total - apart) / (total + apart)


SIMILARITY = Similarity(_similarity, to_pivots)


def _keyed(placed: DataFrame, floor: float, crowd_rows: int) -> JoinRows:
    """Placed rows keyed by block, band and pivot cell; where short texts crowd a band, also by segment signature."""
    rate = 2 * (1 - floor) / (1 + floor) * (1 + 1e-9)
    longest = F.exp((F.col("band") + 1) * math.log(1 / (floor - 1e-6)))
    segments = (F.floor(F.lit(rate) * longest + 1e-6) + 1).cast("int")
    signatures = F.transform(
        F.sequence(F.lit(0), F.col("segments") - 1),
        lambda g: F.xxhash64(F.filter("ranked", lambda x: x["rank"] % F.col("segments") == g)),
    )
    crowds = hot_groups(placed, "key", crowd_rows)
    if crowds is None:
        whole = placed.withColumns(
            {"segment": F.lit(0), "signature": F.lit(0).cast("long"), "signatures": F.array(F.lit(0).cast("long"))}
        )
    else:
        usable = F.col("crowd") & (segments <= MAX_SEGMENTS)
        whole = (
            placed.join(crowds.withColumn("crowd", F.lit(True)), "key", "left")
            .withColumn("segments", F.when(usable, segments).otherwise(1))
            .withColumn("ranked", F.when(F.col("segments") > 1, _ranked()))
            .withColumn(
                "signatures",
                F.when(F.col("segments") > 1, signatures).otherwise(F.array(F.lit(0).cast("long"))),
            )
            .select("*", F.posexplode("signatures").alias("segment", "signature"))
        )
    key = F.struct("block", "band", "segment", "signature").alias("key")
    return JoinRows(materialize(whole.select(key, "home", "segment", "cell", *_PAYLOAD)), crowds is not None)


def _prefixed(rows: DataFrame, prefix: str) -> DataFrame:
    """Rename a row's own columns; join columns keep their names."""
    return rows.withColumnsRenamed({c: prefix + c for c in (*_PAYLOAD, "home")})


def _sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cell joins the key; the right side also visits the neighbouring cells."""
    within = F.struct("key", F.col("cell").alias("cell")).alias("key")
    rest = lambda rows: [c for c in rows.columns if c not in ("key", "cell")]
    near = right.withColumn("cell", F.explode(visited_cells()))
    return left.select(within, *rest(left)), near.select(within, *rest(right))


def _close_enough(floor: float) -> Column:
    """Cheap necessary condition: distance of the group sums."""
    total = F.col("l_length") + F.col("r_length")
    distance = reduce(add, (F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) for c in _SUMS))
    return distance <= total * F.lit((1 - floor) / (1 + floor)) + 1e-6


def _first_shared_segment() -> Column:
    """The pair meets once per shared segment; only the first meeting counts."""
    agree = F.zip_with("l_signatures", "r_signatures", lambda x, y: x == y)
    return (F.col("segment") == 0) | (F.array_position(agree, F.lit(True)) == F.col("segment") + 1)


def _score() -> Column:
    side = lambda p: F.struct(*[F.col(f"{p}_{c}").alias(c) for c in _HISTOGRAM])
    return _similarity(side("l"), side("r"))


def _joined(left: DataFrame, right: DataFrame, condition: Column, floor: float, tile_rows: int | None) -> DataFrame:
    """Two sides joined on their key as far as they pass the cheap tests. No ``tile_rows``: no hot keys."""
    left, right = unspread(left, right) if tile_rows is None else spread(left, right, "key", "id", tile_rows)
    met = _prefixed(left, "l_").join(_prefixed(right, "r_").drop("segment"), ["key", "left_tile", "right_tile"])
    different = (F.col("l_id") != F.col("r_id")) & (F.col("l_group") != F.col("r_group"))
    return met.where(condition & different & ~outside_reach(floor) & _close_enough(floor))


def _candidates(left: DataFrame, right: DataFrame, condition: Column, floor: float, tile_rows: int | None) -> DataFrame:
    """Pairs of two sides that have to be scored; the sides are joined on key and cell."""
    return _joined(*_sides(left, right), condition, floor, tile_rows)


def found_matches(left: DataFrame, right: DataFrame, condition: Column, floor: float, tile_rows: int | None) -> DataFrame:
    """Matches of two sides: ``(lid, rid, score, lgroup, rgroup)``. No ``tile_rows``: no hot keys.

    Keys that make very many pairs are compared tile by tile, the others joined.
    """
    left, right = _sides(left, right)
    dense = dense_keys(left, right)
    if dense is None:
        return _matches(_joined(left, right, condition, floor, tile_rows))
    dense = materialize(dense)
    hot = checked_broadcast(dense.select("key"))
    few = [side.join(hot, "key", "left_anti") for side in (left, right)]
    listed = dense_matches(left, right, dense, floor, tile_rows or TILE_ROWS).where(condition)
    return _matches(_joined(*few, condition, floor, tile_rows)).unionByName(_named_pairs(listed))


def _named_pairs(scored: DataFrame) -> DataFrame:
    """``(lid, rid, score, lgroup, rgroup)``, the smaller id first."""
    swap = F.col("l_id") > F.col("r_id")
    return scored.select(
        F.when(swap, F.col("r_id")).otherwise(F.col("l_id")).alias("lid"),
        F.when(swap, F.col("l_id")).otherwise(F.col("r_id")).alias("rid"),
        "score",
        F.col("l_group").alias("lgroup"),
        F.col("r_group").alias("rgroup"),
    )


def _matches(near: DataFrame) -> DataFrame:
    """Candidates whose score suffices: ``(lid, rid, score, lgroup, rgroup)``."""
    # Scored in a generator of its own: the optimizer would move a filter on the score into
    # the join condition, evaluate it twice and take the join out of generated code.
    scores = F.array(F.when(_first_shared_segment(), _score()))
    good = F.explode_outer(F.filter(scores, lambda s: s >= F.col("l_min_score")))
    scored = near.select("l_id", "r_id", "l_group", "r_group", good.alias("score"))
    return _named_pairs(scored.where(F.col("score").isNotNull()))


def _open_sides(keyed: JoinRows) -> tuple[DataFrame, DataFrame, Column]:
    """Sides and condition of the pairs that may not be in one group yet.

    Of a key's main group no two rows are compared: every pair has a row outside of it on
    the left. Rows at home meet once, and meet visitors.
    """
    once = F.col("l_home") & (~F.col("r_home") | (F.col("l_id") < F.col("r_id")))
    allowed = F.when(F.col("r_main"), F.col("l_home") | F.col("r_home")).otherwise(once)
    return keyed.rows.where("not main"), keyed.rows, allowed


def _open_pairs(keyed: JoinRows, floor: float, tile_rows: int) -> DataFrame:
    """Candidate pairs that may not be in one group yet."""
    return _candidates(*_open_sides(keyed), floor, tile_rows if keyed.crowded else None)


def _open_matches(keyed: JoinRows, floor: float, tile_rows: int) -> DataFrame:
    """Matches among the pairs of :func:`_open_pairs`."""
    return found_matches(*_open_sides(keyed), floor, tile_rows if keyed.crowded else None)


def _with_min_score(reps: DataFrame, threshold: Threshold) -> DataFrame:
    if threshold.large is None:
        return reps.withColumn("min_score", F.lit(float(threshold.base)))
    large = (
        reps.groupBy("block").agg(F.sum("copies").alias("rows")).where(F.col("rows") > threshold.large_rows)
    )
    wanted = F.when(F.col("rows").isNotNull(), F.lit(threshold.large)).otherwise(F.lit(threshold.base))
    return reps.join(large, "block", "left").withColumn("min_score", wanted).drop("rows")


def _prepare(
    products: DataFrame, keys: Sequence[str], text: str, threshold: Threshold
) -> tuple[DataFrame, DataFrame]:
    prints = materialize(fingerprints(products, keys, text))
    return prints, materialize(_with_min_score(representatives(prints), threshold))


def similar_pairs(
    products: DataFrame,
    keys: Sequence[str],
    text: str,
    threshold: Threshold,
    crowd_rows: int = CROWD_ROWS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Scored match edges ``(lid, rid, score)``.

    Complete for distinct texts: every pair of representatives at or above the
    block's threshold. Records with equal histograms appear as one edge (score 1)
    to their representative instead of all pairs among them.
    """
    prints, reps = _prepare(products, keys, text, threshold)
    keyed = _ungrouped(reps, threshold.floor, min(crowd_rows, tile_rows))
    # No row is in a main group here, so a visitor on the left finds nothing.
    rows, others, allowed = _open_sides(keyed)
    found = found_matches(rows.where("home"), others, allowed, threshold.floor, tile_rows if keyed.crowded else None)
    return copy_edges(prints, reps).unionByName(found.select("lid", "rid", "score"))


def _ungrouped(reps: DataFrame, floor: float, crowd_rows: int) -> JoinRows:
    """Representatives ready to be joined, each a group of its own."""
    placed, paths = _measured(reps, floor)
    alone = cells(placed, floor).withColumn("group", F.col("id")).withColumn("main", F.lit(False))
    keyed = _keyed(alone, floor, crowd_rows)
    for path in paths:
        discard(reps.sparkSession, path)
    return keyed


def _measured(reps: DataFrame, floor: float) -> tuple[DataFrame, list[str]]:
    """Placed representatives with their pivots, and the folders to delete once they are read."""
    paths = [scratch_path(reps.sparkSession) for _ in range(2)]
    return measure(materialize(_place(reps, floor), paths[0]), _HISTOGRAM, SIMILARITY, paths[1]), paths


def all_candidates(reps: DataFrame, floor: float, crowd_rows: int = CROWD_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """All pairs of representatives that have to be scored, as the join yields them."""
    return _open_pairs(_ungrouped(reps, floor, min(crowd_rows, tile_rows)), floor, tile_rows)


@dataclass(frozen=True)
class Linking:
    """``groups(id, group)``: representatives tied through pivots; ``near``: candidates between groups."""

    groups: DataFrame
    near: DataFrame


def linking_candidates(
    reps: DataFrame,
    floor: float,
    crowd_rows: int = CROWD_ROWS,
    tile_rows: int = TILE_ROWS,
    measured: DataFrame | None = None,
) -> Linking:
    """Enough to connect what is connected: groups tied through pivots, and the pairs left to score.

    ``measured``: the placed representatives with their pivots, if they are at hand.
    """
    groups, keyed = _grouped(reps, floor, min(crowd_rows, tile_rows), measured)
    return Linking(groups, _open_pairs(keyed, floor, tile_rows))


def _grouped(reps: DataFrame, floor: float, crowd_rows: int, measured: DataFrame | None) -> tuple[DataFrame, JoinRows]:
    """``(id, group)`` of the representatives tied through pivots, and all of them ready to be joined."""
    placed, paths = _measured(reps, floor) if measured is None else (measured, [])
    groups = connected_components(tie(placed, _HISTOGRAM, SIMILARITY, paths)).select("id", F.col("cluster_id").alias("group"))
    celled = cells(placed, floor).drop("pivot_ids", "alike")
    grouped = celled.join(groups, "id", "left").withColumn("group", F.coalesce("group", "id"))
    paths.append(scratch_path(reps.sparkSession))
    keyed = _keyed(main_groups(materialize(grouped, paths[-1])), floor, crowd_rows)
    for path in paths:
        discard(reps.sparkSession, path)
    return groups, keyed


def representative_clusters(
    reps: DataFrame,
    floor: float,
    crowd_rows: int = CROWD_ROWS,
    tile_rows: int = TILE_ROWS,
    measured: DataFrame | None = None,
) -> DataFrame:
    """``(id, cluster_id)`` of the representatives that match another one."""
    groups, keyed = _grouped(reps, floor, min(crowd_rows, tile_rows), measured)
    found = _open_matches(keyed, floor, tile_rows)
    joined = connected_components(found.select(F.col("lgroup").alias("lid"), F.col("rgroup").alias("rid")))
    tied = lookup(groups.withColumnRenamed("group", "cluster_id"), "cluster_id", joined, "cluster_id")
    untied = joined.join(groups.select("id"), "id", "left_anti")
    return tied.select("id", "cluster_id").unionByName(untied.select("id", "cluster_id"))


def similar_clusters(
    products: DataFrame,
    keys: Sequence[str],
    text: str,
    threshold: Threshold,
    prior: DataFrame | None = None,
    crowd_rows: int = CROWD_ROWS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Cluster records whose similarity chains reach each other: ``(id, cluster_id)``.

    The transitive closure of all similar pairs, named by its smallest id.
    Records without any match are left out. Earlier links (``prior``, with
    ``lid`` and ``rid``) are kept and may join clusters.
    """
    prints, reps = _prepare(products, keys, text, threshold)
    labels = representative_clusters(reps, threshold.floor, crowd_rows, tile_rows)
    if prior is not None:
        links = labels.select(F.col("cluster_id").alias("lid"), F.col("id").alias("rid"))
        links = links.unionByName(copy_edges(prints, reps).select("lid", "rid"))
        return connected_components(links.unionByName(prior.select("lid", "rid")))
    return named_members(prints, reps, labels)


def named_members(prints: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    """``(id, cluster_id)`` of all records that match another one, by their representatives' clusters."""
    named = (
        reps.withColumnRenamed("id", "rep")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .where((F.col("copies") > 1) | F.col("cluster_id").isNotNull())
        .select("block", "hist", F.coalesce("cluster_id", "rep").alias("cluster_id"))
    )
    return prints.join(named, ["block", "hist"]).select("id", "cluster_id")


def baseline_matches(
    products: DataFrame,
    text: str,
    min_score: float = fixed.BASELINE_THRESHOLD,
    max_rows: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Pairs sharing a baseline key, ranked by token overlap: ``(lid, rid, similarity)``.

    Lists what :func:`baseline_classes` found, as many rows as there are such pairs.
    Complete by default; only a caller who asks for it (``max_rows``) skips keys with that
    many records or more.
    """
    found = baseline_classes(products, text, min_score, tile_rows, max_rows)
    members, links = materialize(found.members), materialize(found.links)
    half = _by_member(links.select("lid", "rid", "similarity"), "lid", members, "a", tile_rows)
    return (
        _by_member(materialize(half), "rid", members, "b", tile_rows)
        .where("a <> b and (lid <> rid or a < b)")
        .select(F.least("a", "b").alias("lid"), F.greatest("a", "b").alias("rid"), "similarity")
        .orderBy(F.desc("similarity"), F.desc("lid"), F.desc("rid"))
    )


def _by_member(links: DataFrame, side: str, members: DataFrame, name: str, tile_rows: int) -> DataFrame:
    """Each row once per member of the class it names; large classes and much linked ones are dealt to tiles."""
    linked = links.withColumn("key", F.col(side)).withColumn("salt", F.xxhash64(*links.columns))
    named = members.select(F.col("class_id").alias("key"), F.col("id").alias(name), F.col("id").alias("salt"))
    left, right = spread(linked, named, "key", "salt", tile_rows)
    met = left.drop("salt").join(right.drop("salt"), ["key", "left_tile", "right_tile"])
    return met.select(*links.columns, name)


def baseline_links(
    products: DataFrame, text: str, min_score: float = fixed.BASELINE_THRESHOLD, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """What :func:`baseline_matches` stands for, without listing copies pair by pair: ``(lid, rid, similarity)``.

    Every match between different classes as one row of their names, and one row of similarity 1
    from each further member to the class it is in. Ranked like the listing.
    """
    found = baseline_classes(products, text, min_score, tile_rows)
    across = found.links.where("lid <> rid").select("lid", "rid", "similarity")
    copies = found.members.where("id <> class_id").select(
        F.col("class_id").alias("lid"), F.col("id").alias("rid"), F.lit(1.0).alias("similarity")
    )
    return across.unionByName(copies).orderBy(F.desc("similarity"), F.desc("lid"), F.desc("rid"))


@dataclass(frozen=True)
class BaselineClasses:
    """Baseline matches without listing pairs.

    ``members``: ``(id, class_id)``, records of one key with equal token sets, named by the
    smallest. ``links``: ``(lid, rid, similarity, pairs)``, classes similar enough and the
    record pairs this stands for; a class of several records is linked with itself.
    """

    members: DataFrame
    links: DataFrame


def baseline_classes(
    products: DataFrame,
    text: str,
    min_score: float = fixed.BASELINE_THRESHOLD,
    tile_rows: int = TILE_ROWS,
    max_rows: int | None = None,
) -> BaselineClasses:
    """Records sharing a baseline key, matched by token overlap class by class.

    An overlap of at least t times the larger set means that two sets share one of their
    first ``size - ceil(t * size) + 1`` tokens in any common order; rare tokens come first
    in it. Only classes that meet at such a token are compared, once, at the first one.
    ``max_rows``: keys with that many records or more are skipped, if asked for.
    """
    tokens = F.sort_array(name_tokens(F.col(text)))
    keyed = materialize(baseline_blocks(products, text).select(F.col("block_key").alias("key"), "id", tokens.alias("tokens")))
    if max_rows is not None:
        rare = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < max_rows).select("key")
        keyed = materialize(keyed.join(rare, "key", "left_semi"))
    classes = materialize(
        keyed.groupBy("key", "tokens").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    )
    few = checked_broadcast(classes.select("key", "tokens", "class_id"))
    members = keyed.join(few, ["key", "tokens"]).select("id", "class_id")

    single = classes.select("key", "class_id", F.explode("tokens").alias("token"))
    frequency = single.groupBy("key", "token").agg(F.count(F.lit(1)).alias("f"))
    ordered = single.join(frequency, ["key", "token"]).groupBy("class_id").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("o"))
    size = F.size("tokens")
    reach = size - F.ceil(size * F.lit(min_score) - 1e-9).cast("int") + 1
    prefixed = materialize(
        classes.join(ordered, "class_id").select(
            "key", "class_id", "n", "tokens", F.slice(F.transform("o", lambda x: x["token"]), F.lit(1), reach).alias("prefix")
        )
    )
    at_token = materialize(prefixed.withColumn("token", F.explode("prefix")).withColumn("key", F.struct("key", "token")))
    left, right = spread(at_token, at_token, "key", "class_id", tile_rows)
    renamed = lambda side, p: side.withColumnsRenamed({c: p + c for c in ("class_id", "n", "tokens", "prefix")})
    overlap = token_overlap(F.col("l_tokens"), F.col("r_tokens"))
    first = F.get(F.array_intersect("l_prefix", "r_prefix"), F.lit(0)) == F.col("token")
    sizes_fit = F.least(F.size("l_tokens"), F.size("r_tokens")) >= F.greatest(F.size("l_tokens"), F.size("r_tokens")) * min_score - 1e-9
    across = (
        renamed(left, "l_")
        .join(renamed(right, "r_").drop("token"), ["key", "left_tile", "right_tile"])
        .where((F.col("l_class_id") < F.col("r_class_id")) & sizes_fit & first)
        .select(
            F.col("l_class_id").alias("lid"),
            F.col("r_class_id").alias("rid"),
            overlap.alias("similarity"),
            (F.col("l_n") * F.col("r_n")).alias("pairs"),
        )
        .where(F.col("similarity") >= min_score)
    )
    inner = classes.where("n > 1").select(
        F.col("class_id").alias("lid"), F.col("class_id").alias("rid"), F.lit(1.0).alias("similarity"), pairs_among("n").alias("pairs")
    )
    return BaselineClasses(members, across.unionByName(inner))


def ranked_links(links: DataFrame) -> DataFrame:
    """Links with their ``rank``: most similar first, then larger ids first."""
    return with_rank(links, [F.desc("similarity"), F.desc("lid"), F.desc("rid")])
