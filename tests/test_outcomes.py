"""Outcome cells, closed profiles, class links and global ranks against brute force."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairwright.functions.text import words
from pairwright.operators import evaluate, matching, profile, ranking
from pairwright.operators.keys import baseline_key
from pairwright.operators.cluster import connected_components
from pairwright.plans import catalog, pipelines
from pairwright.sources import store


def pairs(spark, rows):
    return spark.createDataFrame(rows, "lid long, rid long")


def clusters(spark, groups):
    return spark.createDataFrame([(i, min(g)) for g in groups for i in g], "id long, cluster_id long")


def closed(groups):
    return {(a, b) for g in groups for a, b in itertools.combinations(sorted(g), 2)}


def random_groups(rnd, ids):
    ids = list(ids)
    rnd.shuffle(ids)
    groups = []
    while ids:
        n = rnd.choice([2, 2, 3, 5, 9])
        groups.append(ids[:n])
        ids = ids[n:]
    return [g for g in groups if len(g) > 1]


def test_cells_hold_all_outcomes(spark):
    rnd = random.Random(3)
    truth, found = random_groups(rnd, range(60)), random_groups(rnd, range(20, 80))
    members = evaluate.outcome_members(clusters(spark, truth), clusters(spark, found)).cache()
    row = evaluate.cell_metrics(evaluate.outcome_cells(members)).first()
    t, f = closed(truth), closed(found)
    assert (row.tp, row.fp, row.fn) == (len(t & f), len(f - t), len(t - f))
    for outcome, wanted in (("true_positive", t & f), ("false_positive", f - t), ("false_negative", t - f)):
        for tile in (4096, 2):
            got = [tuple(r) for r in evaluate.outcome_pairs(members, outcome, tile).collect()]
            assert len(got) == len(wanted) and set(got) == wanted
    assert row.f1 == evaluate.evaluate_clusters(clusters(spark, truth), clusters(spark, found)).first().f1


def test_link_and_score(spark, tmp_path):
    products = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id long, name string")
    found = clusters(spark, [[0, 1, 2], [4, 5]])
    row = pipelines.link_and_score(found, pairs(spark, [(1, 0), (3, 4)]), products, str(tmp_path / "r"), {"read_limit": 6}).first()
    assert (row.tp, row.fp, row.fn) == (1, 3, 1)
    manifest = store.latest(spark, str(tmp_path / "r"))
    rows = {r.id: (r.truth_cluster, r.found_cluster, r.name) for r in store.read_table(spark, manifest, "members").collect()}
    assert rows == {0: (0, 0, "p0"), 1: (0, 0, "p1"), 2: (None, 0, "p2"), 3: (3, None, "p3"), 4: (3, 4, "p4"), 5: (None, 4, "p5")}
    empty = pipelines.link_and_score(found.limit(0), pairs(spark, []), products, str(tmp_path / "e"), {}).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, 0)


def test_closed_profile(spark):
    rnd = random.Random(9)
    groups = random_groups(rnd, range(120)) + [list(range(200, 260))]
    name = lambda: rnd.choice([None, "", "Red ring 5", "red RING", "blue nut x", "ring ring", " - "])
    price = lambda: rnd.choice([None, 0.0, -2.0, 1.5, 9.75, float("nan"), 100.0, rnd.random() * 50])
    rows = [(i, name(), price(), rnd.choice([None, "", "A", "a", "b"]), name()) for g in groups for i in g if i % 17]
    products = spark.createDataFrame(rows, "id long, name string, price double, brand string, description string")
    truth = pairs(spark, [(b, a) for g in groups for a, b in zip(g, g[1:])])
    got = profile.closed_truth_means(truth, products, ("name", "description"), True).first()
    listed = pairs(spark, sorted(closed(groups)))
    prepared = products.withColumn("price", F.when(~F.isnan("price"), F.col("price")))
    wanted = profile.profile_means(profile.pair_profile(listed, prepared, ("name", "description"), True)).first()
    for c in ("pairs", "price_diff", "price_rel_diff", "brand_match", "name_token_overlap", "description_token_overlap"):
        assert got[c] == pytest.approx(wanted[c]), c
    none = profile.closed_truth_means(truth.limit(0), products, ("name",), True).first()
    assert none.pairs == 0 and none.price_diff is None and none.name_token_overlap is None


def test_ranks_and_running_sums(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice("ab" * 9 + "c"), rnd.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, x long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges
    try:
        ranked = {r.id: r["rank"] for r in ranking.with_rank(df, [F.desc("x"), F.asc("id")]).collect()}
        summed = {r.id: (r.n, r.s) for r in ranking.with_running_sums(df, "g", F.col("id"), {"n": F.lit(1), "s": F.col("x")}).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert ranked == {r[0]: i + 1 for i, r in enumerate(order)}
    for i, g, _ in rows:
        before = [r for r in rows if r[1] == g and r[0] < i]
        assert summed[i] == (len(before), sum(r[2] for r in before))
    assert ranking.with_rank(df.limit(0), [F.asc("id")]).count() == 0


@pytest.mark.parametrize("score, tile", [(0.5, 4096), (0.8, 3), (1.0, 4096)])
def test_baseline_classes(spark, score, tile):
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(9)] + ["Pad x1", "pad x1", "book y2"]
    rows = [(i, " ".join([rnd.choice(["pad x1", "book y2", "Pad X1", "none"]), *rnd.choices(vocabulary, k=rnd.randrange(6))])) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "pad x1"), (503, "PAD x1")]
    products = spark.createDataFrame(rows, "id long, name string")
    keys = {r.id: r.k for r in products.select("id", baseline_key(F.col("name")).alias("k")).collect()}
    found = matching.baseline_classes(products, "name", score, tile)
    class_of = {r.id: r.class_id for r in found.members.collect()}
    tokens = {i: frozenset((t or "nan").lower().split()) for i, t in rows}
    assert set(class_of) == {i for i, k in keys.items() if k}
    links = {(r.lid, r.rid): (r.similarity, r.pairs) for r in found.links.collect()}
    assert len(links) == found.links.count()
    wanted = {}
    for a, b in itertools.combinations(sorted(class_of), 2):
        if keys[a] == keys[b]:
            s = len(tokens[a] & tokens[b]) / max(len(tokens[a]), len(tokens[b]))
            if s >= score:
                link = tuple(sorted((class_of[a], class_of[b])))
                wanted[link] = (s, wanted.get(link, (s, 0))[1] + 1)
    assert links == wanted
    listed = matching.baseline_matches(products, "name", score).select("lid", "rid")
    truth = pairs(spark, [(1, 2), (2, 1), (1, 2), (502, 503), (500, 501), (4, 90), (None, 3)])
    got = evaluate.evaluate_links(truth, found.links, found.members).first()
    assert tuple(got) == pytest.approx(tuple(evaluate.evaluate_baseline(truth, listed).first()))


def test_baseline_links_tie_copies_to_their_class(spark):
    """A thousand copies of two names are a thousand rows, not half a million, and lose no link."""
    rows = [(i, "pad x1 blue" if i % 2 else "Pad x1 red") for i in range(1000)] + [(2000, "pad x1 blue small thing"), (2001, None)]
    found = matching.baseline_links(spark.createDataFrame(rows, "id long, name string"), "name", 0.6)
    got = {(r.lid, r.rid): r.similarity for r in found.collect()}
    wanted = {(i % 2, i): 1.0 for i in range(2, 1000)} | {(0, 1): 2 / 3, (1, 2000): 3 / 5}
    assert found.count() == len(got) and got == pytest.approx(wanted)


def test_baseline_query_lists_every_pair(spark, tmp_path):
    """Thirty parts of one name are 435 pairs, and each of them meets the three others of its key."""
    rows = [(30 * i, "jar x1") for i in range(1, 31)] + [(930, "red jar x1"), (960, "red jar x1"), (7, "jar x1")]
    parts = spark.createDataFrame(rows, "p_partkey long, p_name string").withColumn("p_retailprice", F.lit(1.0))
    parts.write.parquet(str(tmp_path / "part.parquet"))
    found = catalog.baseline_matches_products(spark, str(tmp_path))
    got = {(r.lid, r.rid): r.similarity for r in found.collect()}
    many = [30 * i for i in range(1, 31)]
    wanted = {p: 1.0 for p in itertools.combinations(many, 2)} | {(930, 960): 1.0}
    wanted |= {(i, j): 0.857143 for i in many for j in (930, 960)}
    wanted |= {(7, i): 0.666667 for i in many} | {(7, j): 0.571429 for j in (930, 960)}
    assert found.count() == len(got) and got == pytest.approx(wanted)


def test_listing_deals_large_classes(spark):
    """A class of many members and many links is listed whole from tiles; repeated and missing ids are no pairs."""
    rows = [(i, "pad x1 blue") for i in range(60)] + [(100 + i, f"pad x1 w{i}") for i in range(60)]
    rows += [(0, "pad x1 blue"), (None, "pad x1 blue"), (None, "pad x1 w1")]
    products = spark.createDataFrame(rows, "id long, name string")
    got = Counter((r.lid, r.rid) for r in matching.baseline_matches(products, "name", 0.6, tile_rows=8).collect())
    ids = [i for i, _ in rows if i is not None]
    assert got == Counter((a, b) for a, b in itertools.combinations(sorted(ids), 2) if a < b)
