"""Matching and clustering against brute force on small fixtures."""

import itertools
import pathlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pairwright import session
from pairwright.operators import cluster, dense, matching, pivots, tiles
from pairwright.operators.blocking import block_pairs
from pairwright.operators.cluster import cluster_members, connected_components, expand_pairs, with_singletons
from pairwright.operators.matching import Threshold, similar_clusters, similar_pairs


def jaccard(a, b):
    ca, cb = Counter(a.lower()), Counter(b.lower())
    low = sum((ca & cb).values())
    high = sum((ca | cb).values())
    return 1.0 if high == 0 else low / high


def closure(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a)
        label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def brute_edges(rows, t):
    blocks = defaultdict(list)
    for i, k1, k2, text in rows:
        blocks[(k1, k2)].append((i, text))
    edges = {}
    for members in blocks.values():
        for (a, x), (b, y) in itertools.combinations(sorted(members), 2):
            s = jaccard(x, y)
            if s >= t:
                edges[(a, b)] = s
    return edges


def corpus(n, seed, short):
    rng = random.Random(seed)
    alphabet = "abcdefghij klmnop éß😀-0123456789"
    families = ["".join(rng.choice(alphabet) for _ in range(rng.randint(3, 60 if short else 400))) for _ in range(8)]
    rows = []
    for i in range(n):
        base = list(families[0] if rng.random() < 0.4 else rng.choice(families))
        for _ in range(rng.randint(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(alphabet)
        text = "".join(base)
        if rng.random() < 0.05:
            text = ""
        rows.append((i, rng.choice([None, "x"]), rng.choice([None, "x", "x", "x"]), text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, k1 string, k2 string, text string")


@pytest.mark.parametrize("t, short, crowd, tile", [(0.85, True, 4096, 4096), (0.85, True, 5, 4096), (0.925, True, 5, 7), (0.925, False, 5, 7)])
def test_pairs_equal_brute_force(spark, t, short, crowd, tile):
    rows = corpus(150, 3, short)
    expected = brute_edges(rows, t)
    got = similar_pairs(frame(spark, rows), ["k1", "k2"], "text", Threshold(t), crowd, tile).collect()
    found = {(r.lid, r.rid): r.score for r in got}
    assert len(found) == len(got)
    texts = {i: (k1, k2, tuple(sorted(text.lower()))) for i, k1, k2, text in rows}
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    wanted = {}
    for (a, b), s in expected.items():
        if texts[a] == texts[b]:
            if first[texts[a]] == a:
                wanted[(a, b)] = s
        elif first[texts[a]] == a and first[texts[b]] == b:
            wanted[(a, b)] = s
    assert found == pytest.approx(wanted)
    assert closure(list(found)) == closure(list(expected))


@pytest.mark.parametrize("short, crowd, tile", [(True, 1024, 4096), (False, 3, 6)])
def test_clusters_equal_brute_force(spark, short, crowd, tile):
    rows = corpus(250, 11, short)
    expected = closure(list(brute_edges(rows, 0.9)))
    got = similar_clusters(
        frame(spark, rows), ["k1", "k2"], "text", Threshold(0.9), crowd_rows=crowd, tile_rows=tile
    ).collect()
    assert {r.id: r.cluster_id for r in got} == expected
    assert len(got) == len(expected)


@pytest.fixture
def many_pivots(monkeypatch):
    """Pivots, ties, cells and main groups already in small blocks."""
    for name, value in {"CROWDED_ROWS": 3, "MAIN_ROWS": 2, "MIN_CELLS": 1}.items():
        monkeypatch.setattr(pivots, name, value)


@pytest.mark.parametrize("short, crowd, tile", [(False, 1024, 4096), (True, 3, 6)])
def test_pivots_lose_nothing(spark, many_pivots, short, crowd, tile):
    rows = corpus(250, 11, short)
    expected = brute_edges(rows, 0.9)
    got = similar_clusters(frame(spark, rows), ["k1", "k2"], "text", Threshold(0.9), None, crowd, tile).collect()
    assert {r.id: r.cluster_id for r in got} == closure(list(expected))
    edges = similar_pairs(frame(spark, rows), ["k1", "k2"], "text", Threshold(0.9), crowd, tile).collect()
    assert {(r.lid, r.rid) for r in edges} <= set(expected)
    assert closure([(r.lid, r.rid) for r in edges]) == closure(list(expected))


def test_pivots_tie_and_rule_out(spark, many_pivots):
    rows = corpus(250, 11, False)
    _, reps = matching._prepare(frame(spark, rows), ["k1", "k2"], "text", Threshold(0.9))
    linking = matching.linking_candidates(reps, 0.9)
    assert linking.groups.count() > 0
    assert linking.near.count() < matching.all_candidates(reps, 0.9).count() / 4


@pytest.mark.parametrize("short, crowd, tile", [(True, 5, 40), (False, 1024, 4096)])
def test_dense_keys_are_compared_in_tiles(spark, monkeypatch, short, crowd, tile):
    """Every key goes through tiles, also with many rare characters and with texts too long for small numbers."""
    monkeypatch.setattr(dense, "DENSE_PAIRS", 0)
    monkeypatch.setattr(dense, "_RARE_COLUMNS", 4)
    monkeypatch.setattr(dense, "_CELLS", 64)
    rows = corpus(150, 3, short)
    rows += [(200 + i, "x", "x", "é" * (9000 + 200 * i) + "".join(map(chr, range(0x4E00, 0x4E00 + 90 * i)))) for i in range(8)]
    expected = brute_edges(rows, 0.9)
    products = frame(spark, [*rows, (None, "x", "x", rows[0][3])])
    got = similar_pairs(products.where("id is not null"), ["k1", "k2"], "text", Threshold(0.9), crowd, tile)
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().executedPlan().toString()
    found = {(r.lid, r.rid): r.score for r in got.collect()}
    assert set(found) <= set(expected) and found == pytest.approx({k: expected[k] for k in found})
    assert closure(list(found)) == closure(list(expected))
    clusters = similar_clusters(products, ["k1", "k2"], "text", Threshold(0.9), None, crowd, tile).where("id is not null").collect()
    assert {r.id: r.cluster_id for r in clusters} == closure(list(expected))


@pytest.mark.skipif(not pathlib.Path("/root/testdata/sf0.1").exists(), reason="no test data")
def test_candidates_grow_about_as_the_documents(spark):
    counts = []
    for folder, share in (("sf0.01", 1), ("sf0.1", 2)):
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").where(F.xxhash64("doc_id") % share == 0)
        docs = docs.select(F.col("doc_id").alias("id"), "lang", "text")
        _, reps = matching._prepare(docs, ["lang"], "text", matching.UNSTRUCTURED)
        counts.append((docs.count(), matching.linking_candidates(reps, matching.UNSTRUCTURED.floor).near.count()))
    (few, small), (many, large) = counts
    print(counts)
    assert 4.8 * few < many < 5.2 * few and large <= 7 * small


FIXTURE = [
    (1, "1", None, "stone"),
    (2, "1", None, "ONSET"),
    (3, "1", None, "brick"),
    (4, "2", None, "x" * 19 + "y"),
    (5, "2", None, "x" * 19),
]


def test_fixture_matches(spark):
    got = similar_pairs(frame(spark, FIXTURE), ["k1", "k2"], "text", Threshold(0.925)).collect()
    assert {(r.lid, r.rid): r.score for r in got} == pytest.approx({(1, 2): 1.0, (4, 5): 19 / 20})


def test_incremental(spark):
    prior = spark.createDataFrame([(1, 3)], "lid long, rid long")
    got = similar_clusters(frame(spark, FIXTURE), ["k1", "k2"], "text", Threshold(0.925), prior).collect()
    assert {r.id: r.cluster_id for r in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_large_blocks_ask_for_more(spark):
    rows = FIXTURE[3:] + [(i, "2", None, f"{chr(97 + i)}" * 40) for i in range(6, 9)]
    small = Threshold(0.925, 0.99, 5)
    big = Threshold(0.925, 0.99, 4)
    assert similar_pairs(frame(spark, rows), ["k1", "k2"], "text", small).count() == 1
    assert similar_pairs(frame(spark, rows), ["k1", "k2"], "text", big).count() == 0


def test_block_pairs_spread_over_tiles(spark):
    rows = corpus(60, 5, True)
    df = frame(spark, rows)
    blocks = defaultdict(list)
    for i, k1, k2, _ in rows:
        blocks[(k1, k2)].append(i)
    expected = {p for ids in blocks.values() for p in itertools.combinations(sorted(ids), 2)}
    for tile in (4096, 5):
        got = [(r.lid, r.rid) for r in block_pairs(df, ["k1", "k2"], tile).collect()]
        assert len(got) == len(expected) and set(got) == expected


def test_components(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("D", "D"), (None, "A")], "lid string, rid string")
    got = {r.id: r.cluster_id for r in connected_components(edges).collect()}
    assert got == {"A": "A", "B": "A", "C": "A"}
    ids = spark.createDataFrame([("A",), ("D",)], "id string")
    all_ids = with_singletons(connected_components(edges), ids)
    assert {(r.id, r.cluster_id) for r in all_ids.collect()} == {("A", "A"), ("D", "D")}


@pytest.mark.parametrize("last", [0, 40, 20_000])
def test_components_random_and_chain(spark, monkeypatch, last):
    monkeypatch.setattr(cluster, "LAST_EDGES", last)
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in rng.sample(range(100), 100)]
    edges += [(2000, 2001 + i) for i in range(50)]
    got = {r.id: r.cluster_id for r in connected_components(spark.createDataFrame(edges, "lid long, rid long")).collect()}
    expected = closure([e for e in edges if e[0] != e[1]])
    assert got == expected


def test_members_and_pairs(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (8, 7)], "lid long, rid long")
    clusters = connected_components(edges)
    assert [(r.cluster_id, r.id) for r in cluster_members(clusters).collect()] == [(1, 1), (1, 2), (1, 3), (7, 7), (7, 8)]
    pairs = {(r.lid, r.rid) for r in expand_pairs(clusters).collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3), (7, 8)}
    assert {(r.lid, r.rid) for r in expand_pairs(clusters, tile_rows=1).collect()} == pairs


def test_no_edges(spark):
    empty = spark.createDataFrame([], "lid long, rid long")
    assert connected_components(empty).count() == 0
    assert tiles.hot_groups(spark.createDataFrame([(1,)], "key int"), "key", 5) is None


def test_rows_meet_all_pivots_at_once(spark, monkeypatch, many_pivots):
    """The matrices' similarities are those of the expression, with rare characters, few pivots and keys without any."""
    rows = corpus(120, 5, False) + [(900 + i, "r", None, "é€" * i + "a" * 40 + "\U0001f600") for i in range(6)] + [(990, "s", "s", "alone")]
    _, reps = matching._prepare(frame(spark, rows), ["k1", "k2"], "text", Threshold(0.9))
    placed = matching._place(reps, 0.9)
    drawn = pivots.draw(placed, matching._HISTOGRAM)
    compare = lambda: pivots.compare(placed, drawn, matching._HISTOGRAM, matching.SIMILARITY)
    columns = "id", "key", "pivot_ids", "alike", *pivots.PIVOTS
    got = compare().select(*columns)
    monkeypatch.setattr(pivots, "PIVOT_KEYS", 0)
    wanted = compare().select(*columns)
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    ordered = [sorted(df.collect(), key=str) for df in (got, wanted)]
    assert ordered[0] == ordered[1] and any(r.alike is None for r in ordered[0]) and any(len(r.alike or "") == 16 for r in ordered[0])


def test_large_dense_keys_have_large_tiles(spark, monkeypatch):
    """A key of many rows is listed bit by bit from tiles that leave few copies of a row, and loses no match."""
    asked = []
    for name, value in {"DENSE_PAIRS": 0, "DENSE_TILE_ROWS": 8, "_CELLS": 64, "_OPEN_PAIRS": 50, "_LISTED_PAIRS": 7}.items():
        monkeypatch.setattr(dense, name, value)
    monkeypatch.setattr(dense, "spread", lambda *a: asked.append(a[-1]) or tiles.spread(*a))
    rng = random.Random(8)
    rows = [(i, "x", "x", "".join(rng.choice("abcdeé€") for _ in range(30)) + "k" * 300) for i in range(200)]
    got = similar_pairs(frame(spark, rows), ["k1", "k2"], "text", Threshold(0.97))
    assert "FlatMapGroupsInArrow" in got._jdf.queryExecution().executedPlan().toString()
    expected = brute_edges(rows, 0.97)
    found = {(r.lid, r.rid): r.score for r in got.collect()}
    copies = {(i, j) for i, j in expected if Counter(rows[i][3]) == Counter(rows[j][3])}
    assert len(expected) > 500 and found == pytest.approx({k: v for k, v in expected.items() if k not in copies or k in found})
    assert len(asked) == 1 and asked[0] > 16


@pytest.mark.parametrize("cluster", [False, True])
def test_superseded_tables_are_deleted(spark, many_pivots, cluster):
    """Rows on their way to the join are kept once."""
    folder = pathlib.Path(session.run_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    run = similar_clusters if cluster else similar_pairs
    found = run(frame(spark, corpus(150, 2, False)), ["k1", "k2"], "text", Threshold(0.9))
    assert found.count() > 0
    kept = [set(spark.read.parquet(str(f)).columns) for f in set(folder.iterdir()) - before]
    assert sum("sum_rare" in c and "id" in c for c in kept) == 1 and not any("ranked" in c for c in kept)
