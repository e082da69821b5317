"""Readers, writers, blocking, evaluation and profiles on small fixtures."""

import itertools
import pathlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pairwright.operators import blocking, evaluate, profile
from pairwright.operators.cluster import connected_components, expand_pairs
from pairwright.operators.matching import baseline_matches
from pairwright.plans import pipelines
from pairwright.sources import sinks, tables

PAIR = "lid long, rid long"


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIR)


def as_list(df):
    return [tuple(r) for r in df.collect()]


def test_truth_orientation_and_limit(spark):
    rows = [(1, 5), (2, 4), (7, 10), (8, 9), (None, None)]
    assert as_list(tables.truth_pairs(pairs(spark, rows), 10)) == [(1, 5), (2, 4), (None, None)]
    assert as_list(tables.truth_pairs(pairs(spark, [(5, 1), (2, 4)]))) == [(1, 5), (2, 4)]
    assert as_list(tables.truth_pairs(pairs(spark, [(None, 3), (9, None)]))) == [(9, None), (None, 3)]


def test_choose_dataset():
    assert tables.choose({1: "a"}, 1) == "a"
    with pytest.raises(ValueError):
        tables.choose({1: "a"}, 3)


def test_csv_products(spark, tmp_path):
    path = tmp_path / "z2.csv"
    path.write_text('name,id,price\n"a ""quoted""\nline, x",2,1.5\nb,1,\n', encoding="utf-8")
    read = tables.read_products(spark, str(path), tables.STRUCTURED_SCHEMA)
    assert read.columns == ["id", "name", "price", "brand", "description", "category"]
    assert as_list(read.orderBy("id").select("id", "name", "price", "brand")) == [
        (1, "b", None, None), (2, 'a "quoted"\nline, x', 1.5, None),
    ]
    assert as_list(tables.read_products(spark, str(path), tables.STRUCTURED_SCHEMA, 1).select("id")) == [(1,)]


def test_truth_file(spark, tmp_path):
    path = tmp_path / "zy.csv"
    path.write_text("rid,lid\n1,5\n4,2\n", encoding="utf-8")
    assert as_list(tables.read_truth(spark, str(path))) == [(1, 5), (2, 4)]


def test_result_with_footer_line(spark, tmp_path):
    path = tmp_path / "result_data.csv"
    path.write_text("lid,rid\n5,1\n2,4\n# Zeilenanzahl: 10 Data: 1\n", encoding="utf-8")
    found, footer = tables.read_results(spark, str(path))
    assert as_list(found) == [(1, 5), (2, 4)]
    assert footer == "# Zeilenanzahl: 10 Data: 1"


def test_missing_results(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_results(spark, str(tmp_path / "none"))


def test_result_roundtrip_and_settings(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_pairs(pairs(spark, [(5, 1), (2, 4)]), path, 10, 1)
    found, settings = tables.read_results(spark, path)
    assert as_list(found) == [(1, 5), (2, 4)]
    assert settings == {"read_limit": 10, "dataset": 1}
    assert pipelines.results_are_current(spark, path, 10, 1)
    assert not pipelines.results_are_current(spark, path, None, 1)
    assert not pipelines.results_are_current(spark, str(tmp_path / "none"), None, 1)


def test_empty_result_has_a_header(spark, tmp_path):
    path = tmp_path / "empty"
    sinks.write_pairs(pairs(spark, []), str(path), None, 2)
    text = "".join(p.read_text() for p in path.glob("*.csv"))
    assert text == "lid,rid\n"
    assert as_list(tables.read_results(spark, str(path))[0]) == []


def test_only_dataframes_are_written(tmp_path):
    with pytest.raises(TypeError):
        sinks.write_table([1, 2], str(tmp_path / "x"))


def test_write_blocks(spark, tmp_path):
    rows = spark.createDataFrame([(i, "k" if i % 2 else None) for i in range(20)], "id long, k string")
    sinks.write_blocks(rows, ["k"], str(tmp_path / "blocks"), {"a": 1})
    back = spark.read.option("header", True).csv(str(tmp_path / "blocks"))
    assert back.count() == 20
    assert tables.read_metadata(spark, str(tmp_path / "blocks")) == {"a": 1}


def test_adaptive_blocks_equal_recursion(spark):
    rng = random.Random(4)
    rows = [(i, *(rng.choice([None, "a", "b", "c"]) for _ in range(3))) for i in range(120)]
    keys = ["x", "y", "z"]

    def split(members, depth):
        groups = {}
        for r in members:
            groups.setdefault(r[depth + 1], []).append(r)
        out = []
        for g in groups.values():
            out += split(g, depth + 1) if len(g) > 10 and depth + 1 < len(keys) else [frozenset(r[0] for r in g)]
        return out

    df = spark.createDataFrame(rows, "id long, x string, y string, z string")
    got = {}
    for r in blocking.adaptive_blocks(df, keys, 10).collect():
        got.setdefault(r.block, set()).add(r.id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, split(rows, 0)))


def test_baseline_matches(spark):
    names = ["think x1 a b", "think x1 a c", "think x1", "other y2", None, "common z9"] + ["common z9"] * 120
    rows = list(enumerate(names))
    expected = []
    for (i, a), (j, b) in itertools.combinations(rows, 2):
        if a and b and a.split()[:2] == b.split()[:2]:
            s, u = set(a.split()), set(b.split())
            if len(s & u) / max(len(s), len(u)) >= 0.5:
                expected.append((len(s & u) / max(len(s), len(u)), i, j))
    got = as_list(baseline_matches(spark.createDataFrame(rows, "id long, name string"), "name"))
    assert got == [(i, j, s) for s, i, j in sorted(expected, reverse=True)]
    products = spark.createDataFrame(rows, "id long, name string")
    assert as_list(baseline_matches(products, "name", tile_rows=16)) == got
    assert {j for _, j, _ in as_list(baseline_matches(products, "name", max_rows=100))} == {1, 2}


TRUTH = [(1, 101), (2, 102), (3, 103)]


@pytest.mark.parametrize(
    "known, found, f1",
    [
        (TRUTH, [(1, 101), (2, 102), (4, 999)], 2 / 3),
        (TRUTH, TRUTH, 1.0),
        (TRUTH, [(999, 999), (888, 888)], 0.0),
        (TRUTH, [], 0.0),
        ([], TRUTH, 0.0),
    ],
)
def test_f1(spark, known, found, f1):
    got = evaluate.evaluate_pairs(pairs(spark, known), pairs(spark, found)).first()
    assert got.f1 == pytest.approx(f1)


def test_counted_metrics_equal_listed_pairs(spark):
    rng = random.Random(9)
    known = pairs(spark, [(rng.randrange(40), rng.randrange(40)) for _ in range(25)])
    found = pairs(spark, [(rng.randrange(40), rng.randrange(40)) for _ in range(25)])
    a = set(as_list(expand_pairs(connected_components(known))))
    b = set(as_list(expand_pairs(connected_components(found))))
    got = evaluate.evaluate_pairs(known, found).first()
    assert (got.tp, got.fp, got.fn) == (len(a & b), len(b - a), len(a - b))


def test_baseline_metrics_without_truth(spark):
    got = evaluate.evaluate_baseline(pairs(spark, []), pairs(spark, [])).first()
    assert (got.precision, got.recall, got.f1) == (0, 0, 0)


def test_outcomes_and_enrichment(spark, tmp_path):
    outcomes = evaluate.classify_pairs(pairs(spark, TRUTH), pairs(spark, [(1, 101), (4, 999), (4, 999)]))
    assert sorted(as_list(outcomes)) == [
        (1, 101, "true_positive"), (2, 102, "false_negative"), (3, 103, "false_negative"), (4, 999, "false_positive"),
    ]
    products = spark.createDataFrame([(1, "a"), (101, "b")], "id long, title string")
    enriched = evaluate.enrich_pairs(outcomes, products)
    assert enriched.columns == ["lid", "rid", "outcome", "ltitle", "rtitle"]
    assert enriched.where("lid = 1").first().asDict()["rtitle"] == "b"
    assert enriched.count() == 4
    sinks.write_evaluation(outcomes, products, str(tmp_path / "eval"))
    assert {p.name for p in (tmp_path / "eval").iterdir() if p.is_dir()} == {
        "outcome=true_positive", "outcome=false_negative", "outcome=false_positive",
    }


def test_describe(spark):
    rng = random.Random(2)
    for values in ([rng.choice([1.0, 7.5, rng.random() * 1e6]) for _ in range(997)], [3.0], [5.0] * 10, [1e-9, 1e9, -4.0, 0.0]):
        df = spark.createDataFrame([(x,) for x in values] + [(None,)], "price double")
        got = {r.statistic: r.value for r in profile.describe(df, "price").collect()}
        ordered = sorted(values)

        def quantile(q):
            place = q * (len(ordered) - 1)
            low = int(place)
            high = min(low + 1, len(ordered) - 1)
            return ordered[low] + (ordered[high] - ordered[low]) * (place - low)

        assert got["count"] == len(values)
        assert [got["25%"], got["50%"], got["75%"]] == pytest.approx([quantile(q) for q in (0.25, 0.5, 0.75)])
        assert (got["min"], got["max"]) == (min(values), max(values))
        if len(values) > 1:
            assert got["std"] == pytest.approx(statistics.stdev(values))


def test_describe_nothing(spark):
    got = {r.statistic: r.value for r in profile.describe(spark.createDataFrame([], "price double"), "price").collect()}
    assert got["count"] == 0 and got["50%"] is None


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, "A b", 1.0, "X", "b c"), (2, "a", 3.0, "x", None), (3, None, None, None, "C")],
        "id long, name string, price double, brand string, description string",
    )
    assert as_list(profile.token_frequency(df, ("name", "description"))) == [("a", 2), ("b", 2), ("c", 2)]
    assert as_list(profile.top_tokens(df, ("name", "description"), 1)) == [("a", 2)]
    assert profile.distinct_count(df, "brand", "n").first().n == 2
    assert as_list(profile.top_values(df, "brand", 1)) == [("X", 1)]
    assert tuple(profile.dataset_summary(df, "brand", ("name", "description")).first()) == (3, 2, 6)
    assert tuple(profile.dataset_summary(df.select("id", "name"), None, ("name",)).first()) == (3, 3)
    measured = profile.truth_profile(pairs(spark, [(1, 2), (2, 3)]), df, ("name", "description"), True)
    assert {(r.lid, r.rid) for r in measured.collect()} == {(1, 2), (1, 3)}
    means = profile.profile_means(measured).first()
    assert means.price_diff == 2.0 and means.price_rel_diff == pytest.approx(2 / 3)
    assert means.brand_match == pytest.approx(1 / 2)


def test_run_and_evaluate(spark, tmp_path):
    products = spark.createDataFrame(
        [(1, "Lenovo X 5"), (2, "lenovo x 5"), (3, "Lenovo x 5!"), (4, "HP y 7")], "id long, title string"
    )
    clusters = pipelines.cluster_unstructured(products, ())
    truth = pairs(spark, [(2, 1), (4, 3)])
    got = pipelines.run_and_evaluate(clusters, truth, products, str(tmp_path / "r"), str(tmp_path / "e"), None, 2)
    row = got.first()
    assert (row.tp, row.fp, row.fn) == (1, 0, 1)
    written = set(as_list(tables.read_results(spark, str(tmp_path / "r"))[0]))
    closure = set(as_list(expand_pairs(connected_components(pairs(spark, list(written))))))
    assert written == closure == {(1, 2)}


def test_run_baseline(spark):
    products = spark.createDataFrame([(1, "think x1 a"), (2, "think x1 b"), (3, "z")], "id long, name string")
    matches, metrics = pipelines.run_baseline(products, "name", pairs(spark, [(1, 2), (1, 3)]))
    assert as_list(matches.select("lid", "rid")) == [(1, 2)]
    assert metrics.first().f1 == pytest.approx(2 / 3)


def test_scratch_folder_comes_from_the_session(spark):
    from pairwright.session import materialize, run_folder, scratch_root

    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    folder = pathlib.Path(run_folder(spark))
    assert folder.parent == pathlib.Path(scratch_root(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    assert materialize(spark.range(3).select(F.col("id"))).count() == 3
    assert len(set(folder.iterdir()) - before) == 1
