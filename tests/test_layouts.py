"""Vocabularies as tables, CSV scans, sinks by layout, closure checks."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from pairwright.functions.text import remove_words, translate_terms
from pairwright.operators import normalize
from pairwright.operators.blocking import with_block_facts
from pairwright.operators.cluster import open_components
from pairwright.operators.vocabulary import remove_words_by_table, translate_by_table
from pairwright.rules import StopGroup
from pairwright.sources import tables
from pairwright.sources.sinks import write_bucketed_blocks, write_outcome

TEXTS = ["Fast SSD and ssd-card, memory  card", "memory card memory", "", None, "ÉTÉ été_x Memory\tCard", "a b c a b", "card reader memory card x", "  ", "kein wort"]
TERMS = {"SSD": "disk", "memory card": "chip", "memory": "", "été": "summer", "a b c": "abc", "b c": "no", "card reader": "$1 \\x", "unseen": "z"}


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")


@pytest.mark.parametrize("literal", [10_000, 0])
def test_translation_by_table_equals_literal(spark, literal):
    terms = spark.createDataFrame([*TERMS.items(), (None, "x"), ("memory", "")], "term string, replacement string")
    got = translate_by_table(texts(spark), "t", terms, literal).orderBy("id").collect()
    wanted = texts(spark).withColumn("t", translate_terms(F.col("t"), TERMS)).orderBy("id").collect()
    assert got == wanted
    assert translate_by_table(texts(spark), "t", terms.limit(0), literal).orderBy("id").collect() == texts(spark).collect()
    with pytest.raises(ValueError):
        translate_by_table(texts(spark), "t", spark.createDataFrame([("a-b", "c")], "term string, replacement string"))


@pytest.mark.parametrize("literal", [10_000, 0])
@pytest.mark.parametrize("edges", [True, False])
def test_stop_words_by_table_equal_literal(spark, literal, edges):
    words = ["ssd", "Card", "a", "ssd-card", "memory", "none"]
    table = spark.createDataFrame([(w,) for w in [*words, None, "a"]], "word string")
    got = remove_words_by_table(texts(spark), "t", table, edges, literal).orderBy("id").collect()
    assert got == texts(spark).withColumn("t", remove_words(F.col("t"), words, edges)).orderBy("id").collect()


def test_a_hundred_thousand_terms(spark):
    rnd = random.Random(2)
    terms = spark.range(100_000).select(F.concat(F.lit("w"), F.col("id")).alias("term"), F.concat(F.lit("r"), F.col("id")).alias("replacement"))
    rows = [(i, " ".join(f"W{rnd.randrange(200_000)}" for _ in range(30))) for i in range(50)]
    got = {r.id: r.t for r in translate_by_table(spark.createDataFrame(rows, "id long, t string"), "t", terms).collect()}
    assert got == {i: " ".join(f"r{w[1:]}" if int(w[1:]) < 100_000 else w for w in t.split()) for i, t in rows}


def test_structured_normalisation_takes_a_table(spark):
    rows = [(1, "SSD 8 card", "x", "rapide 90 mbyte/s"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "id long, name string, brand string, description string")
    dictionary = {"card": "chip", "rapide": "fast"}
    table = spark.createDataFrame(list(dictionary.items()), "term string, replacement string")
    stop = (StopGroup(("8",)),)
    assert sorted(normalize.normalize_structured(df, table, stop).collect()) == sorted(normalize.normalize_structured(df, dictionary, stop).collect())


def test_patterns_that_list_words_are_words(spark):
    df = spark.createDataFrame([(1, "der Hund und die-Katze, DAS x")], "id long, t string")
    listed = normalize.remove_stop_groups(F.col("t"), (StopGroup(("hund",), ("der|die|das", "und")),))
    pattern = normalize.remove_stop_groups(F.col("t"), (StopGroup(("hund",), ("(?:der|die|das)", "und")),))
    row = df.select(listed.alias("a"), pattern.alias("b")).first()
    assert row.a == row.b == "      die-Katze,   x"


def test_csv_lines_that_break_the_schema(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('price,id,name,extra\n1.5,1,"a, ""b""",x\nfree,2,c,x\n2.5,3,d\n,4,,\n1,x5,e,x\n7,6,f,x,y\n')
    good, bad = tables.read_products_checked(spark, str(path), tables.STRUCTURED_SCHEMA)
    assert [(r.id, r.name, r.price, r.brand) for r in good.orderBy("id").collect()] == [(1, 'a, "b"', 1.5, None), (4, None, None, None)]
    assert sorted(r.line for r in bad.collect()) == ["1,x5,e,x", "2.5,3,d", "7,6,f,x,y", "free,2,c,x"]
    assert good.count() == 2 and bad.count() == 4


def test_csv_is_split(spark, tmp_path):
    rows = spark.range(40_000).select("id", F.repeat(F.lit("x"), 50).alias("name"))
    rows.coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        good, _ = tables.read_products_checked(spark, str(tmp_path / "c"), tables.STRUCTURED_SCHEMA)
        assert good.rdd.getNumPartitions() > 4 and good.count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_limits_go_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(tables, "TOP_ROWS", 5)
    df = spark.createDataFrame([(i % 37, i) for i in range(100)], "id long, n long").repartition(6)
    got = [r.id for r in tables.first_by_id(df, 20).collect()]
    assert sorted(got) == sorted(i % 37 for i in range(100))[:20]
    assert tables.first_by_id(df, 200).count() == 100


def test_bucketed_blocks_are_joined_in_place(spark, tmp_path):
    rows = [(i, None if i % 3 else "a", i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, maker string, size int")
    keys = ("maker", "size")
    blocks = write_bucketed_blocks(df, keys, "blocks_of_test", str(tmp_path / "b"), 4)
    facts = with_block_facts(blocks, keys)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    groups = {}
    for i, *k in rows:
        groups.setdefault(tuple(k), []).append(i)
    assert {r.id: (r.block_rows, r.first_id) for r in facts.collect()} == {i: (len(g), min(g)) for g in groups.values() for i in g}


def test_one_outcome_is_replaced(spark, tmp_path):
    path = str(tmp_path / "o")
    pairs = lambda *rows: spark.createDataFrame(rows, "lid long, rid long")
    write_outcome(pairs((1, 2)), "true_positive", path)
    write_outcome(pairs((3, 4)), "false_positive", path)
    kept = {p.name for p in (pathlib.Path(path) / "outcome=true_positive").iterdir()}
    write_outcome(pairs((5, 6), (7, 8)), "false_positive", path)
    assert {p.name for p in (pathlib.Path(path) / "outcome=true_positive").iterdir()} == kept
    table = spark.read.parquet(path)
    assert {tuple(r) for r in table.collect()} == {(1, 2, "true_positive"), (5, 6, "false_positive"), (7, 8, "false_positive")}
    one = table.where("outcome = 'false_positive'")
    assert "PartitionFilters: [isnotnull(outcome" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 2


def test_open_components(spark):
    rows = [(1, 2), (2, 3), (3, 1), (1, 3), (5, 6), (6, 7), (8, 8), (9, None), (10, 11), (11, 12), (12, 13), (10, 12)]
    got = open_components(spark.createDataFrame(rows, "lid long, rid long")).collect()
    assert sorted(tuple(r) for r in got) == [(5, 3, 2, 1), (10, 4, 4, 2)]
    assert open_components(spark.createDataFrame([], "lid long, rid long")).count() == 0
