"""Text cleaning and key extraction on small fixtures with known results."""

import re

import pytest
from pyspark.sql import functions as F

from pairwright import fixed_values as fixed
from pairwright.functions.histogram import char_histogram
from pairwright.functions import text as t
from pairwright.functions.similarity import char_jaccard, histogram_length, token_jaccard
from pairwright.operators import keys, normalize
from pairwright.rules import StopGroup, dictionary_from_table, stop_groups_from_table


def apply(spark, values, expression):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, c string")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_sorted_unique(spark):
    rows = [(0, []), (1, ["zz", "a1", "zz", "a10", "a2"]), (2, ["q", "Q", "q"]), (3, [""])]
    df = spark.createDataFrame(rows, "i int, a array<string>")
    got = [r.v for r in df.select("i", t.sorted_unique(F.col("a")).alias("v")).orderBy("i").collect()]
    assert got == [None, "a1 a10 a2 zz", "Q q", ""]


def test_extract_key(spark):
    parts = ["bolt M8x40, nut m8, washer M8X40", "m6", "size 12 only", "", None]
    assert apply(spark, parts, lambda c: t.extract_key(c, r"M\d+(?:x\d+)?", ignore_case=False)) == ["m8 m8x40", None, None, None, None]
    assert apply(spark, parts, lambda c: t.extract_key(c, r"M\d+(?:x\d+)?")) == ["m8 m8x40", "m6", None, None, None]


def test_bad_pattern_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)regex|pattern"):
        apply(spark, ["some text"], lambda c: t.extract_key(c, "key["))


@pytest.mark.parametrize("place", [0, 1, 2, 3])
def test_insert_key_position(spark, place):
    df = spark.createDataFrame([(1, "p", 2.5)], "id int, title string, price double")
    expected = ["id", "title", "price"]
    expected.insert(place, "k")
    assert keys.insert_key(df, "k", F.lit(1), place).columns == expected


def test_canonical_key(spark):
    colours = ((r"\bgr[ae]y\b", "tone-7"), (r"\bwei(?:ss|ß)\b", "tone-0"))
    values = ["gray lid, GREY base", "weiß/grey", "greyish", None]
    assert apply(spark, values, lambda c: t.canonical_key(c, colours, r"tone-\d")) == ["tone-7", "tone-0 tone-7", None, None]
    assert apply(spark, ["a weiss cup"], lambda c: t.canonical_key(c, colours)) == ["a tone-0 cup"]
    assert apply(spark, ["Tone-9 tone-3 TONE-9"], lambda c: t.canonical_key(c, (), r"tone-\d")) == ["tone-3 tone-9"]


def test_replace_pattern(spark):
    left = apply(spark, ["OPEN box, re-opened; open"], lambda c: t.replace_pattern(c, r"\bopen\b"))[0]
    assert left.split() == ["box,", "re-opened;"]
    untouched = "copper pipe, 22 mm"
    assert apply(spark, [untouched], lambda c: t.replace_pattern(c, r"\bbrass\b")) == [untouched]


def test_replacement_is_literal(spark):
    assert apply(spark, ["a-b"], lambda c: t.replace_pattern(c, "-", r"$1\x")) == [r"a$1\xb"]


@pytest.mark.parametrize("unicode_edges", [False, True])
def test_remove_words_equals_lookarounds(spark, unicode_edges):
    vocabulary = ("and", "the", "all-in-one", "in")
    texts = [
        "The cat AND the hat", "all-in-one in-plane in", "éand and_the x-the", "", "theand", "the,and;in", "in\tin",
    ]
    inner = rf"\b(?:{'|'.join(vocabulary)})\b" if unicode_edges else f"(?:{'|'.join(vocabulary)})"
    pattern = re.compile(rf"(?<![a-zA-Z0-9-]){inner}(?![a-zA-Z0-9-])", re.IGNORECASE)
    expected = [pattern.sub(" ", x) for x in texts]
    assert apply(spark, texts, lambda c: t.remove_words(c, vocabulary, unicode_edges)) == expected


def test_stop_groups_with_patterns(spark):
    groups = (StopGroup(("the",)), StopGroup(patterns=(r"amazon(?:\.com)?", "x+")), StopGroup.plural("deal"))
    got = apply(spark, ["the deals at amazon.com xx deal dealt"], lambda c: normalize.remove_stop_groups(c, groups))
    assert t and got == ["    at       dealt"]


TRANSLATIONS = [
    ("Vis M4 tête ronde", {"vis": "screw", "ronde": "round"}, "M4 round screw tête"),
    ("VIS vis Vis", {"Vis": "screw"}, "screw"),
    ("vis-serrure bois", {"vis": "screw"}, "bois screw-serrure"),
    ("visage", {"vis": "screw"}, "visage"),
    ("clou, pointe", {"clou": "nail", "pointe": "nail"}, "nail nail,"),
    (" \t ", {"vis": "screw"}, ""),
    (None, {"vis": "screw"}, None),
    ("carte mémoire, carte", {"carte": "card", "carte mémoire": "x y"}, "card x y,"),
    ("gone stays", {"gone": ""}, "stays"),
]


@pytest.mark.parametrize("value, dictionary, expected", TRANSLATIONS)
def test_translate_and_sort(spark, value, dictionary, expected):
    assert apply(spark, [value], lambda c: normalize.translate_and_sort(c, dictionary)) == [expected]


def test_dictionary_checks():
    with pytest.raises(ValueError):
        t.translate_terms(F.lit("x") if False else None, {"c++": "x"})
    with pytest.raises(ValueError):
        t.remove_words(None, ["a b"])


def test_rules_from_tables(spark):
    rules = spark.createDataFrame(
        [("stop", 2, "b", True), ("stop", 1, "a+", False), ("other", 1, "z", True)],
        "kind string, ordinal int, pattern string, is_word boolean",
    )
    assert stop_groups_from_table(rules, "stop") == (StopGroup((), ("a+",)), StopGroup(("b",), ()))
    terms = spark.createDataFrame([("a", "b")], "term string, replacement string")
    assert dictionary_from_table(terms) == {"a": "b"}


def test_units_take_the_s_first(spark):
    got = apply(spark, ["90MB/sec", "90 mb storage", "5 mbit s", "45 Mbyte per second"], normalize.normalize_units)
    assert got == ["90 MB/s ec", "90 MB/s torage", "5 mbit s", "45 MB/s econd"]


def test_laptop_keys(spark):
    df = spark.createDataFrame(
        [(1, "Lenovo ThinkPad Intel Core i5-8250U 14 inch 320 GB GTX 960 ti 15.6"), (2, None), (3, "HP-like celeron, radeon")],
        "id long, title string",
    )
    rows = keys.add_unstructured_keys(df).orderBy("id").collect()
    assert df.columns == ["id", "title"]
    assert keys.add_unstructured_keys(df).columns == [
        "id", "companies", "product_series", "cpu_gpu_companies", "intel_cpu", "nvidia_gpu", "title",
    ]
    assert tuple(rows[0])[1:6] == ("lenovo", "thinkpad", "intel", "intel core i5-8250u", "14 15 320 6 960")
    assert tuple(rows[1])[1:6] == (None,) * 5
    assert tuple(rows[2])[1:6] == (None, None, "amd intel", None, None)


def test_storage_keys(spark):
    df = spark.createDataFrame(
        [
            (1, "SANDISK", "USB 3.0 Ultra 32GB datatraveler"),
            (2, None, "microSDXC 64 GB"),
            (3, "Foo", "Western Digital 512.0 GB 1 TB"),
            (4, None, None),
        ],
        "id long, companies string, title string",
    )
    rows = keys.add_structured_keys(df.fillna({"title": ""})).orderBy("id").collect()
    assert tuple(rows[0])[1:5] == ("kingston sandisk", "usb", "2 gb", "datatraveler ultra")
    assert tuple(rows[1])[1:4] == (None, "micro sd", "4 gb")
    assert tuple(rows[2])[1:4] == ("western digital", "sd", "1 tb 2 gb")
    assert tuple(rows[3])[1:5] == (None, None, None, None)
    whole = df.select("id", keys.capacity_key(F.col("title"), strict=False).alias("c")).orderBy("id").collect()
    assert [r.c for r in whole] == ["32 gb", "64 gb", "1 tb 512 gb", None]


def test_fixed_patterns_agree_with_python(spark):
    texts = ["Intel Core i7 and i5 8400T, xi3 i-9", "geforce gtx 960 ti gt7 1234 05 77b 9", "14 inch", "i 3 i5"]
    for pattern, group in ((fixed.INTEL_CPU, 0), (fixed.NVIDIA_GPU, 1)):
        expected = []
        for x in texts:
            found = sorted({m.lower() for m in re.findall(pattern, x, re.IGNORECASE)})
            expected.append(" ".join(found) if found else None)
        assert apply(spark, texts, lambda c: t.extract_key(c, pattern, group)) == expected


def test_baseline_key(spark):
    got = apply(spark, ["b Zx9 a Y1 a Y1", "nothing", None, "Ärger x1"], keys.baseline_key)
    assert got == ["a y1 a y1 b zx9", "", "", "ärger x1"]


def test_missing_title_reads_nan(spark):
    df = spark.createDataFrame([(1, None), (2, "Neues §Gerät!  x")], "id long, title string")
    got = {r.id: r.title for r in normalize.normalize_unstructured(df, ()).collect()}
    assert got == {1: "nan", 2: "Neues Gerät x"}


def test_structured_normalisation(spark):
    df = spark.createDataFrame([(1, None, "B", None)], "id long, name string, brand string, description string")
    out = normalize.normalize_structured(df, {"a": "b"}, ())
    assert out.columns == ["id", "name", "companies", "description", "title"]
    assert tuple(out.first()) == (1, "", "B", "", " ")


def test_char_jaccard(spark):
    pairs = [("stop", "POTS", 1.0), ("aab", "abb", 0.5), ("abc", "xyz", 0.0), ("aaaa", "a", 0.25), ("", "", 1.0), ("", "q", 0.0), ("😀a", "😀b", 1 / 3)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    h = df.select("i", char_histogram(F.col("a")).alias("a"), char_histogram(F.col("b")).alias("b"))
    score = char_jaccard(
        F.map_from_entries("a"), F.map_from_entries("b"), histogram_length(F.col("a")), histogram_length(F.col("b"))
    )
    assert [r.s for r in h.select("i", score.alias("s")).orderBy("i").collect()] == pytest.approx([p[2] for p in pairs])


def test_token_similarity(spark):
    df = spark.createDataFrame([(None, None), ("a b", "B c"), ("", "x")], "a string, b string")
    assert [r.s for r in df.select(token_jaccard(F.col("a"), F.col("b")).alias("s")).collect()] == pytest.approx([1, 1 / 3, 0])
