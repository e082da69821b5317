"""Joins, archives, neighbours, classifiers and the pipeline."""

import collections
import pathlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from pairwright.llm import ann, quality, setjoin, toxicity, warc  # noqa: E402

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test data")


def brute_groups(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists, shared = collections.defaultdict(list), collections.Counter()
    for i, own in sets.items():
        for x in own:
            lists[x].append(i)
    for members in lists.values():
        shared.update((a, b) for a in members for b in members if a < b)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies():
    rnd = random.Random(3)
    base = [str(rnd.randrange(1000)) for _ in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rnd.randrange(14)):
            words[rnd.randrange(len(words))] = str(rnd.randrange(10**6))
        rows.append((5000 + i, " ".join(words)))
    rows += [(100 + i, f"own {i} " + " ".join(base[:60]) + f" tail {i}" * 40) for i in range(80)]
    return rows + [(9000, ""), (9001, None), (9002, "Ab"), (9003, "aB"), (9004, "ÉA b"), (9005, "éa b"), (9006, "w " * 9000)]


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_set_join(spark, size, percent):
    rows = near_copies()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.link_documents(docs, size, percent).collect()}
    assert got == brute_groups(rows, size, percent)


def test_lone_sets_are_in_no_list(spark, monkeypatch):
    rnd = random.Random(8)
    own = lambda n: " ".join(str(rnd.randrange(10**6)) for _ in range(n))
    common, near = own(40), own(200)
    rows = [(i, f"{own(100)} {common} {own(100)}") for i in range(60)]
    rows += [(70, near), (71, f"{near} tail"), (72, near)]
    listed, link = [], setjoin.link_representatives

    def watched(reps, *rest):
        listed.extend(r.doc for r in reps.select("doc").collect())
        return link(reps, *rest)

    monkeypatch.setattr(setjoin, "link_representatives", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.link_documents(docs, 3, 90).collect()}
    assert got == brute_groups(rows, 3, 90)
    assert sorted(listed) == [70, 71]


def test_lone_sets_by_buckets_and_batches(spark, monkeypatch):
    rnd = random.Random(9)
    monkeypatch.setattr(setjoin, "BUCKET_SHINGLES", 500)
    monkeypatch.setattr(setjoin, "BATCH_SETS", 7)
    draw = lambda n: {rnd.randrange(-(2**63), 2**63) for _ in range(n)}
    common, base = draw(10), draw(100)
    sets = [draw(60) | common for _ in range(30)] + [base | draw(i) for i in range(1, 16)] + [draw(1), draw(2)]
    rows = [(i, len(s), sorted(s)) for i, s in enumerate(sets)]
    shown = spark.createDataFrame(rows + rows[:1], "x long, n int, low array<long>").repartition(3, "x")
    lone = [r.x for r in setjoin.alone(shown, 80).collect()]
    linked = {i for i, s in enumerate(sets) for j, t in enumerate(sets) if i != j and 100 * len(s & t) >= 80 * len(s | t)}
    assert len(lone) == len(set(lone)) and not linked & set(lone)
    assert set(lone) >= {*range(1, 30), 45, 46}  # a copy in another batch may hide that the first is alone
    low = pa.array([r[2] for r in rows], pa.list_(pa.int64()))
    sizes = np.array([r[1] for r in rows])
    sent = list(setjoin._sent(np.arange(len(rows)), sizes, low, 4, 80))
    assert sum(len(o) + len(k) for _, o, k in sent) <= 7 * sizes.sum()


def test_lone_sets_send_six_bytes_a_shingle():
    rnd = random.Random(10)
    sets = [sorted(rnd.randrange(-(2**63), 2**63) for _ in range(60)) for _ in range(50)]
    sizes = np.full(50, 60)
    sent = list(setjoin._sent(np.arange(50), sizes, pa.array(sets, pa.list_(pa.int64())), 4, 80))
    assert sum(len(o) + len(k) for _, o, k in sent) <= 6 * sizes.sum()


def test_answers_are_joined_only_where_they_differ_from_the_id(spark, monkeypatch):
    rows = [(i, f"a{i} b{i} c{i} d{i}") for i in range(40)] + [(50, "x y z u"), (51, "x y z u"), (None, "a3 b3 c3 d3"), (60, "p q r"), (60, "p q r")]
    joined, add = [], setjoin.add_columns

    def watched(given, table, *rest):
        joined.extend(r.component_id for r in table.select("component_id").collect())
        return add(given, table, *rest)

    monkeypatch.setattr(setjoin, "add_columns", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.component_id) for r in setjoin.link_documents(docs, 3, 90).collect())
    assert got == sorted([*((str(i), i) for i in range(40)), ("50", 50), ("51", 50), ("None", 3), ("60", 60), ("60", 60)])
    assert sorted(joined) == [3, 50]


def test_pairs_come_from_their_first_shared_list(spark):
    listed = [(d, 1000, i, s, 400, 800) for d in range(4) for i, s in enumerate(s for s in range(200) if d == 0 or s % 50 != d)]
    entries = spark.createDataFrame(listed, "doc long, n int, place int, shingle long, hits int, past int")
    entries = entries.selectExpr("*", "doc as grp", *[f"0L as {c}" for c in setjoin._BITMAP])
    pairs = sorted((r.a, r.b) for r in setjoin._met(entries, 80).collect())
    assert pairs == [(a, b) for a in range(4) for b in range(a + 1, 4)]


def test_set_join_edges(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (2, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in setjoin.link_documents(docs, 3, 90).collect())
    assert got == [("2", 0, 2), ("3", 2, 3), ("3", 2, 3), ("None", 2, 3)]
    assert setjoin.link_documents(docs.limit(0), 3, 90).count() == 0


def test_loser_tree():
    rnd = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rnd.randrange(50) for _ in range(rnd.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(sum(runs, []))


def test_archives(spark):
    long = "<p>\r\n\r\nWARC/1.1\r\n" + "é" * 60 + "</p>"
    rows = [(4, "http://b.org/x", long), (2, None, long), (9, "https://www.a.b.org:443/y#z", long), (5, "u", "x"), (6, "u", "x"), (7, "u", None), (None, "u", long), (1, "v\r\nw", "")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload int").repartition(3)
    index = warc.archive_and_read(pages)
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in index.collect()}
    n = len(long.encode())
    assert got == {
        2: (n, "response", None), 4: (n, "revisit", 2), 9: (n, "revisit", 2), None: (n, "revisit", 2),
        5: (1, "response", None), 6: (1, "response", None), 7: (0, "response", None), 1: (0, "response", None),
    }
    keys = [(r.url_key, r.captured) for r in index.collect()]
    assert keys == sorted(keys) and ("org,b,a)/y", keys[0][1]) not in keys[:1]
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_neighbours(spark):
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((3000, 16)).astype(np.float32)
    x[50:90] = x[50]
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)]
    odd = [(10**6, None, 0.0), (10**6 + 100, [0.0] * 16, 0.0), (10**6 + 200, [float("nan")] + [1.0] * 15, 0.0), (None, [1.0] * 16, 0.0), (10**6 + 300, [1.0], 0.0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank double")
    got = ann.nearest(table, F.col("vec_id") % 100 == 0, candidates=700, block_rows=1500).collect()
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    x = x.astype(float)
    hits = 0
    assert set(found) == set(range(0, 3000, 100))
    for q, near in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(3000), d)) if i != q][:10]
        hits += len({i for i, _ in near} & set(best))
        assert all(abs(d[i] - s) < 1e-12 for i, s in near) and near == sorted(near, key=lambda x: (x[1], x[0]))
    assert hits >= 0.9 * 10 * len(found)
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0


def edits(a, b):
    """Edit distance where a swap of neighbouring letters is one edit."""
    d = [[max(i, j) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def misspelled(rnd, word):
    for _ in range(rnd.randrange(4)):
        i, kind = rnd.randrange(len(word) + 1), rnd.randrange(4)
        if kind == 0:
            word = word[:i] + rnd.choice("abcdez") + word[i:]
        elif kind == 1:
            word = word[:i] + word[i + 1 :]
        elif kind == 2:
            word = word[:i] + rnd.choice("abcdez") + word[i + 1 :]
        else:
            word = word[:i] + word[i : i + 2][::-1] + word[i + 2 :]
    return word


@pytest.mark.parametrize("held", [300_000, 200])
def test_automaton_equals_edit_distance(monkeypatch, held):
    monkeypatch.setattr(toxicity, "HELD_ELEMENTS", held)
    rnd = random.Random(2)
    lexicon = {"".join(rnd.choices("abcde", k=rnd.randrange(2, 13))): rnd.random() for _ in range(50)}
    automaton = toxicity.Automaton(lexicon)
    words = [misspelled(rnd, rnd.choice(list(lexicon))) for _ in range(1500)] + ["", "a", "zzzzzz", "abcdeabcdeabcde"]
    hits = 0
    for word in words:
        near = [(edits(word, t), -w) for t, w in lexicon.items()]
        near = [n for n, t in zip(near, lexicon) if n[0] <= toxicity.allowance(t)]
        assert automaton.match(word) == ((-min(near)[1], min(near)[0]) if near else None), word
        hits += bool(near)
    assert hits > 500 and toxicity.Automaton({}).match("idiot") is None


def test_both_ends_of_a_word_may_be_wrong():
    automaton = toxicity.Automaton({"idiot": 5.0, "worthless": 4.0, "bad": 2.0})
    assert automaton.match("idoit") == (5.0, 1) and automaton.match("1diot") == (5.0, 1) and automaton.match("xorthlesx") == (4.0, 2)
    assert automaton.match("1dio7") is None and automaton.match("bat") is None and automaton.match("bad") == (2.0, 0)


def test_quotation_lowers_hits():
    scanner = toxicity.Scanner({"idiot": 5.0})
    quoted = lambda text: [h[-1] for h in scanner.hits(text)]
    assert quoted('you idiot. he said idiot and "idiot"') == [False, True, True]
    assert quoted('he was told "you are such an idiot" and left, the idiot') == [True, False]
    assert quoted("„so ein Idiot“ und «idiot» ‘idiot’ “idiot") == [True, True, True, False]
    assert quoted('a "b" idiot "c"') == [False] and quoted('"idiot\nidiot"') == [False, False]
    assert scanner.hits("") == [] and len(scanner.hits("idiot " * 50_000)) == 50_000


@needs_data
def test_classifiers(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    odd = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", F.lit(None).cast("string").alias("source"), "n_chars")
    scored = quality.score_documents(docs.unionByName(odd), labels)
    assert scored.count() == docs.count() + 1 and scored.where("quality_score is null").count() == 0
    rows = scored.join(labels, "doc_id").select("quality_score", "quality").collect()
    assert np.mean([(r.quality_score >= quality.KEEP_SCORE) == (r.quality == 1) for r in rows]) > 0.95
    rated = toxicity.score_held_out(docs.unionByName(odd), labels)
    assert rated.count() == docs.count() + 1
    held = rated.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.85 * len(held)
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    assert toxicity.score_held_out(docs.limit(0), labels.limit(0)).count() == 0


@needs_data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, DATA)
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert 0 < len(rows) <= before.count()
        if name == "near_duplicates":
            groups = brute_groups([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert {r.doc_id for r in rows} == {i for i, (_, g) in groups.items() if i == g}
        before = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, before, DATA)
    assert packed.select("doc_id").distinct().count() == before.count()
    assert corpus_pipeline.STAGES[0][1](spark, docs.limit(0), DATA).count() == 0


@needs_data
def test_pipeline_stages_on_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = "A plain and friendly report about gardens, rivers and the people who look after them. " * 6
    rows = [
        (None, None, None, None, None), (None, good, "en", "s", 9), (1, "", "en", None, 0), (1, "", "en", None, 0),
        (2, good, "en", "s", 5), (3, good + "More.", "en", "s", 5), (4, "mail a@b.org " + "word " * 60_000, "en", "s", 5), (2, "other text " * 9, None, "s", 5),
    ]
    odd = spark.createDataFrame(rows, docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.limit(0), DATA).count() == 0, name
        kept = stage(spark, odd, DATA).collect()
        assert kept and all(tuple(r) in rows for r in kept) or name == "personal_data", name
        if name == "toxicity":
            assert len(kept) == len(rows)
        if name == "near_duplicates":
            ids = [r.doc_id for r in kept]
            assert sorted(map(str, ids)) == ["1", "2", "4", "None", "None"]
        if name == "personal_data":
            changed = {tuple(r) for r in kept} - set(rows)
            assert len(kept) == len(rows) and (None,) * 5 in {tuple(r) for r in kept}
            assert any(r[1] and r[1].startswith("mail <EMAIL> word") and r[4] == len(r[1]) for r in changed)
    packed = corpus_pipeline.STAGES[-1][1](spark, odd, DATA).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed) >= len(rows) + 20
    assert corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), DATA).count() == 0
