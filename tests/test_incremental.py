"""The match index against matching everything at once, and the result store."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from pairwright.operators import pivots
from pairwright.operators.incremental import build_index, extend_index, open_index
from pairwright.operators.matching import Threshold, similar_clusters
from pairwright.sources import store

from test_matching import corpus, frame

T = Threshold(0.9)
KEYS = ["k1", "k2"]


def labels(df):
    rows = df.collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.cluster_id for r in rows}


@pytest.mark.parametrize("short, crowded", [(True, 3), (False, 10**6)])
def test_batches_equal_one_run(spark, tmp_path, monkeypatch, short, crowded):
    monkeypatch.setattr(pivots, "CROWDED_ROWS", crowded)
    rows = corpus(240, 17, short)
    random.Random(1).shuffle(rows)
    batches = [rows[:100], rows[100:101], rows[101:], []]
    index = build_index(frame(spark, batches[0]), KEYS, "text", T, str(tmp_path / "index"))
    seen = list(batches[0])
    for batch in batches[1:]:
        index = extend_index(index, frame(spark, batch), KEYS, "text", T, tile_rows=16 if crowded == 3 else 4096)
        seen += batch
    assert labels(index.clusters) == labels(similar_clusters(frame(spark, seen), KEYS, "text", T))
    assert index.manifest.number == 4 and len(index.folders("prepared")) == 4 and len(index.folders("pivots")) == 1
    assert labels(open_index(spark, index.path).clusters) == labels(index.clusters)
    assert store.damaged(spark, index.manifest) == []


def test_new_records_join_old_clusters(spark, tmp_path):
    old = [(5, "b", None, "x" * 40), (9, "b", None, "y" * 40), (7, "b", None, "x" * 39 + "y")]
    new = [(1, "b", None, "x" * 20 + "y" * 20), (3, "b", None, "X" * 40), (8, "c", None, "x" * 40)]
    index = build_index(frame(spark, old), KEYS, "text", T, str(tmp_path / "i"))
    assert labels(index.clusters) == {5: 5, 7: 5}
    assert labels(extend_index(index, frame(spark, new), KEYS, "text", T).clusters) == {3: 3, 5: 3, 7: 3}


def test_earlier_texts_are_not_read(spark, tmp_path):
    rows = corpus(60, 2, True)
    index = build_index(frame(spark, rows[:30]), KEYS, "text", T, str(tmp_path / "i"))
    kept = {c for t in index.manifest.tables for c in index.table(t).columns}
    assert "text" not in kept
    path = str(tmp_path / "new")
    frame(spark, rows[30:]).write.parquet(path)
    done = extend_index(index, spark.read.parquet(path), KEYS, "text", T)
    sources = {pathlib.Path(f.removeprefix("file:")).parent.parent.name for t in done.manifest.tables.values() for f in t["folders"]}
    assert sources == {"i", *(s for s in sources if s.startswith("data-"))}
    assert labels(done.clusters) == labels(similar_clusters(frame(spark, rows), KEYS, "text", T))


def test_other_settings_are_refused(spark, tmp_path):
    index = build_index(frame(spark, corpus(5, 1, True)), KEYS, "text", T, str(tmp_path / "i"))
    with pytest.raises(ValueError):
        extend_index(index, frame(spark, []), ["k1"], "text", T)
    with pytest.raises(ValueError):
        build_index(frame(spark, []), KEYS, "text", Threshold(0.9, 0.95, 10), str(tmp_path / "j"))


def test_store_commits_last(spark, tmp_path):
    path = str(tmp_path / "r")
    assert store.latest(spark, path) is None
    calls = []

    def compute(n):
        calls.append(n)
        return {"pairs": spark.range(n).select(F.col("id").alias("lid"), F.col("id").alias("rid"))}

    first, fresh = store.up_to_date(spark, path, {"read_limit": None, "dataset": 1}, lambda: compute(3))
    assert fresh and first.number == 1 and first.tables["pairs"]["rows"] == 3
    again, fresh = store.up_to_date(spark, path, {"read_limit": None, "dataset": 1}, lambda: compute(4))
    assert not fresh and again == first and calls == [3]
    other, fresh = store.up_to_date(spark, path, {"read_limit": 10, "dataset": 1}, lambda: compute(5))
    assert fresh and other.number == 2 and store.read_table(spark, other, "pairs").count() == 5

    def dies():
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        store.up_to_date(spark, path, {"dataset": 2}, dies)
    with pytest.raises(Exception):  # the first table is written, the second fails
        bad = spark.range(2).select(F.raise_error(F.lit("lost")).alias("x"))
        store.commit(spark, path, {"pairs": spark.range(9), "more": bad}, {"dataset": 2})
    assert store.latest(spark, path) == other
    (pathlib.Path(path) / "_manifests" / "00000003.json").write_text('{"number": 3, "sett')
    assert store.latest(spark, path) == other
    assert store.drop_superseded(spark, path) >= 2
    assert store.damaged(spark, other) == []
    folder = pathlib.Path(other.tables["pairs"]["folders"][0].removeprefix("file:"))
    next(folder.glob("part-*.parquet")).unlink()
    assert store.damaged(spark, other) == ["pairs"]
