"""SimHash components against exhaustive comparison."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pairwright.llm import simhash


def fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints):
    """``{fingerprint: smallest fingerprint it is connected to}`` by comparing all."""
    prints = sorted(set(prints))
    values = np.array(prints, np.uint64)
    root = {}
    for p in prints:
        if p in root:
            continue
        todo = [p]
        root[p] = p
        while todo:
            near = values[np.bitwise_count(values ^ np.uint64(todo.pop())) <= 3]
            for x in near.tolist():
                if x not in root:
                    root[x] = p
                    todo.append(x)
    return root


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = components(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted((str(i), f"{p:016x}", str(least.get(root[p]))) for (i, _), p in zip(rows, prints))


def corpus():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choices("abcdeXYÉß", k=rnd.randrange(1, 7)))
    base = [word() for _ in range(400)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rnd.randrange(5)):
            words[rnd.randrange(len(words))] = word()
        rows.append((4000 + i, rnd.choice([" ", "\n", " \t\x0b"]).join(words)))
    for i in range(150):
        own = [word() for _ in range(rnd.randrange(1, 60))]
        rows.append((1000 + i, " ".join(own)))
        rows.append((2000 + i, " ".join(own).upper() if i % 3 else " ".join([*own, word()])))
    odd = [(1, None), (2, ""), (9, " \n"), (3, "Ab"), (4, "aB"), (5, "ÀB c"), (6, "a\x1cb\x85c d e f"), (7, "w " * 40_000), (None, "a b c"), (8, "a b c"), (8, "a b c"), (None, "lonely one here now")]
    return rows + odd


@pytest.mark.parametrize("crowd", [3, 10**6])
def test_near_duplicates(spark, crowd):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, n int").repartition(4)
    got = simhash.near_duplicates(docs, crowd=crowd)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def families(count, size):
    rnd = random.Random(count)
    prints = set()
    for _ in range(count):
        centre = rnd.getrandbits(64)
        for _ in range(size):
            x = centre
            for _ in range(rnd.randrange(7)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    return prints


@pytest.mark.parametrize("crowd", [0, 10**6])
def test_links_of_dense_and_sparse_families(spark, crowd):
    prints = families(60, 6) | families(2, 700) | {0, 1, 2**63, 2**63 + 2**31, 2**64 - 1}
    signed = [(p - (p >> 63 << 64),) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), crowd, tile_rows=64).collect()
    for lid, rid in found:
        assert bin((lid ^ rid) & (2**64 - 1)).count("1") <= 3
    parent = {p: p for p, in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for lid, rid in found:
        a, b = root(lid), root(rid)
        parent[max(a, b)] = min(a, b)
    groups = {}
    for p in parent:
        groups.setdefault(root(p), set()).add(p & (2**64 - 1))
    truth = {}
    for p, r in components(prints).items():
        truth.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, truth.values()))


def test_anchors_cover(spark):
    rows = simhash.anchors(spark.createDataFrame([(p - (p >> 63 << 64),) for p in families(20, 4)], "fp long"))
    near = F.bit_count(F.col("anchor").bitwiseXOR(F.shiftrightunsigned("fp", 0)).bitwiseAND(F.lit(2**31 - 1)))
    low = rows.where(F.col("anchor") < 2**32).withColumn("far", near)
    assert low.where("home").agg(F.max("far")).first()[0] <= 1 and low.agg(F.max("far")).first()[0] <= 2
    counts = {(r.n, r.h) for r in low.groupBy("fp").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("h")).collect()}
    assert counts <= {(1, 1), (16, 1)}
