"""SimHash near duplicates by anchor points of a covering code.

A fingerprint has a bit for each bit of the shingles' hashes: one where over half of them
have a one. Fingerprints link at ``DISTANCE`` or fewer differing bits.

Of 3 differing bits one half of the fingerprint holds at most one. The anchors of a half
are the words of the binary Hamming code of 31 bits (bit 31 of the half is left out, which
only brings fingerprints closer): every word is within 1 of exactly one anchor, its home.
If two halves differ in one bit, the home of either is within 1 + 1 of the other. So each
fingerprint is copied, per half, to all anchors within 2 (itself, or its home and fifteen
more, read off the word's syndrome), and a home is compared with all copies at its anchor.
Nothing is missed, anchors grow neither with the table nor with its groups, and equal
fingerprints are one row beforehand.

An anchor that is home to more than ``CROWD`` fingerprints could link the square of them.
There, fingerprints are first tied together through words: each is copied to the 65 words
within one bit of it, and those that meet at a word, being within 2 of one another, are tied
to the smallest among them, a linear number of ties that needs no comparison. What is left
to compare at a crowded anchor are fingerprints of different tied groups; an anchor with a
single group is done. No link is lost and none is made between fingerprints that have none.

Defined results: a missing text is an empty one; a text without words has fingerprint
zero, linked like any other; a text of fewer than three words is one shingle. Rows with a
missing id take part; they have the smallest id of their component, if any row has one.
Repeated rows stay. An empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.cluster import connected_components
from ..operators.tiles import TILE_ROWS, spread
from ..session import materialize
from .common import BROADCAST_ROWS, whole

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 3
HALF_BITS = 31
CROWD = 32
CHUNK_SHINGLES = 1 << 15


def _bits_over_half(words: list[bytes], size: int) -> int:
    """The fingerprint of a text's words as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for first in range(0, n, CHUNK_SHINGLES):
        last = min(n, first + CHUNK_SHINGLES)
        bounds = zip(starts[first:last], ends[min(size, len(words)) - 1 + first :])
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in bounds], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` of whole texts: words as bytes, with A-Z in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Bytes are split at ASCII blanks and lowered in A-Z alone, which is what is asked for.
            found = [_bits_over_half(text.as_py().lower().split(), size) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    text = F.encode(whole("text"), "utf-8").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, fp long")


def anchors(prints: DataFrame) -> DataFrame:
    """Every fingerprint at every anchor within covering radius plus distance: ``(anchor, home, fp)``."""
    parity = [
        F.shiftleft(F.bit_count(F.col("word").bitwiseAND(F.lit(sum(1 << (p - 1) for p in range(1, HALF_BITS + 1) if p >> k & 1)))) % 2, k)
        for k in range(5)
    ]
    syndrome = sum(parity[1:], parity[0]).cast("int")
    home = F.when(F.col("syndrome") == 0, F.col("word")).otherwise(F.expr("word ^ shiftleft(1L, syndrome - 1)"))
    # Two bits whose places combine to the syndrome lead to an anchor, too; to none if it is zero.
    pairs = F.expr(
        f"transform(filter(sequence(1, {HALF_BITS}), i -> syndrome > 0 and i < (i ^ syndrome)),"
        " i -> struct(word ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ syndrome) - 1) as anchor, false as home))"
    )
    halves = F.array(*[F.struct(F.lit(h).alias("half"), F.shiftrightunsigned("fp", 32 * h).bitwiseAND(F.lit((1 << HALF_BITS) - 1).cast("long")).alias("word")) for h in (0, 1)])
    return (
        prints.select("fp", F.explode(halves).alias("piece"))
        .select("fp", "piece.half", "piece.word")
        .withColumn("syndrome", syndrome)
        .withColumn("at", F.concat(F.array(F.struct(home.alias("anchor"), F.lit(True).alias("home"))), pairs))
        .select("fp", "half", F.explode("at").alias("at"))
        .select((F.col("at.anchor") + F.shiftleft(F.col("half").cast("long"), 32)).alias("anchor"), "at.home", "fp")
    )


def _close(left: str, right: str) -> Column:
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right))) <= DISTANCE


def _compare(homes: DataFrame, copies: DataFrame, apart: Column) -> DataFrame:
    """Homes against the copies at their anchor, pairs of ``apart`` sides: ``(lid, rid)``."""
    keys = [c for c in homes.columns if c not in ("home", "fp", "group")]
    prefixed = lambda side, p: side.drop("home").withColumnsRenamed({"fp": f"{p}_fp", "group": f"{p}_group"})
    met = prefixed(homes, "l").join(prefixed(copies, "r"), keys)
    return met.where(apart & _close("l_fp", "r_fp")).select(F.col("l_fp").alias("lid"), F.col("r_fp").alias("rid"))


def _tied(prints: DataFrame) -> DataFrame:
    """Fingerprints within two bits of one another, as a star to the smallest at each word."""
    words = F.concat(F.array("fp"), F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))"))
    at = prints.select("fp", F.explode(words).alias("word"))
    least = at.groupBy("word").agg(F.min("fp").alias("lid"), F.max("fp").alias("top")).where("lid < top").select("word", "lid")
    return at.join(least, "word").where("fp <> lid").select("lid", F.col("fp").alias("rid")).distinct()


def links(prints: DataFrame, crowd: int = CROWD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``(lid, rid)`` between distinct fingerprints that connect what is connected.

    All links of fingerprints at uncrowded anchors; at crowded ones enough to connect them.
    """
    # Few and small partitions hold the fingerprints; their copies are made by all tasks.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(anchors(prints.repartition(tasks)))
    crowded = materialize(rows.where("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("anchor"))
    once = F.col("l_fp") < F.col("r_fp")
    n = crowded.count()
    if not n:
        return _compare(rows.where("home"), rows, once)
    few = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded
    calm = rows.join(few, "anchor", "left_anti")
    quiet = _compare(calm.where("home"), calm, once)
    busy = materialize(rows.join(few, "anchor"))
    ties = materialize(_tied(busy.select("fp").distinct()))
    groups = connected_components(ties).select(F.col("id").alias("fp"), F.col("cluster_id").alias("group"))
    busy = materialize(busy.join(groups, "fp", "left").withColumn("group", F.coalesce("group", "fp")))
    several = busy.groupBy("anchor").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least < most")
    open_rows = busy.join(several.select("anchor"), "anchor", "left_semi").withColumn("key", F.struct("anchor")).drop("anchor")
    homes, copies = spread(open_rows.where("home"), open_rows, "key", "fp", tile_rows)
    across = _compare(homes, copies, once & (F.col("l_group") != F.col("r_group")))
    return quiet.unionByName(ties).unionByName(across)


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, crowd: int = CROWD) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document."""
    found = materialize(fingerprints(docs, size))
    prints = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    named = connected_components(links(prints.select("fp"), crowd)).withColumnRenamed("id", "fp")
    members = materialize(prints.join(named, "fp", "left").withColumn("cluster_id", F.coalesce("cluster_id", "fp")))
    smallest = members.groupBy("cluster_id").agg(F.min("least").alias("component_id"))
    table = materialize(members.join(smallest, "cluster_id").select("fp", "component_id", "n"))
    return (
        with_counted(found, table, "fp")
        .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    )


def with_counted(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Join a table with one row a key and the key's number of ``rows`` (``n``), which may be large for some.

    Keys of more than ``TILE_ROWS`` rows are at most one in so many; they are broadcast
    when their count allows it.
    """
    hot = table.where(F.col("n") > TILE_ROWS).drop("n")
    count = hot.count()
    if not 0 < count <= BROADCAST_ROWS:
        return rows.join(table.drop("n"), key)
    rest = table.where(F.col("n") <= TILE_ROWS).drop("n")
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(rest, key))
