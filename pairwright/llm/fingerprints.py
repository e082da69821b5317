"""Threshold-scaled document fingerprints.

The sketch of a text is the set of its hashed shingles (five words each) that fall
below a fixed fraction of the hash range. Every text keeps the same fraction, so
sketches of a short and a very long text can be compared and sketches of parts be
merged. A text with few shingles keeps the smallest ``FLOOR`` of them even above
the fraction; its sketch then reaches as far as its largest hash, or everywhere if
it holds all shingles, and two sketches are compared as far as both reach.

Everything is a column expression. Defined results: a missing text is an empty
one; a text without words has an empty sketch; a text of fewer than five words is
one shingle; equal texts have equal sketches whatever their other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import whole

SHINGLE_WORDS = 5
FRACTION = 1 / 8
FLOOR = 16
BUCKET = 256
_SPACE = r"[\x20\x09-\x0D]+"
# xxhash64 covers the whole long range; a fraction of it begins at the smallest long.
_LOWEST = -(2**63)


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all runs of ``words`` words, with repeats; of the whole text if it has fewer."""
    parts = F.filter(F.split(text, _SPACE, -1), lambda w: w != "")
    # Bound once: the words are named by a one-element array so that they are not split again per shingle.
    bound = F.transform(F.array(parts), lambda w: F.when(F.size(w) > 0, _over(w, words)).otherwise(F.array().cast("array<bigint>")))
    return F.element_at(bound, 1)


def _over(parts: Column, words: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(parts) - (words - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(parts, i, words)))


def sketch(text: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """``struct<reach, hashes>``: retained hashes ascending and the hash up to which nothing is missing."""
    limit = int(_LOWEST + fraction * 2**64)

    def choose(all_hashes: Column) -> Column:
        low = F.array_distinct(F.filter(all_hashes, lambda h: h <= F.lit(limit)))
        short = F.sort_array(F.array_distinct(all_hashes))
        few = F.slice(short, 1, floor)
        reach = F.when(F.size(short) <= floor, F.lit(2**63 - 1)).otherwise(F.element_at(few, -1))
        return F.when(
            F.size(low) >= floor, F.struct(F.lit(limit).alias("reach"), F.sort_array(low).alias("hashes"))
        ).otherwise(F.struct(reach.alias("reach"), few.alias("hashes")))

    return F.element_at(F.transform(F.array(shingle_hashes(text)), choose), 1)


def merge(left: Column, right: Column) -> Column:
    """Sketch of two texts together, as far as both reach."""
    reach = F.least(left["reach"], right["reach"])
    both = F.sort_array(F.array_union(left["hashes"], right["hashes"]))
    return F.struct(reach.alias("reach"), F.filter(both, lambda h: h <= reach).alias("hashes"))


def containment(left: Column, right: Column) -> Column:
    """Estimated share of the smaller text's shingles that the larger one has; 1 for two empty sketches."""
    reach = F.least(left["reach"], right["reach"])
    shared = F.size(F.filter(F.array_intersect(left["hashes"], right["hashes"]), lambda h: h <= reach))
    within = lambda s: F.size(F.filter(s["hashes"], lambda h: h <= reach))
    smaller = F.least(within(left), within(right))
    both_empty = (F.size(left["hashes"]) == 0) & (F.size(right["hashes"]) == 0)
    return F.when(smaller > 0, shared / smaller).when(both_empty, F.lit(1.0)).otherwise(F.lit(0.0))


def sketch_text(sketched: Column) -> Column:
    """A sketch as text: its reach, then its hashes, in hexadecimal."""
    return F.concat_ws(":", F.hex(sketched["reach"]), F.array_join(F.transform(sketched["hashes"], F.hex), ","))


def _following(ids: DataFrame, fan: int = 1024) -> DataFrame:
    """``(id, next_id)``: the next smaller of the distinct whole-number ids, for the smallest the largest.

    Ids are grouped by their quotient; inside a group the next one is a window of
    at most ``fan`` rows, between groups it is the same question for the quotients.
    """
    if ids.count() <= fan:
        ring = ids.withColumn("all", F.lit(0))
        over = Window.partitionBy("all").orderBy(F.desc("id"))
        first = F.first("id").over(over)
        return ring.select("id", F.coalesce(F.lead("id").over(over), first).alias("next_id"))
    grouped = ids.withColumn("group", F.floor(F.col("id") / F.lit(fan)).cast("long"))
    heads = materialize(grouped.groupBy("group").agg(F.max("id").alias("head")))
    after = (
        _following(heads.select(F.col("group").alias("id")), fan)
        .withColumnRenamed("id", "group")
        .join(heads.select(F.col("group").alias("next_id"), F.col("head").alias("next_head")), "next_id")
        .select("group", "next_head")
    )
    over = Window.partitionBy("group").orderBy(F.desc("id"))
    return (
        grouped.withColumn("near", F.lead("id").over(over))
        .join(after, "group")
        .select("id", F.coalesce("near", "next_head").alias("next_id"))
    )


def with_next(docs: DataFrame, id_column: str, raw: str, derived: dict[str, Column]) -> DataFrame:
    """Add ``derived`` columns, and ``next_<column>`` of the next row by descending id for these and ``raw``.

    Repeated ids go by ``raw``, missing ids come last; after the last row comes the
    first. Rows move once, into groups of neighbouring ids; only the first row of
    each group is sent to the group before it.
    """
    lowest = _LOWEST + 1
    # Missing ids go by groups below all others, whatever their number.
    lost = F.lit(-(2**58)) - F.pmod(F.xxhash64(raw), F.lit(1024))
    group = F.coalesce(F.floor(F.col(id_column) / F.lit(BUCKET)).cast("long"), lost)
    grouped = docs.withColumn("_group", group).withColumn("_id", F.coalesce(F.col(id_column), F.lit(lowest)))
    heads = materialize(grouped.groupBy("_group").agg(F.max("_id").alias("_id")))
    carried = [raw, *derived]
    # The texts of the first rows are read again, so that the others need not be grouped twice.
    first = grouped.join(heads, ["_group", "_id"], "left_semi")
    first = first.groupBy("_group").agg(F.min(raw).alias(raw)).withColumns(derived)
    after = (
        _following(heads.select(F.col("_group").alias("id")))
        .join(first.select(F.col("_group").alias("next_id"), F.struct(*carried).alias("_after")), "next_id")
        .select(F.col("id").alias("_group"), "_after")
    )
    over = Window.partitionBy("_group").orderBy(F.desc("_id"), F.asc(raw))
    return (
        grouped.withColumns(derived)
        .withColumn("_near", F.lead(F.struct(*carried)).over(over))
        .join(after, "_group", "left")
        .withColumn("_next", F.coalesce("_near", "_after"))
        .withColumns({f"next_{c}": F.col("_next")[c] for c in carried})
        .drop("_group", "_id", "_near", "_after", "_next")
    )


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last third replaced by as many code points from the
    beginning of the next document by descending id.
    """
    own = docs.select("doc_id", whole("text").alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third)
    )
    return (
        with_next(own, "doc_id", "text", {"sketch": sketch(F.col("text"))})
        .withColumn("edited", edited)
        .withColumn("edited_sketch", sketch(F.col("edited")))
        .select(
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            sketch_text(F.col("sketch")).alias("fingerprint"),
            sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
            containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
            containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        )
    )
