"""Exact Jaccard join of word n-grams by index lists, with skipping by set relations.

Sets are hashed shingles. Equal sets become one, the smallest id. Every set indexes
its prefix under one global order (shingles that are in very many prefixes last):
two sets that share enough share a prefix shingle. An index list is all sets with
that shingle; entries carry set size, position and a parity bitmap of the whole set, and
partners that these rule out are skipped in the list. (Every shingle of a set flips one of
256 bits, so two bitmaps differ in no more bits than the sets in shingles.) Sets
that share too few of their lowest shingles with any other set are in no list at
all. The answers wanted are linked groups, so lists are worked
off by leaders: each round every list that still spans several groups compares its
members with one of them, a linear number of comparisons, and what links joins one
group. What is left after the rounds is compared pair by pair inside its lists, and
there a set's overlaps follow from those of the leader compared with both: bounds
from the two known overlaps settle most pairs as linked or not without a look at
the sets.

No partner, list or candidate is capped; the number of rounds only decides how much
is done by leaders. Defined results: a missing text, or one without words, has an
empty set and links with nothing; fewer words than a shingle are one shingle; equal
texts link; rows with equal ids take the group of any of their texts; a missing id
is kept and has no group of its own.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.cluster import connected_components
from ..session import discard, materialize, scratch_path
from .common import add_columns, whole

WORDS = 5
PERCENT = 80
# Rounds by leaders; lists of up to so many entries need the first round only.
ROUNDS = 5
SHORT_LIST = 64
# A shingle is common when it is in more prefixes than this, and in more than one of so many.
COMMON_ROWS = 64
COMMON_SHARE = 2000
# Shingles looked at beyond the prefix, to see whether a set is alone: one in so many of its size, and a few.
LOOK_SHARE = 10
LOOK_LEAST = 4
# Shingles of a bucket (about), and sets of a batch, when sets are told alone; places in a batch are 16 bits.
BUCKET_SHINGLES = 1_000_000
BATCH_SETS = 16_384
_NO_OWNER = 0xFFFF
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shingles(text: Column, words: int) -> Column:
    """Distinct 64-bit hashes of all runs of ``words`` words, ascending; A-Z count as a-z."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    parts = F.filter(F.split(lowered, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")

    def over(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1)))
        hashed = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, words)))
        return F.when(F.size(w) > 0, F.sort_array(F.array_distinct(hashed))).otherwise(F.array().cast("array<bigint>"))

    return F.element_at(F.transform(F.array(parts), over), 1)


def _prefix_size(n: Column | int, percent: int):
    """Shingles of a set of n that must be indexed: n - ceil(percent * n / 100) + 1."""
    if isinstance(n, int):
        return n - -(-percent * n // 100) + 1
    return n - F.ceil(n * percent / F.lit(100.0) - 1e-9).cast("int") + 1


def _looked_size(n: Column, percent: int) -> Column:
    """Lowest shingles of a set of n that tell whether it is alone; never fewer for a larger set."""
    return _prefix_size(n, percent) + F.floor(n / F.lit(LOOK_SHARE)).cast("int") + LOOK_LEAST


def _shown_size(n: Column, percent: int) -> Column:
    """Lowest shingles of a set of n among which all are that a partner looks at and shares.

    A partner has at most 100 n / percent shingles, and in front of a shared one this set has
    at most the partner's in front of it and those that only this set has.
    """
    largest = F.floor(n * 100 / F.lit(float(percent)) + 1e-9).cast("int")
    return _looked_size(largest, percent) + _prefix_size(n, percent) - 1


def _sent(x: np.ndarray, sizes: np.ndarray, low: pa.Array, buckets: int, percent: int) -> Iterator[tuple[int, bytes, bytes]]:
    """``bucket, owners, keys`` of a batch: what its sets show, for each bucket of hashes.

    Keys are the lowest four bytes of hashes, those of ``owners`` first: places of sets that look
    at a shingle which no other set of the batch shows. What several sets show goes out once.
    """
    _, rows = np.unique(x, return_index=True)
    counts = np.zeros(len(x), np.int64)
    counts[rows] = np.diff(low.offsets.to_numpy())[rows]
    need = sizes - -(-percent * sizes // 100) + 1
    looked = need + sizes // LOOK_SHARE + LOOK_LEAST
    largest = sizes * 100 // percent
    shown = np.minimum(counts, largest + -percent * largest // 100 + largest // LOOK_SHARE + LOOK_LEAST + need)
    ends = np.cumsum(shown)
    place = np.arange(ends[-1]) - np.repeat(ends - shown, shown)
    hashes = low.values.to_numpy(zero_copy_only=False)[np.repeat(low.offsets.to_numpy()[:-1], shown) + place].view(np.uint64)
    owner = np.repeat(np.arange(len(x)), shown)
    owner[place >= looked[owner]] = _NO_OWNER
    order = np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    several = np.diff(np.append(starts, len(hashes))) > 1
    hashes, owner = hashes[starts], np.where(several, _NO_OWNER, owner[starts])
    bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((owner, bucket))
    hashes, owner, bucket = hashes[order], owner[order].astype("<u2"), bucket[order]
    keys = hashes.astype("<u4")
    bounds = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for number, (start, end) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        if end > start:
            own = start + int(np.count_nonzero(owner[start:end] != _NO_OWNER))
            yield number, owner[start:own].tobytes(), keys[start:end].tobytes()


def _unmet(owners: list[bytes], keys: list[bytes]) -> list[bytes]:
    """Of each batch's owners in a bucket those whose shingle no other batch has."""
    lengths = [len(k) // 4 for k in keys]
    _, inverse, counts = np.unique(np.frombuffer(b"".join(keys), "<u4"), return_inverse=True, return_counts=True)
    single = counts[inverse] == 1
    left, start = [], 0
    for own, length in zip(owners, lengths):
        values = np.frombuffer(own, "<u2")
        left.append(values[single[start : start + len(values)]].tobytes())
        start += length
    return left


def alone(sets: DataFrame, percent: int) -> DataFrame:
    """``x``: sets that link with no other one, as far as their lowest shingles show it.

    ``sets`` has ``x, n, low``: a set's name, size and lowest hashes (:func:`_shown_size` of them,
    or all); rows of one name are copies. Of the shingles a set looks at, a partner lacks fewer than the
    prefix has; so a set with as many that no other set shows has no partner.

    Batches of sets send what they show by buckets of hashes, four bytes a shingle. Equal bytes of
    different shingles, or copies in another batch, only make a set look less alone.
    """
    total = sets.agg(F.sum(_shown_size(F.col("n"), percent))).first()[0] or 0
    buckets = total // BUCKET_SHINGLES + 1
    out = "batch string, bucket int, x binary, enough binary, owners binary, keys binary"
    names = [c.split(" ")[0] for c in out.split(", ")]
    types = [pa.string(), pa.int32(), *[pa.binary()] * 4]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, BATCH_SETS):
                batch = whole_batch.slice(start, BATCH_SETS)
                x = batch.column("x").to_numpy(zero_copy_only=False)
                sizes = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
                name = uuid.uuid4().hex
                enough = (sizes - -(-percent * sizes // 100) + 1).astype("<i4").tobytes()
                rows = [(name, zlib.crc32(name.encode()) % buckets, x.astype("<i8").tobytes(), enough, None, None)]
                rows += [(name, bucket, None, None, owners, keys) for bucket, owners, keys in _sent(x, sizes, batch.column("low"), buckets, percent)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def meet(table: pa.Table) -> pa.Table:
        named = table.filter(pc.is_valid(table["x"])).select(["batch", "x", "enough", "owners"])
        shown = table.filter(pc.is_valid(table["keys"]))
        owners = pa.array(_unmet(shown["owners"].to_pylist(), shown["keys"].to_pylist()), pa.binary())
        blank = pa.nulls(len(owners), pa.binary())
        return pa.concat_tables([named, pa.table({"batch": shown["batch"], "x": blank, "enough": blank, "owners": owners})])

    def count(table: pa.Table) -> pa.Table:
        of = lambda c, kind: np.frombuffer(b"".join(table[c].drop_null().to_pylist()), kind)
        x, enough = of("x", "<i8"), of("enough", "<i4")
        lacking = np.bincount(of("owners", "<u2"), minlength=len(x))
        return pa.table({"x": pa.array(x[lacking >= enough], pa.int64())})

    sent = sets.select("x", "n", "low").mapInArrow(send, out)
    met = sent.groupBy("bucket").applyInArrow(meet, "batch string, x binary, enough binary, owners binary")
    return met.groupBy("batch").applyInArrow(count, "x long")


def _linked(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return shared * 100 >= (a + b - shared) * percent


_BITMAP = ("bits0", "bits1", "bits2", "bits3")


def parity_bitmap(hashes: Column) -> list[Column]:
    """Four 64-bit words; each hash flips one bit of one word, so what two sets share cancels."""

    def word(number: int) -> Column:
        own = F.filter(hashes, lambda h: F.shiftrightunsigned(h, 62) == number)
        bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), (h % 64 + 64).cast("int"))
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(bit(h)))

    return [word(i).alias(c) for i, c in enumerate(_BITMAP)]


def _far_apart(a: str, b: str, percent: int) -> Column:
    """The bitmaps differ in more bits than sets that link may in shingles."""
    differing = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in _BITMAP), F.lit(0))
    return differing * (100 + percent) > (F.col(f"{a}n") + F.col(f"{b}n")) * (100 - percent)


def _prefixes(reps: DataFrame, common: list[int], percent: int) -> DataFrame:
    """``doc, n, own, last_common, last``: each set's prefix under the global order, and its last element.

    Sets are given as ascending hashes, or the lowest of them. The order puts common
    hashes last and goes by hash otherwise. Where the given hashes hold too few that are
    not common, ``own`` is null.
    """
    shared = reps.sparkSession.sparkContext.broadcast(np.array(sorted(common), dtype=np.int64))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            flat = batch.column("low").values.to_numpy(zero_copy_only=False)
            ends = batch.column("low").offsets.to_numpy()
            own, commons, lasts = [], [], []
            for i, n in enumerate(batch.column("n").to_pylist()):
                low = flat[ends[i] : ends[i + 1]]
                need = _prefix_size(n, percent)
                rare, ends_common = low, False
                if len(often):
                    is_common = often[np.minimum(np.searchsorted(often, low), len(often) - 1)] == low
                    rare = low[~is_common]
                    if len(rare) < need and len(low) == n:
                        ends_common = True
                        rare = np.concatenate([rare, low[is_common]])
                enough = len(rare) >= need
                own.append(rare[:need] if enough else None)
                commons.append(ends_common)
                lasts.append(int(rare[need - 1]) if enough else None)
            arrays = [pa.array(own, pa.list_(pa.int64())), pa.array(commons, pa.bool_()), pa.array(lasts, pa.int64())]
            kept = [batch.column("doc"), batch.column("n").cast(pa.int32()), *arrays]
            yield pa.RecordBatch.from_arrays(kept, names=["doc", "n", "own", "last_common", "last"])

    schema = "doc long, n int, own array<long>, last_common boolean, last long"
    return reps.select("doc", "n", "low").mapInArrow(choose, schema)


def _fits(a: str, b: str, percent: int) -> Column:
    """Neither size, bitmap, position in the common list, nor how many lists each is in at all rules the pair out.

    ``hits`` of a set's prefix are in lists with others, and ``past`` shingles follow its prefix.
    """
    an, bn = F.col(f"{a}n"), F.col(f"{b}n")
    rest = F.least(an - F.col(f"{a}place"), bn - F.col(f"{b}place"))
    most = F.least(f"{a}hits", f"{b}hits") + F.greatest(f"{a}past", f"{b}past")
    sizes_fit = F.least(an, bn) * 100 >= F.greatest(an, bn) * percent
    return sizes_fit & ~_far_apart(a, b, percent) & _linked(F.least(rest, most), an, bn, percent)


class _Sets:
    """Whole sets, made again from the texts for those a pair needs."""

    def __init__(self, prefixes: DataFrame, texts: DataFrame, words: int, percent: int):
        self.prefixes, self.texts, self.words, self.percent = prefixes, texts, words, percent

    def measure(self, pairs: DataFrame) -> DataFrame:
        """``a, b, shared, an, bn, linked`` of written pairs, from the whole sets."""
        needed = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
        path = scratch_path(pairs.sparkSession)
        sets = self.texts.join(needed, "doc", "left_semi").select("doc", shingles(F.col("text"), self.words).alias("hashes"))
        full = materialize(sets, path)
        left = full.select(F.col("doc").alias("a"), F.col("hashes").alias("ha"))
        right = full.select(F.col("doc").alias("b"), F.col("hashes").alias("hb"))
        met = pairs.join(right, "b").join(left, "a")
        sizes = met.select("a", "b", F.size(F.array_intersect("ha", "hb")).alias("shared"), F.size("ha").alias("an"), F.size("hb").alias("bn"))
        counted = materialize(sizes.withColumn("linked", _linked(F.col("shared"), F.col("an"), F.col("bn"), self.percent)))
        discard(pairs.sparkSession, path)
        return counted


# What an entry of a list says about its set.
_ENTRY = ("doc", "n", "place", "grp", "hits", "past", *_BITMAP)
# A set's first lists, by which most pairs are taken from the first list they share and no other.
HEADS = 4


def _links(compared: list[DataFrame]) -> DataFrame:
    found = compared[0].where("linked").select("a", "b")
    for more in compared[1:]:
        found = found.unionByName(more.where("linked").select("a", "b"))
    return found


def _grouped(entries: DataFrame, compared: list[DataFrame]) -> DataFrame:
    """Entries of the lists that still span several groups, with the groups."""
    groups = connected_components(_links(compared).select(F.col("a").alias("lid"), F.col("b").alias("rid")))
    named = entries.drop("grp").join(groups.select(F.col("id").alias("doc"), "cluster_id"), "doc", "left")
    path = scratch_path(entries.sparkSession)
    named = materialize(named.withColumn("grp", F.coalesce("cluster_id", "doc")).drop("cluster_id"), path)
    open_lists = named.groupBy("shingle").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1")).where("g0 <> g1")
    left = materialize(named.join(open_lists.select("shingle"), "shingle", "left_semi"))
    discard(entries.sparkSession, path)
    return left


def link_representatives(reps: DataFrame, texts: DataFrame, words: int, percent: int, rounds: int = ROUNDS) -> DataFrame:
    """Links ``(a, b)`` that connect all groups of linked sets.

    ``reps`` has ``doc, n, low`` and the bitmap, ``texts`` has ``doc, text``.
    """
    lowest = reps.select("doc", F.explode(F.slice("low", F.lit(1), _prefix_size(F.col("n"), percent))).alias("shingle"))
    rows = reps.count()
    often = lowest.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > max(COMMON_ROWS, rows // COMMON_SHARE))
    # Bounded by COMMON_SHARE times the mean prefix, whatever the number of rows.
    common = [r.shingle for r in often.select("shingle").collect()]
    first = materialize(_prefixes(reps, common, percent))
    scarce = materialize(first.where("own is null").select("doc"))
    prefixes = first.where("own is not null")
    if not scarce.isEmpty():
        again = texts.join(scarce, "doc", "left_semi").withColumn("low", shingles(F.col("text"), words))
        again = again.select("doc", F.size("low").alias("n"), "low")
        prefixes = materialize(prefixes.unionByName(_prefixes(again, common, percent)))
    entries = prefixes.select("doc", "n", F.posexplode("own").alias("place", "shingle"))
    several = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("shingle")
    path = scratch_path(reps.sparkSession)
    entries = materialize(entries.join(several, "shingle", "left_semi"), path)
    hits = entries.groupBy("doc").agg(F.count(F.lit(1)).cast("int").alias("hits"))
    past = F.col("n") - _prefix_size(F.col("n"), percent)
    bitmaps = reps.select("doc", *_BITMAP)
    entries = materialize(entries.join(hits, "doc").join(bitmaps, "doc").withColumn("past", past))
    discard(reps.sparkSession, path)
    sets = _Sets(prefixes, texts, words, percent)
    compared: list[DataFrame] = []
    left, short = entries.withColumn("grp", F.col("doc")), None
    for number in range(rounds):
        order = F.col("doc") if number == 0 else F.xxhash64("doc", F.lit(number))
        chosen = [order.alias("o"), *[F.col(c).alias(f"l{c}") for c in _ENTRY]]
        leaders = left.groupBy("shingle").agg(F.min(F.struct(*chosen)).alias("x"))
        leaders = leaders.select("shingle", *[F.col("x")[f"l{c}"].alias(f"l{c}") for c in _ENTRY])
        met = left.withColumnsRenamed({c: f"r{c}" for c in _ENTRY}).join(leaders, "shingle")
        met = met.where("ldoc <> rdoc and lgrp <> rgrp").where(_fits("l", "r", percent))
        pairs = met.select(F.least("ldoc", "rdoc").alias("a"), F.greatest("ldoc", "rdoc").alias("b")).distinct()
        for earlier in compared:
            pairs = pairs.join(earlier.select("a", "b"), ["a", "b"], "left_anti")
        compared.append(sets.measure(materialize(pairs)))
        left = _grouped(left, compared)
        if number == 0:  # the pairs of short lists are few; long ones go on by leaders
            long = left.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > SHORT_LIST).select("shingle")
            long = materialize(long)
            short = left.join(long, "shingle", "left_anti")
            left = materialize(left.join(long, "shingle", "left_semi"))
        if left.isEmpty():
            break
    # Groups may have grown since the short lists were set aside.
    return _links([*compared, _rest(_grouped(short.unionByName(left), compared), compared, sets, percent)])


def _met(left: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of open lists across groups that filters allow, most of them from one list only."""
    # All lists that sets of different groups share are open, so the first one among both sets' first is their first.
    firsts = left.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list(F.struct("place", "shingle"))), 1, HEADS).alias("s"))
    left = left.join(firsts.select("doc", F.col("s.shingle").alias("heads")), "doc")
    one, two = (left.select("shingle", *[F.col(c).alias(s + c) for c in (*_ENTRY, "heads")]) for s in "lr")
    shared = F.array_intersect("lheads", "rheads")
    met = one.join(two, "shingle").where("ldoc < rdoc and lgrp <> rgrp").where(_fits("l", "r", percent))
    met = met.where((F.size(shared) == 0) | (F.get(shared, F.lit(0)) == F.col("shingle")))
    return met.select(F.col("ldoc").alias("a"), F.col("rdoc").alias("b"))


def _rest(left: DataFrame, compared: list[DataFrame], sets: _Sets, percent: int) -> DataFrame:
    """All pairs of open lists across groups that filters allow; what the leaders' overlaps settle is not compared."""
    known = compared[0]
    for more in compared[1:]:
        known = known.unionByName(more)
    pairs = _met(left, percent).distinct()
    pairs = materialize(pairs.join(known.select("a", "b"), ["a", "b"], "left_anti"))
    # Each set's closest leader; pairs that have the same one are bounded by it.
    sides = known.select("a", "b", "shared").unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    closest = sides.groupBy("a").agg(F.max(F.struct("shared", F.col("b").alias("l"))).alias("x")).select("a", "x.l", "x.shared")
    closest = materialize(closest)
    sizes = sets.prefixes.select("doc", "n")
    via = (
        pairs.join(closest.select("a", F.col("l").alias("la"), F.col("shared").alias("as_")), "a")
        .join(closest.select(F.col("a").alias("b"), F.col("l").alias("lb"), F.col("shared").alias("bs_")), "b")
        .where("la = lb")
        .join(sizes.select(F.col("doc").alias("a"), F.col("n").alias("an")), "a")
        .join(sizes.select(F.col("doc").alias("b"), F.col("n").alias("bn")), "b")
        .join(sizes.select(F.col("doc").alias("la"), F.col("n").alias("ln")), "la")
    )
    an, bn = F.col("an"), F.col("bn")
    most = F.least(F.col("as_") + bn - F.col("bs_"), F.col("bs_") + an - F.col("as_"))
    least = F.col("as_") + F.col("bs_") - F.col("ln")
    settled = materialize(
        via.select("a", "b", least.alias("shared"), "an", "bn", _linked(least, an, bn, percent).alias("linked"), _linked(most, an, bn, percent).alias("open"))
        .where("linked or not open")
        .drop("open")
    )
    return sets.measure(materialize(pairs.join(settled.select("a", "b"), ["a", "b"], "left_anti"))).unionByName(settled)


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: set size, and the smallest id reachable by links, per row."""
    texts = docs.select(F.col("doc_id").alias("doc"), whole("text").alias("text"))
    hashed = texts.select("doc", shingles(F.col("text"), words).alias("h"))
    # The lowest hashes are kept: the prefix and half as many again, for common ones among them, and what others look for.
    n = F.size("h")
    own = lambda n: (_prefix_size(n, percent) * 3 / 2).cast("int") + 8
    low = F.slice("h", F.lit(1), F.greatest(own(n), _shown_size(n, percent)))
    digest = F.struct(F.xxhash64("h").alias("x"), F.xxhash64(F.lit(7), F.col("h")).alias("y")).alias("digest")
    sets = materialize(hashed.select("doc", n.alias("n"), digest, low.alias("low"), *parity_bitmap(F.col("h"))))
    named = sets.where("n > 0 and doc is not null")
    ids = [F.min("doc").alias("rep"), F.max("doc").alias("last"), F.max(F.col("doc").isNull()).alias("unnamed")]
    first = materialize(sets.where("n > 0").groupBy("digest").agg(*ids).where("rep is not null"))
    lone = materialize(alone(named.select(F.col("digest.x").alias("x"), "n", "low"), percent))
    chosen = materialize(first.withColumn("x", F.col("digest.x")).join(lone, "x", "left_anti").select(F.col("rep").alias("doc"), "digest"))
    kept = sets.withColumn("low", F.slice("low", F.lit(1), own(F.col("n"))))
    reps = materialize(kept.join(chosen, ["doc", "digest"], "left_semi").dropDuplicates(["doc", "digest"]))
    links = link_representatives(reps.select("doc", "n", "low", *_BITMAP), texts, words, percent)
    # Rows with equal ids and different texts are one vertex.
    groups = connected_components(links.select(F.col("a").alias("lid"), F.col("b").alias("rid")))
    # A row without an answer is a group of its own: only digests whose rows are not all named like the group need one.
    answered = first.join(groups.select(F.col("id").alias("rep"), "cluster_id"), "rep", "left")
    answered = answered.withColumn("component_id", F.coalesce("cluster_id", "rep")).where("unnamed or last <> component_id")
    answers = materialize(answered.select("digest", "component_id"))
    rows = sets.select("doc", "n", "digest").withColumn("_salt", F.xxhash64("doc"))
    named = add_columns(rows, answers, "digest", "_salt")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "doc")).otherwise(F.col("doc"))
    return named.select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))
