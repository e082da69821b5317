"""Packing documents into training sequences by minimum bin slack.

A document longer than a sequence is cut into full pieces and a rest. Which pieces
share a sequence depends on their lengths alone, and there are at most as many
lengths as a sequence has places. So the driver plans on the histogram of lengths,
whose size does not grow with the data: per bin, a subset-sum table kept as one
bitset over the available lengths finds the fullest combination around the longest
piece left; it is removed as often as the counts allow. Each such step uses up a
length, hence the plan is short. Tasks then look up each piece's place in the plan
from its rank among the pieces of its length, which is a running count inside the
task that made it plus an offset per task.

Defined results: a missing or empty text is the end id alone; equal rows are
packed each on their own; no table, no sequences. Columns of the input other than
id and text are not used.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import add_columns, whole
from .tokens import encoder

SEQUENCE_TOKENS = 2048
END_ID = 0


def tokenize_pieces(docs: DataFrame, tokenizer_json: str, capacity: int = SEQUENCE_TOKENS, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32, part, nth`` (and ``ids``).

    ``nth`` counts the pieces of one length within the task ``part``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids binary" * keep_ids
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            columns: list[list] = [[] for _ in range(7 + keep_ids)]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                ids += end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(own), part, seen[length])
                    seen[length] += 1
                    for column, value in zip(columns, (*row, own) if keep_ids else row):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names[: len(arrays)])

    return docs.select("doc_id", whole("text").alias("text")).mapInArrow(cut, schema)


def fullest(counts: Mapping[int, int], order: list[int], room: int) -> dict[int, int]:
    """The combination of available lengths that fills ``room`` best: ``{length: times}``.

    Bit i of the set is on when some combination has length i. Each length enters in
    doubling amounts up to what is there; the sets before each step lead back.
    """
    reach, steps, everything = 1, [], (1 << (room + 1)) - 1
    for length in order:
        left = min(counts[length], room // length)
        amount = 1
        while left > 0:
            amount = min(amount, left)
            steps.append((length, amount, reach))
            reach |= (reach << (length * amount)) & everything
            left -= amount
            amount *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, amount, before in reversed(steps):
        if not before >> total & 1:
            total -= length * amount
            chosen[length] = chosen.get(length, 0) + amount
    return chosen


def plan(histogram: Mapping[int, int], capacity: int = SEQUENCE_TOKENS) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length its ranges of ranks: ``(first rank, pieces per sequence, first sequence, offset)``."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    order = sorted(counts, reverse=True)
    ranks = dict.fromkeys(order, 0)
    placed: dict[int, list[tuple[int, int, int, int]]] = {length: [] for length in order}
    sequence = 0
    while order:
        longest = order[0]
        counts[longest] -= 1
        chosen = fullest(counts, [x for x in order if counts[x] and x <= capacity - longest], capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[x] // n for x, n in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            placed[length].append((ranks[length], n, sequence, offset))
            ranks[length] += n * times
            counts[length] -= n * times
            offset += n * length
        sequence += times
        order = [x for x in order if counts[x]]
    return placed


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Add ``sequence_id, offset`` to a written table of pieces (see :func:`tokenize_pieces`)."""
    slot = (F.col("part").cast("long") * (capacity + 1) + F.col("length")).alias("slot")
    sizes = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(slot, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shared = pieces.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    ranked = add_columns(pieces.withColumn("slot", slot), materialize(offsets), "slot", None)
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth")).drop("slot", "base", "nth", "part")
    kept = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(*kept).schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = shared.value
        firsts = {length: [r[0] for r in rows] for length, rows in ranges.items()}
        for batch in batches:
            sequences, offsets = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                first, n, sequence, offset = ranges[length][bisect_right(firsts[length], rank) - 1]
                sequences.append(sequence + (rank - first) // n)
                offsets.append(offset + (rank - first) % n * length)
            arrays = [batch.column(c) for c in kept] + [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_json: str, capacity: int = SEQUENCE_TOKENS, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(materialize(tokenize_pieces(docs, tokenizer_json, capacity, keep_ids)), capacity)
