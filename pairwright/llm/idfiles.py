"""Token ids in compact files: adaptive context-mixing range coding in independent blocks.

A file is a Parquet table of segments. A segment holds whole documents and a list of
blocks of at most ``BLOCK_IDS`` ids; every block starts with an empty model and
carries its own checksum, so any block can be decoded, or found damaged, alone.

Model of a block. An id met for the first time gets the next number, and the block
lists these ids in that order. The next id is coded as one of a few classes: what
followed the last two ids before (order 2), what followed the last id before
(order 1), a new id, or the number of a known id (order 0), which goes by classes of
growing ranges with even places inside. The class frequencies are the sum of three
adaptive counts: over all ids so far, given whether order 1 predicts, and given
whether order 2 predicts and agrees with it. Predictions, numbers and counts are
updated after every id, in the same way by coder and decoder.

Blocks are independent, so a task codes many side by side: each step is one numpy
operation over all of them. A carry-less range coder of 64 bits emits 32 bits at a time.

Defined results: a missing or empty text is the end id alone; documents are written
by ascending id (missing ids first), equal ids in order of their texts; an empty
table gives no segment. Ids of more than 16 bits are an error. Columns other than id and
text are not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize, scratch_path
from .common import whole
from .tokens import encoder

BLOCK_IDS = 4096
LANES = 2048
SEGMENT_IDS = 64 * BLOCK_IDS
END_ID = 2
_CONTEXTS = 4096
# Classes: order 2, order 1, new, then known numbers by ranges.
_BITS = np.array([0, 0, 0, 2, 2, 4, 6, 8, 10, 12], dtype=np.uint64)
_BASE = np.array([0, 0, 0, 1, 5, 9, 25, 89, 345, 1369], dtype=np.int32)
_CLASSES = len(_BITS)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW32 = np.uint64(0xFFFFFFFF)
_WORD = np.uint64(32)
_TOP = np.uint64(1 << 32)


class _Model:
    """Model state of many blocks side by side: one column per block, ids as numbers from 1."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype=np.int64)
        self.after_one = np.zeros(lanes * (BLOCK_IDS + 1), dtype=np.int16)
        self.after_two = np.zeros(lanes * _CONTEXTS, dtype=np.int16)
        self.counts = np.ones((_CLASSES, lanes), dtype=np.int32)
        self.given_one = np.ones((2, _CLASSES, lanes), dtype=np.int32)
        self.given_two = np.ones((3, _CLASSES, lanes), dtype=np.int32)
        self.flat = [x.reshape(-1) for x in (self.counts, self.given_one, self.given_two)]
        self.frequency = np.empty((_CLASSES, lanes), dtype=np.int32)
        self.total = np.empty((_CLASSES, lanes), dtype=np.int32)
        self.lanes, self.lane = lanes, lane
        self.base_one, self.base_two = lane * (BLOCK_IDS + 1), lane * _CONTEXTS
        self.last = np.zeros(lanes, dtype=np.int32)
        self.before = np.zeros(lanes, dtype=np.int32)

    def predict(self) -> None:
        """Class frequencies and their running sums; remembers places and predictions for the update."""
        self.at_one = self.base_one + self.last
        self.at_two = self.base_two + ((self.before * np.int32(40503) + self.last) & np.int32(_CONTEXTS - 1))
        self.one = self.after_one[self.at_one]
        self.two = self.after_two[self.at_two]
        self.some_one = self.one > 0
        self.some_two = self.two > 0
        self.agree = self.some_two & (self.one == self.two)
        frequency = np.where(self.some_two, self.given_two[1], self.given_two[0])
        np.copyto(frequency, self.given_two[2], where=self.agree)
        frequency += np.where(self.some_one, self.given_one[1], self.given_one[0])
        frequency += self.counts
        self.frequency = frequency
        self.total[0] = frequency[0]
        for i in range(1, _CLASSES):  # faster than accumulate along the first axis
            np.add(self.total[i - 1], frequency[i], out=self.total[i])

    def update(self, kind: np.ndarray, number: np.ndarray) -> None:
        """Count the class at ``kind * lanes + lane`` everywhere and remember what followed."""
        counts, given_one, given_two = self.flat
        size = _CLASSES * self.lanes
        counts[kind] += 8
        given_one[kind + self.some_one * size] += 16
        given_two[kind + (self.some_two.view(np.int8) + self.agree.view(np.int8)) * np.int64(size)] += 24
        self.after_one[self.at_one] = number
        self.after_two[self.at_two] = number
        self.before, self.last = self.last, number


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers by first appearance, from 1, and the ids in that order."""
    values, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")
    rank = np.empty(len(first), dtype=np.int32)
    rank[order] = np.arange(1, len(first) + 1, dtype=np.int32)
    return rank[inverse], values[order]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code blocks of ids below 65536, at most ``BLOCK_IDS`` each, longest first.

    A payload is the number of different ids, these ids, and the words of the range coder.
    """
    lanes, steps = len(blocks), len(blocks[0])
    lengths = np.array([len(b) for b in blocks])
    numbers = np.ones((steps, lanes), dtype=np.int32)
    listed = []
    for i, block in enumerate(blocks):
        numbers[: len(block), i], ids = _numbered(block)
        listed.append(np.array([len(ids), *ids], dtype="<u2").tobytes())
    model = _Model(lanes)
    lane = model.lane
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, _FULL, dtype=np.uint64)
    words = np.zeros(lanes * (steps + 8), dtype=np.uint32)
    place = lane * (steps + 8)
    begin = place.copy()
    size = np.zeros(lanes, dtype=np.int32)
    endings = {n: np.flatnonzero(lengths == n) for n in set(lengths.tolist())}
    for step in range(steps):
        number = numbers[step]
        model.predict()
        plain = np.searchsorted(_BASE[4:], number, side="right") + 3
        new = number > size
        plain[new] = 2
        np.maximum(size, number, out=size)
        plain[number == model.one] = 1
        plain[number == model.two] = 0
        kind = plain * lanes + lane
        frequency = model.frequency.reshape(-1)[kind].astype(np.uint64)
        start = model.total.reshape(-1)[kind].astype(np.uint64) - frequency
        unit = span // model.total[-1].astype(np.uint64)
        part = unit * frequency >> _BITS[plain]
        extra = number - _BASE[plain]
        extra[plain < 3] = 0
        low += unit * start + part * extra.astype(np.uint64)
        span = part
        words[place] = low >> _WORD
        due = span < _TOP
        rest = low & _LOW32
        crossing = due & (rest + span > _TOP)
        span = np.where(crossing, _TOP - rest, span)
        low = np.where(due, rest << _WORD, low)
        span = np.where(due, span << _WORD, span)
        place += due
        for i in endings.get(step + 1, ()):  # two words name a place inside the last span
            words[place[i]] = int(low[i]) >> 32
            words[place[i] + 1] = int(low[i]) & 0xFFFFFFFF
            lengths[i] = place[i] + 2 - begin[i]
        model.update(kind, number)
    return [ids + words[b : b + n].astype("<u4").tobytes() for ids, b, n in zip(listed, begin.tolist(), lengths.tolist())]


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """Ids of coded blocks, longest first."""
    lanes, steps = len(payloads), lengths[0]
    listed = []
    width = max(map(len, payloads)) // 4 + 4
    words = np.zeros((lanes, width), dtype=np.uint64)
    for i, payload in enumerate(payloads):
        n = int.from_bytes(payload[:2], "little") or 1
        listed.append(np.frombuffer(payload, dtype="<u2", count=n, offset=2))
        coded = np.frombuffer(payload, dtype="<u4", offset=2 + 2 * n)
        words[i, : len(coded)] = coded
    model = _Model(lanes)
    lane = model.lane
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, _FULL, dtype=np.uint64)
    code = words[:, 0] << _WORD | words[:, 1]
    place = lane * width + 2
    last = lane * width + width - 1
    words = words.reshape(-1)
    numbers = np.empty((steps, lanes), dtype=np.int32)
    size = np.zeros(lanes, dtype=np.int32)
    for step in range(steps):
        model.predict()
        unit = span // model.total[-1].astype(np.uint64)
        value = (code // unit).astype(np.int32)
        plain = np.add.reduce(model.total[:-1] <= value, axis=0, dtype=np.int64)
        kind = plain * lanes + lane
        frequency = model.frequency.reshape(-1)[kind].astype(np.uint64)
        start = unit * (model.total.reshape(-1)[kind].astype(np.uint64) - frequency)
        part = unit * frequency >> _BITS[plain]
        code -= start
        inside = code // part
        taken = part * inside
        code -= taken
        low += start + taken
        number = _BASE[plain] + inside.astype(np.int32)
        new = plain == 2
        size += new
        np.copyto(number, size, where=new)
        np.copyto(number, model.one, where=plain == 1)
        np.copyto(number, model.two, where=plain == 0)
        np.clip(number, 0, BLOCK_IDS, out=number)  # blocks past their end decode nothing that matters
        numbers[step] = number
        span = part
        due = span < _TOP
        rest = low & _LOW32
        crossing = due & (rest + span > _TOP)
        span = np.where(crossing, _TOP - rest, span)
        low = np.where(due, rest << _WORD, low)
        code = np.where(due, code << _WORD | words[place], code)
        span = np.where(due, span << _WORD, span)
        place += due
        np.minimum(place, last, out=place)
        model.update(kind, number)
    return [ids[np.minimum(numbers[:n, i], len(ids)) - 1] for i, (n, ids) in enumerate(zip(lengths, listed))]


def _batched(count: int, lengths: list[int]) -> Iterator[list[int]]:
    """Places by falling length, in groups of at most ``LANES``."""
    order = sorted(range(count), key=lambda i: -lengths[i])
    for start in range(0, count, LANES):
        yield order[start : start + LANES]


def pack_segments(docs: list[tuple[int | None, np.ndarray]]) -> Iterator[tuple[list, list, list, list, list]]:
    """Segments of whole documents: ids, lengths, block lengths, block checksums, block payloads."""
    segments, own, held = [], [], 0
    for doc in docs:
        own.append(doc)
        held += len(doc[1])
        if held >= SEGMENT_IDS:
            segments.append(own)
            own, held = [], 0
    if own:
        segments.append(own)
    blocks: list[np.ndarray] = []
    owner: list[int] = []
    for number, members in enumerate(segments):
        stream = np.concatenate([ids for _, ids in members])
        for start in range(0, len(stream), BLOCK_IDS):
            blocks.append(stream[start : start + BLOCK_IDS])
            owner.append(number)
    payloads: list[bytes] = [b""] * len(blocks)
    for places in _batched(len(blocks), [len(b) for b in blocks]):
        for place, payload in zip(places, encode_blocks([blocks[i] for i in places])):
            payloads[place] = payload
    for number, members in enumerate(segments):
        mine = [i for i, o in enumerate(owner) if o == number]
        sums = [zlib.crc32(blocks[i].astype("<u2").tobytes()) for i in mine]
        yield [d for d, _ in members], [len(x) for _, x in members], [len(blocks[i]) for i in mine], sums, [payloads[i] for i in mine]


_SEGMENT = (
    "part int, segment int, doc_ids array<long>, n_tokens array<long>, "
    "block_ids array<int>, block_crc32 array<long>, blocks array<binary>"
)


def write_ids(docs: DataFrame, tokenizer_json: str, path: str) -> None:
    """Encode all texts, end id appended, and write the ids by ascending document id below ``path``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = END_ID.to_bytes(4, "little")
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.binary())]
    names = [c.split(" ")[0] for c in _SEGMENT.split(", ")]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for segment in pack_segments(held):
                row = (part, number, *segment)
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                values = np.frombuffer(ids + end, dtype="<u4")
                if values.max() > 0xFFFF:
                    raise ValueError("ids of more than 16 bits are not supported")
                held.append((doc_id, values.astype(np.uint16)))
                size += len(values)
                if size >= LANES * BLOCK_IDS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    ordered = docs.select("doc_id", whole("text").alias("text")).repartitionByRange("doc_id")
    ordered.sortWithinPartitions("doc_id", "text").mapInArrow(code, _SEGMENT).write.mode("overwrite").parquet(path)


def decode_segment_blocks(lengths: list[int], sums: list[int], payloads: list[bytes]) -> list[np.ndarray]:
    """Decode blocks of any number of segments; a block that fails its checksum raises."""
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(lengths)
    for places in _batched(len(lengths), lengths):
        decoded = decode_blocks([payloads[i] for i in places], [lengths[i] for i in places])
        for place, ids in zip(places, decoded):
            if zlib.crc32(ids.astype("<u2").tobytes()) != sums[place]:
                raise ValueError("a block is damaged")
            out[place] = ids
    return out


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Documents of files written by :func:`write_ids`: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``)."""
    schema = "part int, segment int, nth int, doc_id long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            flat = decode_segment_blocks(
                [n for r in rows for n in r["block_ids"]],
                [n for r in rows for n in r["block_crc32"]],
                [b for r in rows for b in r["blocks"]],
            )
            out, block = [], 0
            for r in rows:
                stream = np.concatenate(flat[block : block + len(r["blocks"])]).astype("<u4")
                block += len(r["blocks"])
                start = 0
                for nth, (doc_id, n) in enumerate(zip(r["doc_ids"], r["n_tokens"])):
                    ids = stream[start : start + n].tobytes()
                    start += n
                    row = (r["part"], r["segment"], nth, doc_id, n, zlib.crc32(ids))
                    out.append((*row, ids) if keep_ids else row)
            types = [pa.int32()] * 3 + [pa.int64()] * 3 + [pa.binary()] * keep_ids
            names = [c.split(" ")[0] for c in schema.split(", ")]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    stored = spark.read.schema(_SEGMENT).parquet(path)
    found = materialize(stored.mapInArrow(decode, schema))
    # Ids before a segment: running sums over segments inside a part, over the few parts, over a segment's documents.
    segments = materialize(found.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n")))
    parts = segments.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before_part = parts.select("part", F.coalesce(F.sum("n").over(earlier(F.lit(0)).orderBy("part")), F.lit(0)).alias("p"))
    before_segment = segments.select(
        "part", "segment", F.coalesce(F.sum("n").over(earlier("part").orderBy("segment")), F.lit(0)).alias("s")
    )
    inside = F.coalesce(F.sum("n_tokens").over(earlier("part", "segment").orderBy("nth")), F.lit(0))
    return (
        found.withColumn("d", inside)
        .join(before_segment, ["part", "segment"])
        .join(F.broadcast(before_part), "part")
        .select("doc_id", (F.col("p") + F.col("s") + F.col("d")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)
    )


def write_and_read(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Round trip through files; one row per document, read from them."""
    path = scratch_path(docs.sparkSession)
    write_ids(docs, tokenizer_json, path)
    return read_ids(docs.sparkSession, path)
