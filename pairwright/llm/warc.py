"""Web archives: writing, reading back, and the merged index of captures.

Archives are gzip-compressed WARC 1.1 files in a folder. Of records with equal
payloads of some size, the one with the smallest page id is a response and the
others are revisits that name it and carry no payload; all of them carry length
and digest of the full payload. Each task that reads archives yields the captures
of its files; tasks leave them as sorted runs, and the index is made by an external
merge: the key range is dealt out, and for each part a loser tree merges the runs'
slices by URL key, time and record.

Defined results: a missing html is an empty payload; a missing url has an empty key
and sorts first; rows with equal page id and payload are all responses; a missing
page id is archived as such and never referred to (if no row with that payload has
an id, all are responses). The payload of a record may hold any text.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path
from .common import add_columns, whole

MIN_REVISIT_BYTES = 100
# Records of one file; bounds what a task must hold to read it.
FILE_RECORDS = 20_000
_BREAK = "\r\n"
_EPOCH = "2020-01-01 00:00:00"


def url_key(url: Column) -> Column:
    """Sortable form: host parts from the last on, without scheme, ``www.``, port 80/443 and fragment."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r"^www\d*\.|:(?:80|443)$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    turned = F.array_join(F.reverse(F.split(host, r"\.", -1)), ",")
    return F.when(bare == "", F.lit("")).otherwise(F.concat(turned, F.lit(")"), rest))


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``payload, payload_bytes, payload_digest, record_type, refers_to``.

    Equal payloads meet as digests: their smallest page ids are found by a map-side
    combined aggregation, and only payloads that repeat are looked up.
    """
    payload = whole("html")
    sized = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}
    )
    repeated = (
        sized.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", "first_id")
    )
    looked_up = add_columns(sized, materialize(repeated), "payload_digest", "page_id")
    revisits = F.coalesce(F.col("first_id") < F.col("page_id"), F.col("first_id").isNotNull() & F.col("page_id").isNull())
    return looked_up.withColumns(
        {
            "record_type": F.when(revisits, "revisit").otherwise("response"),
            "refers_to": F.when(revisits, F.col("first_id")),
        }
    ).drop("first_id")


def write_archives(pages: DataFrame, path: str, date: Column | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one record per page below ``path``; the text writer ends each record with two line breaks.

    ``date`` is the capture time; without one, page ids count seconds from a fixed day.
    """
    seconds = F.unix_timestamp(F.lit(_EPOCH)) + F.coalesce(F.col("page_id"), F.lit(0))
    stamp = date if date is not None else F.timestamp_seconds(seconds)
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    # A line break in a url would end its header.
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Date: "), F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.concat(F.lit("X-URL-Key: "), F.regexp_replace(url_key(F.col("url")), r"[\r\n]", "")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit("WARC-Refers-To: "), urn("refers_to"))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    record = F.concat(F.concat_ws(_BREAK, *lines), F.lit(_BREAK * 2), body)
    writer = plan_records(pages, min_bytes).select(record.alias("value")).write.mode("overwrite")
    writer.option("lineSep", _BREAK * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


CAPTURE = (
    "url_key string, captured string, page_id long, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, file string, place long"
)


def _page(urn: str | None) -> int | None:
    value = (urn or "")[len("<urn:page:") : -1]
    return int(value) if value and value != "none" else None


def parse_archive(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(place, headers, body)`` of every record; lengths come from the headers, never from the contents."""
    place = 0
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record at {place}")
        size, headers = len(version), {}
        while (line := stream.readline()).strip():
            size += len(line)
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        body = stream.read(int(headers["Content-Length"]))
        end = stream.read(4)
        if end != b"\r\n\r\n":
            raise ValueError(f"record at {place} is cut off")
        yield place, headers, body
        place += size + len(line) + len(body) + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All captures of the archives below ``path``; the payload of every response is measured and checked."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                with gzip.open(io.BytesIO(memoryview(content.as_buffer()))) as stream:
                    for place, headers, body in parse_archive(stream):
                        size = int(headers["X-Payload-Length"])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        if headers["WARC-Type"] == "response":
                            if (len(body), hashlib.sha256(body).hexdigest()) != (size, digest):
                                raise ValueError(f"{name}: payload of {headers['WARC-Record-ID']} is damaged")
                        rows.append(
                            (
                                headers["X-URL-Key"],
                                headers["WARC-Date"],
                                _page(headers["WARC-Record-ID"]),
                                headers["WARC-Type"],
                                size,
                                digest,
                                _page(headers.get("WARC-Refers-To")),
                                name.rpartition("/")[2],
                                place,
                            )
                        )
                yield from _captures(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(parse, CAPTURE)


def _captures(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.string()] * 2 + [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split(" ")[0] for part in CAPTURE.split(", ")]
    if rows:
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


class LoserTree:
    """Merges sorted iterators: inner nodes keep the loser of their match, the winner goes up.

    After taking the winner, only the matches on its way to the root are played again.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.width = max(1, len(runs))
        self.heads = [next(run, None) for run in runs]
        self.losers = [-1] * self.width
        for leaf in range(len(runs)):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, winner: int) -> None:
        node = (winner + self.width) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # still being built: wait here for the other side
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs:
            winner = self.losers[0]
            if self.heads[winner] is None:
                return
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def merge_index(captures: DataFrame) -> DataFrame:
    """Globally ordered capture histories: rows by URL key, time, page id, file and place.

    The written captures are dealt by ranges of the full key, so that one url with
    any number of captures spreads over tasks; in a task each file's slice is a
    sorted run, and the runs are merged.
    """
    key = ["url_key", "captured", "page_id", "file", "place"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        url, time, page, file, place = (table.column(c).to_pylist() for c in key)
        starts = [i for i in range(len(file)) if i == 0 or file[i] != file[i - 1]] + [len(file)]

        def run(start: int, end: int) -> Iterator[tuple]:
            for i in range(start, end):
                yield (url[i], time[i], page[i] is not None, page[i] or 0, file[i], place[i]), i

        merged = LoserTree([run(*ends) for ends in zip(starts, starts[1:])])
        yield from table.take(pa.array([i for _, i in merged], pa.int64())).to_batches()

    dealt = captures.repartitionByRange(*key).sortWithinPartitions("file", *key)
    return dealt.mapInArrow(merge, captures.schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write archives, read them back and return the merged index, one row per page."""
    spark = pages.sparkSession
    path = scratch_path(spark)
    write_archives(pages, path)
    return merge_index(materialize(read_archives(spark, path)))
