"""Results that are either whole or not there.

A result is one or more tables that belong together, with the settings they were computed
with. Every commit writes its tables into a new folder and then, last, one small manifest
that names them, their row counts and checksums. Readers go by the newest manifest, so a
job that dies on the way leaves the earlier result as it was, and settings never stand
beside data they do not belong to. Nothing is renamed, as object stores cannot do that at
once; manifests are numbered and written under names that did not exist before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import discard


@dataclass(frozen=True)
class Manifest:
    """``tables``: for each name the folders it is made of, its rows and its checksum."""

    number: int
    settings: dict
    tables: dict[str, dict]

    def text(self) -> str:
        return json.dumps({"number": self.number, "settings": self.settings, "tables": self.tables}, sort_keys=True)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifests"


def latest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest complete manifest; None where nothing was ever committed."""
    folder, files = _file_system(spark, _manifests(path))
    if not files.exists(folder):
        return None
    names = sorted((status.getPath().getName() for status in files.listStatus(folder)), reverse=True)
    for name in names:
        found = _read(spark, f"{_manifests(path)}/{name}")
        if found is not None:
            return found
    return None


def _read(spark: SparkSession, path: str) -> Manifest | None:
    lines = [row.value for row in spark.read.text(path, wholetext=True).collect()]
    try:  # a manifest cut short by a crash is no manifest
        return Manifest(**json.loads(lines[0])) if lines else None
    except (ValueError, TypeError):
        return None


def _write_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    target, files = _file_system(spark, f"{_manifests(path)}/{manifest.number:08d}.json")
    stream = files.create(target, False)  # fails if another job committed this number first
    try:
        stream.write(bytearray(manifest.text().encode()))
    finally:
        stream.close()


def measure(df: DataFrame) -> dict:
    """Rows and an order-free checksum of a table; maps, which have no hash, are written out for it."""
    columns = [
        F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    checksum = F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))
    row = df.agg(F.count(F.lit(1)).alias("rows"), checksum.cast("string").alias("checksum")).first()
    return {"rows": row["rows"], "checksum": row["checksum"]}


def commit(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, DataFrame],
    settings: dict,
    keep: Mapping[str, list[str]] | None = None,
) -> Manifest:
    """Write ``tables`` as the new result at ``path``.

    ``keep`` names folders of earlier commits that a table goes on with: the new rows, if
    there are any, are added to theirs without writing them again.
    """
    before = latest(spark, path)
    base = f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"
    folders_of = {name: list(folders) for name, folders in (keep or {}).items()}
    for name, df in tables.items():
        folder = f"{base}/{name}"
        df.write.parquet(folder)
        folders_of[name] = [*folders_of.get(name, []), folder]
    described = {}
    for name, folders in folders_of.items():
        described[name] = {"folders": folders, **measure(spark.read.parquet(*folders))}
    manifest = Manifest(before.number + 1 if before else 1, settings, described)
    _write_manifest(spark, path, manifest)
    return manifest


def read_table(spark: SparkSession, manifest: Manifest, name: str) -> DataFrame:
    """A committed table."""
    return spark.read.parquet(*manifest.tables[name]["folders"])


def damaged(spark: SparkSession, manifest: Manifest) -> list[str]:
    """Names of tables that no longer hold what was committed."""
    bad = []
    for name, described in manifest.tables.items():
        if measure(read_table(spark, manifest, name)) != {k: described[k] for k in ("rows", "checksum")}:
            bad.append(name)
    return bad


def up_to_date(
    spark: SparkSession, path: str, settings: dict, compute: Callable[[], Mapping[str, DataFrame]]
) -> tuple[Manifest, bool]:
    """The result with these settings and whether it had to be computed.

    ``compute`` runs only where there is no result yet or one with other settings.
    """
    found = latest(spark, path)
    if found is not None and found.settings == settings:
        return found, False
    return commit(spark, path, compute(), settings), True


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete folders that no manifest's newest tables use; returns how many.

    Only for when no job reads an earlier result or is about to commit.
    """
    current = latest(spark, path)
    used = {f.rstrip("/").rsplit("/", 2)[-2] for t in current.tables.values() for f in t["folders"]} if current else set()
    root, files = _file_system(spark, path)
    if not files.exists(root):
        return 0
    names = [s.getPath().getName() for s in files.listStatus(root)]
    stale = [n for n in names if n.startswith("data-") and n not in used]
    for name in stale:
        discard(spark, f"{path.rstrip('/')}/{name}")
    return len(stale)
