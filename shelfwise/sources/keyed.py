"""Keyed tables: rows in hash buckets of a key, read by key and changed a batch at a time.

A batch writes one folder with a part per touched bucket, and then swaps the manifest, a small file
that names the live parts of every bucket. Readers follow the newest manifest, so they see a
batch whole or not at all; a writer that is lost before the swap leaves files that nobody names.
A batch number that a run has applied is not applied again. Two writers at once cannot both make the same
version: the second one fails.

``replace`` keeps one row per key and rewrites the touched buckets. ``append`` keeps all rows: parts of a
bucket are folded as they add up, ``FAN`` of a level into one of the next, so a bucket has at most
``FAN`` - 1 parts a level and a row is rewritten once a level, whatever the number of batches.

The table's file system must rename a file atomically, as Spark's own checkpoints demand.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of one level of a bucket that are folded into the next level.
FAN = 8
#: Manifests that are kept for readers of older versions, the newest included.
KEEP = 8


class LostRace(RuntimeError):
    """Another writer made the version first; nothing of this batch is visible."""


class KeyedTable:
    """A table below ``path`` with rows of ``schema``, found by the column ``key``, which is not null.

    ``buckets`` counts for a new table only; take a few buckets per core that reads or writes
    the whole table. An existing one keeps its number.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self._new = {"version": 0, "buckets": buckets, "applied": {}, "parts": {}}
        jvm = spark._jvm
        self._folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    # Reading

    def manifest(self) -> dict:
        """The newest manifest: version, number of buckets, last batch applied per run, and per bucket
        its live parts as [folder, level], oldest first."""
        versions = self.versions()
        return self._load(versions[-1]) if versions else self._new

    def versions(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(self._folder))
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def snapshot(self) -> DataFrame:
        """All rows of the newest version."""
        manifest = self.manifest()
        return self._rows(manifest, range(manifest["buckets"]))

    def lookup(self, keys: DataFrame, few: bool = False) -> DataFrame:
        """The rows of some keys, from their buckets only. ``few`` says that the keys fit a broadcast."""
        manifest = self.manifest()
        wanted = keys.select(self.key).distinct()
        touched = self._touched(wanted, manifest)
        rows = self._rows(manifest, touched)
        return rows.join(F.broadcast(wanted) if few else wanted, self.key, "left_semi")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _touched(self, keys: DataFrame, manifest: dict) -> list[int]:
        """The bucket numbers of some keys: no more than the table has buckets."""
        found = keys.select(self._bucket(manifest["buckets"]).alias("bucket")).distinct().collect()
        return sorted(row["bucket"] for row in found)

    def _rows(self, manifest: dict, buckets: Iterable[int]) -> DataFrame:
        parts = manifest["parts"]
        return self._read([(part, b) for b in buckets for part, _ in parts.get(str(b), [])])

    def _read(self, parts: list[tuple[str, int]]) -> DataFrame:
        folders = [f"{self.path}/data/{part}/bucket={bucket}" for part, bucket in parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    # Writing

    def next_run(self) -> int:
        """A run number that the table has not seen, for a job with a new checkpoint."""
        return 1 + max([0, *map(int, self.manifest()["applied"])])

    def replace(self, rows: DataFrame, batch: int, run: int = 1) -> bool:
        """Put rows, at most one per key, in place of the keys' old ones. False for a batch applied before.

        ``rows`` are read twice here and in ``append``: pass a stored table.
        """
        manifest = self.manifest()
        if self._applied(manifest, batch, run):
            return False
        rows = rows.select(*self.schema.names)
        touched = self._touched(rows, manifest)
        parts = dict(manifest["parts"])
        if touched:
            old = self._rows(manifest, touched).join(rows.select(self.key), self.key, "left_anti")
            part = self._write(old.unionByName(rows), manifest)
            parts |= {str(b): [[part, 0]] for b in touched}
        self._commit(manifest, parts, batch, run)
        return True

    def append(self, rows: DataFrame, batch: int, run: int = 1) -> bool:
        """Add rows; several may share a key. False for a batch applied before."""
        manifest = self.manifest()
        if self._applied(manifest, batch, run):
            return False
        rows = rows.select(*self.schema.names)
        parts, folded = dict(manifest["parts"]), []
        touched = self._touched(rows, manifest)
        levels = {}
        for bucket in touched:
            kept, fold, levels[bucket] = fold_parts(parts.get(str(bucket), []))
            parts[str(bucket)] = kept
            folded += [(part, bucket) for part in fold]
        if touched:
            part = self._write(rows.unionByName(self._read(folded)) if folded else rows, manifest)
            for bucket in touched:
                parts[str(bucket)] = [*parts[str(bucket)], [part, levels[bucket]]]
        self._commit(manifest, parts, batch, run)
        return True

    def rebucket(self, buckets: int) -> None:
        """Deal all rows to another number of buckets, in a new version."""
        manifest = self.manifest()
        rows = self._rows(manifest, range(manifest["buckets"]))
        wider = manifest | {"buckets": buckets}
        part = self._write(rows, wider)
        held = self._touched(rows, wider)
        # The whole table is one part again: as high a level as its parts had.
        level = max((level for parts in manifest["parts"].values() for _, level in parts), default=0)
        self._commit(wider, {str(b): [[part, level]] for b in held}, None, None)

    def _applied(self, manifest: dict, batch: int, run: int) -> bool:
        return batch <= manifest["applied"].get(str(run), -1)

    def _write(self, rows: DataFrame, manifest: dict) -> str:
        """A new folder with a part per bucket; large buckets are split over tasks and files."""
        part = f"{manifest['version'] + 1:012d}-{uuid.uuid4().hex}"
        dealt = rows.withColumn("bucket", self._bucket(manifest["buckets"])).hint("rebalance", "bucket")
        dealt.sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(f"{self.path}/data/{part}")
        return part

    def _commit(self, manifest: dict, parts: dict, batch: int | None, run: int | None) -> None:
        applied = manifest["applied"] if run is None else manifest["applied"] | {str(run): batch}
        version = manifest["version"] + 1
        self._swap(version, {"version": version, "buckets": manifest["buckets"], "applied": applied, "parts": parts})
        self._expire()

    def _swap(self, version: int, manifest: dict) -> None:
        jvm = self.spark._jvm
        path, rename = jvm.org.apache.hadoop.fs.Path, getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        draft = path(self._folder, f".{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self.spark._jsc.hadoopConfiguration())
        target = path(self._folder, f"{version:012d}.json")
        if version in self.versions():
            self._files.delete(draft, False)
            raise LostRace(f"version {version} of {self.path} is there already")
        try:
            context.rename(self._files.makeQualified(draft), self._files.makeQualified(target), never)
        except Exception as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise LostRace(f"version {version} of {self.path} is there already") from error
            raise

    def _load(self, version: int) -> dict:
        jvm = self.spark._jvm
        stream = self._files.open(jvm.org.apache.hadoop.fs.Path(self._folder, f"{version:012d}.json"))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # Clearing

    def _expire(self) -> None:
        """Drop the manifests beyond ``KEEP``, and the parts that only those name. Nothing is
        listed but the manifests."""
        versions = self.versions()
        if len(versions) <= KEEP:
            return
        # Parts come and go in order, so what the oldest kept version has not is in no later one.
        live = _named(self._load(versions[-KEEP]))
        for version in versions[:-KEEP]:
            for part, bucket in _named(self._load(version)) - live:
                self._delete(f"data/{part}/bucket={bucket}")
            self._delete(f"manifests/{version:012d}.json")

    def sweep(self) -> int:
        """Delete what lost writers left and folders whose parts have all gone; returns how many.

        Unlike the rest this lists the data folder; run it now and then, not per batch.
        """
        data = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        versions = self.versions()
        if not versions or not self._files.exists(data):
            return 0
        live = {part for version in versions for part, _ in _named(self._load(version))}
        names = [status.getPath().getName() for status in self._files.listStatus(data)]
        # A writer that is still at work aims at a version that is not there yet.
        gone = [name for name in names if name not in live and int(name.split("-")[0]) <= versions[-1]]
        for name in gone:
            self._delete(f"data/{name}")
        return len(gone)

    def _delete(self, name: str) -> None:
        self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)


def fold_parts(parts: list[list]) -> tuple[list[list], list[str], int]:
    """For a new part of a bucket: the [folder, level] parts that stay, those folded into the new one, its level."""
    level, folded = 0, []
    while len(same := [part for part, at in parts if at == level]) + 1 >= FAN:
        folded += same
        level += 1
    gone = set(folded)
    return [entry for entry in parts if entry[0] not in gone], folded, level


def _named(manifest: dict) -> set[tuple[str, int]]:
    return {(part, int(bucket)) for bucket, parts in manifest["parts"].items() for part, _ in parts}
