"""Versioned Parquet tables: immutable ``v<n>`` manifests, the largest committed one is current.

A version is written aside and renamed into place; the rename of a number that is taken
fails, so of two writers one wins and the other starts again from the new state.  All
folder work goes through Hadoop's file system, so any store that Spark reads will do.

A table is laid out in hash buckets of its keys (or of the columns it is bucketed by).  Their number
follows the table's size: a write that finds them fuller than BUCKET_BYTES on average doubles it as often
as needed, which is a whole rewrite, but one that gets rarer as the table grows.  Every other write
rewrites only the buckets that its keys touch, each by a task of its own; the others are carried over by name in
the manifest.  Retention writes no data at all: the manifest notes the floor for every bucket, reads
apply it, and a bucket that is rewritten for another reason loses its old rows then.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.schema import Table

BUCKET_BYTES, TRIES = 256 << 20, 5


class Conflict(RuntimeError):
    """Another writer committed first."""


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 8, bucket_bytes: int = BUCKET_BYTES) -> None:
        self.spark, self.root, self.buckets, self.bucket_bytes = spark, root.rstrip("/"), buckets, bucket_bytes
        self.guard: Callable[[], None] | None = None  # asked before each commit

    # -- folders -------------------------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, table: str) -> list[int]:
        path = self._path(table)
        if not self._fs().exists(path):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(path)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _manifest(self, table: str, version: int) -> dict:
        """buckets (number -> folder), n (how many there are), floors (number -> column -> least value), bytes."""
        text = self.spark.read.text(f"{self.root}/{table}/v{version}.json", wholetext=True).first()[0]
        return json.loads(text)

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def require(self, table: str) -> None:
        if not self.exists(table):
            raise LookupError(f"table {table} isn't in {self.root}; create it first (Store.create)")

    # -- reads ---------------------------------------------------------------------------
    def _rows(self, table: Table, manifest: Mapping, only: set[str] | None = None) -> DataFrame:
        """The rows of all buckets (or of some); buckets of the same floors are one scan."""
        scans: dict[str, list[str]] = {}
        for k, folder in manifest["buckets"].items():
            if only is None or k in only:
                scans.setdefault(json.dumps(manifest["floors"].get(k, {}), sort_keys=True), []).append(f"{self.root}/{table.name}/{folder}")
        frames = []
        for floors, paths in scans.items():
            df = self.spark.read.schema(table.schema).parquet(*paths)
            for column, least in json.loads(floors).items():
                df = merge.retained(df, column, F.lit(least).cast(table.schema[column].dataType))
            frames.append(df)
        return reduce(DataFrame.unionByName, frames) if frames else table.empty(self.spark)

    def _current(self, name: str, version: int | None = None) -> dict:
        return self._manifest(name, self.versions(name)[-1] if version is None else version)

    def read(self, table: Table, version: int | None = None) -> DataFrame:
        self.require(table.name)
        return self._rows(table, self._current(table.name, version))

    def read_keys(self, table: Table, keys: DataFrame) -> DataFrame:
        """The buckets that may hold rows of the given values of the columns the table is bucketed by."""
        self.require(table.name)
        manifest = self._current(table.name)
        return self._rows(table, manifest, self._touched(table, manifest["n"], keys))

    def changes(self, table: Table, before: int, after: int | None = None) -> DataFrame:
        """Change feed between two versions; buckets that both share aren't read."""
        old, new = self._current(table.name, before), self._current(table.name, after)
        if old["n"] != new["n"]:
            return merge.change_feed(self._rows(table, old), self._rows(table, new), table.keys)
        same = lambda k: old["buckets"].get(k) == new["buckets"].get(k) and old["floors"].get(k) == new["floors"].get(k)
        differ = {k for k in old["buckets"].keys() | new["buckets"].keys() if not same(k)}
        return merge.change_feed(self._rows(table, old, differ), self._rows(table, new, differ), table.keys)

    # -- writes --------------------------------------------------------------------------
    def create(self, table: Table) -> None:
        """Idempotent."""
        if not self.exists(table.name):
            self._commit(table.name, -1, {})

    def _commit(self, name: str, seen: int, buckets: Mapping[str, str], n: int | None = None, floors: Mapping | None = None, size: int = 0) -> int:
        if self.guard:
            self.guard()
        fs, version = self._fs(), seen + 1
        aside, final = self._path(name, f"_{uuid.uuid4().hex}"), self._path(name, f"v{version}.json")
        out = fs.create(aside)
        out.write(bytearray(json.dumps({"buckets": dict(buckets), "n": n or self.buckets, "floors": dict(floors or {}), "bytes": size}).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            raise Conflict(f"{name}: version {version} is taken")
        return version

    @staticmethod
    def _bucket(table: Table, n: int) -> Column:
        return F.pmod(F.xxhash64(*(table.bucket_by or table.keys)), F.lit(n))

    def _touched(self, table: Table, n: int, keys: DataFrame) -> set[str]:
        return {str(r[0]) for r in keys.select(self._bucket(table, n)).distinct().collect()}  # at most n rows

    def _replace(self, table: Table, keys: DataFrame, build: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite by ``build`` the buckets that the keys touch; all of them if there are too few for the table's size."""
        for attempt in range(TRIES):
            seen = self.versions(table.name)[-1]
            old = self._manifest(table.name, seen)
            n = old["n"]
            while old["bytes"] / n > self.bucket_bytes:
                n *= 2
            take = self._touched(table, n, keys) if n == old["n"] else set(old["buckets"])
            folder = f"data/{uuid.uuid4().hex}"
            out = build(self._rows(table, old, take)).withColumn("_bucket", self._bucket(table, n))
            out.repartition(n if n > old["n"] else max(1, len(take)), "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{table.name}/{folder}")
            made = [s.getPath() for s in self._fs().listStatus(self._path(table.name, folder)) if "=" in s.getPath().getName()]
            fresh = {p.getName().partition("=")[2]: f"{folder}/{p.getName()}" for p in made}
            kept = {k: p for k, p in old["buckets"].items() if k not in take} | fresh
            floors = {k: f for k, f in old["floors"].items() if k in kept and k not in fresh}
            grown = self._fs().getContentSummary(self._path(table.name, folder)).getLength()
            lost = old["bytes"] * len(take & set(old["buckets"])) // max(1, len(old["buckets"]))
            try:
                self._commit(table.name, seen, kept, n, floors, max(0, old["bytes"] - lost) + grown)
                return
            except Conflict:
                if attempt + 1 == TRIES:
                    raise

    def upsert(self, table: Table, source: DataFrame) -> int:
        """Rows written; an empty batch writes nothing, a batch that repeats a key is refused.

        The source is evaluated once: its rows are written aside first."""
        self.create(table)
        source = table.check(source)
        seen = Observation()
        staged = f"{self.root}/{table.name}/data/{uuid.uuid4().hex}"
        source.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
        try:
            rows = seen.get["rows"]
            if not rows:
                return 0
            batch = self.spark.read.schema(table.schema).parquet(staged)
            twice = merge.duplicate_keys(batch, table.keys).first()
            if twice:
                raise merge.DuplicateKeys(f"{table.name}: {twice.asDict()}")
            self._replace(table, batch, lambda old: merge.upserted(old, batch, table.keys))
            return rows
        finally:
            self._fs().delete(self._path(*staged.removeprefix(self.root + "/").split("/")), True)

    def insert_absent(self, table: Table, source: DataFrame) -> None:
        """Of rows of one key the first by its columns' text counts."""
        self.create(table)
        batch = merge.latest_per_key(table.check(source), table.keys, [F.to_json(F.struct(*table.schema.fieldNames()))])
        self._replace(table, batch, lambda old: merge.with_absent(old, batch, table.keys))

    def delete_keys(self, table: Table, gone: DataFrame) -> None:
        """``gone`` holds the table's keys."""
        self.require(table.name)
        self._replace(table, gone, lambda old: merge.without_keys(old, gone, table.keys))

    def retain(self, table: Table, column: str, floor: date | datetime | int | str) -> None:
        """Rows before the floor go, nulls stay: noted in the manifest for the buckets there are.  Rows that come later aren't concerned."""
        self.require(table.name)
        least = floor.astimezone(UTC).isoformat(timespec="microseconds") if isinstance(floor, datetime) else floor.isoformat() if isinstance(floor, date) else floor
        for attempt in range(TRIES):
            seen = self.versions(table.name)[-1]
            old = self._manifest(table.name, seen)
            after = lambda f: f | {column: max(f.get(column, least), least)}
            try:
                self._commit(table.name, seen, old["buckets"], old["n"], {k: after(old["floors"].get(k, {})) for k in old["buckets"]}, old["bytes"])
                return
            except Conflict:
                if attempt + 1 == TRIES:
                    raise

    def vacuum(self, table: Table, keep: int = 10, hours: float = 168) -> int:
        """Remove the manifests of all but the last ``keep`` versions, and data folders that none of those
        names, if they are older than ``hours`` (a writer under way, or a reader of an old version, is younger).  Returns
        how many went."""
        self.require(table.name)
        fs, versions = self._fs(), self.versions(table.name)
        held = {p.partition("/_bucket=")[0] for v in versions[-keep:] for p in self._manifest(table.name, v)["buckets"].values()}
        oldest = (time.time() - hours * 3600) * 1000
        stale = [self._path(table.name, f"v{v}.json") for v in versions[:-keep]]
        data = self._path(table.name, "data")
        if fs.exists(data):
            stale += [s.getPath() for s in fs.listStatus(data) if f"data/{s.getPath().getName()}" not in held]
        gone = [p for p in stale if fs.getFileStatus(p).getModificationTime() <= oldest]
        for p in gone:
            fs.delete(p, True)
        return len(gone)
