"""Versioned tables: bucketed Parquet files under manifests, committed as a whole or not at all.

A version is a small JSON file that names, for each table and bucket of its key, the folders that
hold its rows. A commit first writes new folders, then publishes the next manifest under a name
that must not be there yet; folders are never changed. So readers see one version, whatever
happens meanwhile; a writer that is killed leaves folders that no manifest names; and of two
writers one finds the name taken. That one looks at what the others wrote: if they wrote to
buckets that it relied on it fails, else it publishes on top of theirs.

Only the buckets of the keys that come are read and written again. A key's bucket is a hash, and
rows are dealt to tasks by bucket with splitting of large ones, so a hot key isn't one task's.

The name is taken by a hard link where the file system is the driver's own, and elsewhere by a
rename that doesn't overwrite, which must be atomic (it is on HDFS; a store without one needs a
table format of its own).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.operators import relational


class Conflict(RuntimeError):
    """Another writer changed buckets that this one had read."""


@dataclass
class Staged:
    """Rows written to a folder of their own that no version names yet. With ``replaces`` they stand for all of these buckets."""

    table: str
    key: tuple[str, ...]
    schema: T.StructType
    folder: str
    written: dict[int, str]
    frame: DataFrame
    replaces: tuple[int, ...] | None = None

    def replacing(self, buckets: Iterable[int]) -> Staged:
        self.replaces = tuple(buckets)
        if strays := set(self.written) - set(self.replaces):
            raise ValueError(f"rows of {self.table} fall in buckets that aren't replaced: {sorted(strays)[:5]}")
        return self


class Versions:
    """The tables under one folder, and their history. ``buckets`` counts for a new folder; an old one keeps its own."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._fs.getUri().getScheme() == "file"
        self._fs.mkdirs(self._path(f"{self.root}/versions"))
        last = self.latest()
        self.buckets = self.manifest(last)["buckets"] if last else buckets

    # ---- manifests

    def _name(self, version: int) -> str:
        return f"{self.root}/versions/{version:020d}.json"

    def latest(self) -> int:
        """The newest version; 0 if nothing was committed."""
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.root}/versions"))]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[0].isdigit()), default=0)

    def manifest(self, version: int) -> dict:
        if not version:
            return {"version": 0, "buckets": self.buckets, "tables": {}, "wrote": {}, "note": {}}
        stream = self._fs.open(self._path(self._name(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _published(self, version: int, manifest: dict) -> bool:
        """Whether this manifest became the version; False if another was there first."""
        body = json.dumps(manifest, sort_keys=True)
        draft = f"{self.root}/versions/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), False)
        try:
            out.write(bytearray(body.encode()))
        finally:
            out.close()
        if self._local:
            plain = lambda p: self._path(p).toUri().getPath()
            try:
                os.link(plain(draft), plain(self._name(version)))
                return True
            except FileExistsError:
                return False
            finally:
                self._fs.delete(self._path(draft), False)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        how = self.spark._sc._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        context = hadoop.FileContext.getFileContext(self._path(self.root).toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._path(draft), self._path(self._name(version)), how)
            return True
        except Exception as e:
            self._fs.delete(self._path(draft), False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    # ---- reading

    def bucket(self, *key: str) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, *key: str) -> list[int]:
        """The buckets of the keys of rows: no more numbers than there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(*key)).distinct().collect())

    def read(self, table: str, version: int | None = None, buckets: Sequence[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """A table as one version has it, or only some of its buckets; empty, with ``schema``, before its first commit."""
        found = self.manifest(self.latest() if version is None else version)["tables"].get(table)
        if found is None:
            if schema is None:
                raise KeyError(f"version {version} has no table {table}")
            return self.spark.createDataFrame([], schema)
        kind = T.StructType.fromJson(found["schema"])
        wanted = None if buckets is None else set(map(str, buckets))
        paths = [f"{self.root}/{p}" for b, own in sorted(found["files"].items()) if wanted is None or b in wanted for p in own]
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    # ---- writing

    def part(self, *key: str) -> Column:
        """Finer parts than buckets, each within one: rows dealt by them can be grouped by key, and needn't be dealt again to be staged."""
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets * max(1, 512 // self.buckets))).cast("int")

    def stage(self, table: str, rows: DataFrame, *key: str) -> Staged:
        """Writes rows by bucket of their key; a commit makes them part of a version. Rows that were dealt by ``part``, as a column ``__part``, stay where they are."""
        folder = f"data/{uuid.uuid4().hex}/{table}"
        path = f"{self.root}/{folder}"
        dealt, rows = "__part" in rows.columns, rows.drop("__part")
        own = rows.withColumn("__bucket", self.bucket(*key))
        (own if dealt else own.hint("rebalance", "__bucket")).write.partitionBy("__bucket").parquet(path)
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(path)) if f.isDirectory()]
        written = {int(n.partition("=")[2]): f"{folder}/{n}" for n in names if n.startswith("__bucket=")}
        frame = self.spark.read.schema(rows.schema).parquet(*[f"{self.root}/{p}" for p in written.values()]) if written else self.spark.createDataFrame([], rows.schema)
        return Staged(table, key, rows.schema, folder, written, frame)

    def commit(self, staged: Sequence[Staged], based_on: int, relied_on: dict[str, Iterable[int]] | None = None, note: dict | None = None) -> int:
        """Publishes staged rows as one version and returns its number.

        ``based_on`` is the version that the writer read, ``relied_on`` the buckets of each table that
        its rows depend on (those that it replaces always count). Raises Conflict if a later version wrote to one.
        """
        relied = {t: set(b) for t, b in (relied_on or {}).items()}
        for s in staged:
            relied.setdefault(s.table, set()).update(s.replaces or ())
        wrote = {}
        for s in staged:
            wrote[s.table] = sorted({*wrote.get(s.table, ()), *s.written, *(s.replaces or ())})
        base, seen = self.latest(), based_on
        while True:
            for v in range(seen + 1, base + 1):
                for table, buckets in self.manifest(v)["wrote"].items():
                    if relied.get(table, set()) & set(buckets):
                        self.forget(staged)
                        raise Conflict(f"version {v} changed {table} where this writer, based on {based_on}, relied on it")
            manifest = self.manifest(base)
            for s in staged:
                own = manifest["tables"].setdefault(s.table, {"key": list(s.key), "files": {}})
                own["schema"] = s.schema.jsonValue()
                for b in s.replaces or ():
                    own["files"].pop(str(b), None)
                for b, path in s.written.items():
                    own["files"].setdefault(str(b), []).append(path)
            manifest |= {"version": base + 1, "buckets": self.buckets, "wrote": wrote, "note": note or {}, "at": time.time()}
            if self._published(base + 1, manifest):
                return base + 1
            seen, base = base, self.latest()

    def forget(self, staged: Sequence[Staged]) -> None:
        """Removes what was staged."""
        for s in staged:
            self._fs.delete(self._path(f"{self.root}/{s.folder}"), True)

    def rewrite(self, table: str, new: DataFrame, key: str, change: Callable[[DataFrame], DataFrame], schema: T.StructType | None = None, note: dict | None = None) -> int:
        """One version in which the buckets of the keys of ``new`` hold what ``change`` makes of them; others aren't read."""
        version = self.latest()
        touched = self.buckets_of(new, key)
        staged = self.stage(table, change(self.read(table, version, touched, schema or new.schema)), key).replacing(touched)
        return self.commit([staged], version, note=note)

    def compact(self, table: str, most: int = 8, make: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
        """One version in which the buckets of more than so many folders are one folder each; ``make`` may settle their rows."""
        version = self.latest()
        own = self.manifest(version)["tables"][table]
        crowded = [int(b) for b, paths in own["files"].items() if len(paths) > most]
        if not crowded:
            return version
        staged = self.stage(table, make(self.read(table, version, crowded)), *own["key"]).replacing(crowded)
        return self.commit([staged], version)

    def vacuum(self, keep: int = 2, older_than: float = 86_400.0) -> int:
        """Removes folders that none of the last ``keep`` versions names, and older manifests; folders younger than so many seconds may be a writer's and stay."""
        last = self.latest()
        kept = range(max(1, last - keep + 1), last + 1)
        named = {p.rpartition("/")[0] for v in kept for t in self.manifest(v)["tables"].values() for own in t["files"].values() for p in own}
        removed = 0
        data = self._path(f"{self.root}/data")
        for batch in self._fs.listStatus(data) if self._fs.exists(data) else []:
            for table in self._fs.listStatus(batch.getPath()):
                folder = f"data/{batch.getPath().getName()}/{table.getPath().getName()}"
                if folder not in named and time.time() - table.getModificationTime() / 1000 >= older_than:
                    self._fs.delete(table.getPath(), True)
                    removed += 1
        for f in self._fs.listStatus(self._path(f"{self.root}/versions")):
            name = f.getPath().getName()
            if name[0].isdigit() and int(name[:-5]) not in kept:
                self._fs.delete(f.getPath(), False)
        return removed


def upsert(versions: Versions, table: str, new: DataFrame, key: str, owned: list[str], version: str, schema: T.StructType | None = None) -> int:
    """Commits an upsert of owned columns; see ``relational.upserted``."""
    return versions.rewrite(table, new, key, lambda old: relational.upserted(old, new, key, owned, version), schema)


def supersede(versions: Versions, table: str, new: DataFrame, key: str) -> int:
    """Commits a soft delete: rows whose key comes anew stay, but aren't current."""
    schema = T.StructType([*new.schema.fields, T.StructField("is_current", T.IntegerType())])
    return versions.rewrite(table, new, key, lambda old: relational.superseded(old, new, key), schema)


def replace_children(versions: Versions, table: str, new: DataFrame, parent: str) -> int:
    """Commits the children of the parents that come, in place of those that were there."""
    return versions.rewrite(table, new, parent, lambda old: relational.replaced(old, new, parent))
