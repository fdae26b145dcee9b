"""Tables as Parquet files under a log of numbered versions.

A version is a small file that names the files which make up the table, and those of the tables kept beside it (see
``operators/kept.py``), so that all change at once. A writer makes new files first and then publishes the next version by
renaming a finished file to its number, which fails if another writer has taken that number: nobody's rows are lost silently.
HDFS and local file systems rename at once; on object stores, which don't, and wherever a catalog has tables with row-level
changes, use ``CatalogTable``. Readers resolve the newest version once, and a file that is read is never written.

A change by key rewrites the files that hold one of the keys and no others: a key is in the table once, so n keys touch at most n
files. Versions also carry marks, a number or a date by name: which batch of each stream was taken last, and from which
day on pages may be new. Every version keeps all marks of the one before. Old versions, and files that none of the kept ones names, are
removed by ``vacuum``; many small files are made few by ``compact``."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files smaller than this are merged once there are more than so many of them.
SMALL_BYTES, MANY = 64 << 20, 32
#: Keys are broadcast while the files that they stand in have at most so many bytes.
BROADCAST_BYTES = 32 << 20

File = dict  # path (below the table), part, bytes


class ConcurrentCommit(RuntimeError):
    """Another writer has published the version that this one was to become."""


def tenant_part(tenant: str) -> str:
    """The name of a tenant's part."""
    return "t" + hashlib.sha256(tenant.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Side:
    """A table that is kept beside another one and changes with it."""

    files: list[File]
    schema: T.StructType

    def told(self) -> dict:
        return {"files": self.files, "schema": json.loads(self.schema.json())}


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


@dataclass(frozen=True)
class Snapshots:
    spark: SparkSession
    path: str

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), jvm.org.apache.hadoop.fs.Path

    def _listed(self, folder: str) -> list[tuple[str, int, int]]:
        """Names under a folder of the table, when they were last changed, in milliseconds, and their bytes."""
        fs, path = self._fs()
        at = path(f"{self.path}/{folder}" if folder else self.path)
        return [(s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in fs.listStatus(at)] if fs.exists(at) else []

    # ---- versions ----------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(name[:-5]) for name, _, _ in self._listed("_log") if name.endswith(".json"))

    def current(self) -> dict | None:
        """The newest version: ``version``, ``files``, ``schema``, ``sides``, ``marks``."""
        known = self.versions()
        return self._version(known[-1]) if known else None

    def _version(self, number: int) -> dict:
        fs, path = self._fs()
        stream = fs.open(path(f"{self.path}/_log/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self.versions())

    def schema_of(self, version: dict) -> T.StructType:
        return T.StructType.fromJson(version["schema"])

    def side_of(self, version: dict | None, name: str) -> Side | None:
        held = version["sides"].get(name) if version else None
        return Side(held["files"], T.StructType.fromJson(held["schema"])) if held else None

    # ---- reading -----------------------------------------------------------------------------------------------------

    def frame(self, files: list[File], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f['path']}" for f in files)) if files else self.spark.createDataFrame([], schema)

    def read(self, version: dict | None = None) -> DataFrame:
        """The table as of a version (default: the newest)."""
        now = version or self.current()
        if now is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self.frame(now["files"], self.schema_of(now))

    def read_or_empty(self, schema: T.StructType) -> DataFrame:
        return self.read() if self.exists() else self.spark.createDataFrame([], schema)

    def read_side(self, name: str, version: dict | None = None) -> DataFrame | None:
        side = self.side_of(version or self.current(), name)
        return self.frame(side.files, side.schema) if side else None

    def keys_of(self, files: list[File], schema: T.StructType, on: list[str]) -> DataFrame:
        """The columns ``on`` of some files, to be joined with; broadcast while the files are small."""
        keys = self.frame(files, schema).select(*on)
        return F.broadcast(keys) if sum(f["bytes"] for f in files) <= BROADCAST_BYTES else keys

    def holding(self, files: list[File], schema: T.StructType, keys: DataFrame, on: list[str]) -> list[File]:
        """Those of ``files`` that hold a row of ``keys``. Only the key columns are read, and within files only what the least and largest
        first key let in. What is collected is names of files, which the log has anyway."""
        if not on or len(files) < 2:
            return files if on else []  # one file is rewritten sooner than searched
        low, high = keys.agg(F.min(on[0]), F.max(on[0])).first()
        rows = self.frame(files, schema).select(*on, F.substring_index("_metadata.file_path", "/", -1).alias("_file"))
        kind = schema[on[0]].dataType
        if low is not None and not isinstance(kind, (T.TimestampType, T.BinaryType)):
            rows = rows.where(F.col(on[0]).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
        names = {r[0] for r in rows.join(keys, on, "left_semi").select("_file").distinct().collect()}
        return [f for f in files if f["path"].rsplit("/", 1)[-1] in names]

    # ---- writing -----------------------------------------------------------------------------------------------------

    def put(self, rows: DataFrame, part: str | None = None) -> list[File]:
        """``rows`` as new files, which no version names yet."""
        folder = f"v={uuid.uuid4().hex[:16]}"
        rows.write.parquet(f"{self.path}/{folder}")
        return [{"path": f"{folder}/{name}", "part": part, "bytes": size} for name, _, size in sorted(self._listed(folder)) if name.startswith("part-")]

    def remove(self, files: Iterable[File]) -> None:
        """Files that were put and that no version names."""
        fs, path = self._fs()
        for folder in {f["path"].split("/")[0] for f in files}:
            fs.delete(path(f"{self.path}/{folder}"), True)

    def survivors(self, touched: list[File], schema: T.StructType, keys: DataFrame, on: list[str]) -> list[File]:
        """The rows of ``touched`` files without those of ``keys``, as new files of the same parts."""
        out: list[File] = []
        for part in sorted({f["part"] for f in touched}, key=str):
            own = [f for f in touched if f["part"] == part]
            out += self.put(self.frame(own, schema).join(keys, on, "left_anti").select(*schema.names), part)
        return [f for f in out if f["bytes"]]

    def publish(self, base: dict | None, files: list[File], schema: T.StructType, sides: dict[str, Side] | None = None, marks: dict | None = None) -> int:
        """The version after ``base``, if nobody else has published one. Sides and marks that aren't given stay as they are."""
        version = (base["version"] if base else 0) + 1
        held = {**(base["sides"] if base else {}), **{n: s.told() for n, s in (sides or {}).items()}}
        told = {"version": version, "files": files, "schema": json.loads(nullable(schema).json()), "sides": held, "marks": {**(base["marks"] if base else {}), **(marks or {})}}
        fs, path = self._fs()
        new = path(f"{self.path}/_log/_next-{uuid.uuid4().hex}")
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps(told).encode()))
        stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsparkSession.sessionState().newHadoopConf())
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        to = path(f"{self.path}/_log/{version:012d}.json")
        try:
            context.rename(new, to, never)
        except Exception as error:
            fs.delete(new, False)
            if fs.exists(to):
                raise ConcurrentCommit(f"{self.path}: version {version} is another writer's") from error
            raise
        return version

    def create_if_missing(self, schema: T.StructType) -> None:
        if not self.exists():
            self.publish(None, [], schema)

    def changed(self, change: Callable[[dict | None], tuple[list[File], T.StructType]], base: dict | None = None, tries: int = 6) -> int:
        """Publishes what ``change`` makes of the newest version; where another writer was faster, of that writer's. With a ``base`` there is one try."""
        for left in range(tries - 1, -1, -1):
            now = base or self.current()
            try:
                return self.publish(now, *change(now))
            except ConcurrentCommit:
                if base is not None or not left:
                    raise
        raise AssertionError

    def commit(self, rows: DataFrame, append: bool = False, base: dict | None = None) -> int:
        """``rows`` beside what is there, or in place of it. ``base``: the version that they were made from; if it is no longer the newest,
        ``ConcurrentCommit``."""
        new = self.put(rows)
        return self.changed(lambda now: ([*(now["files"] if now and append else []), *new], self.schema_of(now) if now and append else rows.schema), base, 6 if append else 1)

    def upsert(self, rows: DataFrame, on: list[str]) -> int:
        """``rows``, one for each key, in place of those of the same keys."""
        new, schema = self.put(rows), nullable(rows.schema)

        def change(now: dict | None) -> tuple[list[File], T.StructType]:
            files, keys = now["files"] if now else [], self.keys_of(new, schema, on)
            touched = self.holding(files, schema, keys, on)
            return [*(f for f in files if f not in touched), *self.survivors(touched, schema, keys, on), *new], schema

        return self.changed(change)

    # ---- upkeep ------------------------------------------------------------------------------------------------------

    def _merged(self, files: list[File], schema: T.StructType) -> list[File]:
        """``files`` with the small ones of each part made few, where there are many; large ones stay."""
        small = [f for f in files if f["bytes"] < SMALL_BYTES]
        many = [p for p in {f["part"] for f in small} if sum(f["part"] == p for f in small) > MANY]
        gone = [f for f in small if f["part"] in many]
        made = [f for p in sorted(many, key=str) for f in self.put(self.frame([f for f in gone if f["part"] == p], schema).hint("rebalance"), p)]
        return [*(f for f in files if f not in gone), *made]

    def compact(self) -> bool:
        """Makes the small files of the table and of its sides few; a commit that comes between wins."""
        now = self.current()
        if now is None:
            return False
        files = self._merged(now["files"], self.schema_of(now))
        sides = {n: s for n in now["sides"] if (s := self.side_of(now, n)) is not None}
        sides = {n: Side(self._merged(s.files, s.schema), s.schema) for n, s in sides.items()}
        if files == now["files"] and all(s.files == now["sides"][n]["files"] for n, s in sides.items()):
            return False
        try:
            self.publish(now, files, self.schema_of(now), sides)
        except ConcurrentCommit:
            return False
        return True

    def vacuum(self, keep: int = 20, older_than_hours: float = 24) -> int:
        """Removes versions beyond the newest ``keep`` and folders that no kept version names, if they haven't changed for
        ``older_than_hours``, so that readers and writers at work lose nothing. Returns how many folders went."""
        known = self.versions()
        kept, (fs, path) = known[-keep:], self._fs()
        limit = self.spark._jvm.java.lang.System.currentTimeMillis() - int(older_than_hours * 3_600_000)
        young = {int(name[:-5]) for name, at, _ in self._listed("_log") if name.endswith(".json") and at > limit}
        stay = [v for v in known if v in kept or v in young]
        named = {f["path"].split("/")[0] for v in stay for x in [self._version(v)] for f in [*x["files"], *(f for s in x["sides"].values() for f in s["files"])]}
        gone = [name for name, at, _ in self._listed("") if name.startswith("v=") and at <= limit and name not in named]
        for name in gone:
            fs.delete(path(f"{self.path}/{name}"), True)
        for v in set(known) - set(stay):
            fs.delete(path(f"{self.path}/_log/{v:012d}.json"), False)
        return len(gone)

    def tend(self) -> None:
        """Upkeep after a change, by the usual bounds."""
        self.compact()
        self.vacuum()

    def drop(self) -> None:
        fs, path = self._fs()
        fs.delete(path(self.path), True)


@dataclass(frozen=True)
class CatalogTable:
    """A table of a catalog that has row-level changes itself: its own merge, append and overwrite."""

    spark: SparkSession
    name: str

    def upsert(self, rows: DataFrame, on: list[str]) -> None:
        same = None
        for c in on:
            equal = F.col(f"{self.name}.{c}") == F.col(f"_new.{c}")
            same = equal if same is None else same & equal
        rows.alias("_new").mergeInto(self.name, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()

    def append(self, rows: DataFrame) -> None:
        rows.writeTo(self.name).append()

    def replace(self, rows: DataFrame, tenant_column: str | None = None, tenant: str = "") -> None:
        rows.writeTo(self.name).overwrite(F.col(tenant_column) == tenant if tenant_column and tenant else F.lit(True))


def staging_path(root: str, dataset: str, run_id: str) -> str:
    """Where a run stages a dataset: its name and the first twelve digits of the run's id."""
    return f"{root}/{dataset}_{run_id.replace('-', '')[:12]}"


def stage(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` appended to a staging folder, and what is staged so far, read back: checks and promotion see the same rows."""
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
