"""Versions of a set of tables, and the ledger of the extracts loaded into them.

Layout under a root, Parquet but for the manifests::

    <table>/load_id=<load>/part-…                                     a table that each load replaces
    <table>/load_id=<load>/extract_id=<extract>/<unit>=<value>/part-…  a table loaded extract by extract
    _manifests/<number>.json                                          what makes up each version

A load writes folders of its own and never touches older ones. What it wrote can be read and checked next to
what stays. Then one small file, the next manifest, names the folders of *all* tables, and with it the load is
in: readers that take the newest manifest see every table of one version, whatever happens between two steps.
No data is ever renamed or copied, so this holds on object stores too.

The manifest is also the ledger. An extract is what its sender calls one delivery (a file, a half month, a
resent quarter): its rows carry its id, and loading it again replaces exactly its own rows, whatever months
they lie in and whatever other extracts hold of the same months.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable, Sequence
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRACT, LOAD = "extract_id", "load_id"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path as its own object."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making, on whatever file system holds it."""
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


class ConcurrentLoad(RuntimeError):
    """Another load was published since this one began; begin it again on what is there now."""


class Store:
    """Tables under one root, read by version.

    ``tables`` gives the stored columns of each table. Tables named in ``units`` are loaded by extract and
    stored by extract and by that column (an int, part of the frames that are loaded), ordered by ``sort``.
    ``rules`` puts column rules into what is written (frame, table name); rows that break them fail the write.
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, T.StructType],
                 units: dict[str, str] | None = None, sort: dict[str, Sequence[str]] | None = None,
                 rules: Callable[[DataFrame, str], DataFrame] = lambda df, name: df):
        self.spark, self.root, self.tables, self.rules = spark, root.rstrip("/"), tables, rules
        self.units, self.sort = units or {}, sort or {}

    # ------------------------------------------------------------------ versions
    def _numbers(self) -> list[int]:
        found = (n.removesuffix(".json") for n in _names(self.spark, f"{self.root}/_manifests"))
        return sorted((int(n) for n in found if n.isdigit()), reverse=True)

    def _manifest(self, number: int) -> dict | None:
        """A manifest, or None where its writer was stopped half way."""
        fs, where = filesystem(self.spark, f"{self.root}/_manifests/{number:09d}.json")
        stream = fs.open(where)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def versions(self) -> list[int]:
        """Whole versions, the newest first."""
        return [n for n in self._numbers() if self._manifest(n) is not None]

    def current(self) -> dict:
        """The newest whole manifest; version 0 with no rows where nothing was published."""
        for number in self._numbers():
            found = self._manifest(number)
            if found is not None:
                return found
        return {"version": 0, "tables": {}}

    def _put(self, manifest: dict) -> None:
        fs, where = filesystem(self.spark, f"{self.root}/_manifests/{manifest['version']:09d}.json")
        try:
            out = fs.create(where, False)   # fails where another load has taken the number
        except Exception as taken:
            if fs.exists(where):
                raise ConcurrentLoad(f"version {manifest['version']} of {self.root} is taken") from taken
            raise
        out.write(bytearray(json.dumps(manifest, indent=1).encode()))
        out.close()

    # ------------------------------------------------------------------ reading
    def stored(self, name: str) -> T.StructType:
        """Columns of a table as it is read."""
        extra = [T.StructField(EXTRACT, T.StringType()), T.StructField(self.units[name], T.IntegerType())] if name in self.units else []
        return T.StructType(self.tables[name].fields + extra)

    def folder(self, name: str, part: dict) -> str:
        base = f"{self.root}/{name}/{LOAD}={part['load']}"
        if name not in self.units:
            return base
        escaped = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(part["extract"])
        return f"{base}/{EXTRACT}={escaped}"

    def read(self, name: str, manifest: dict | None = None) -> DataFrame:
        """A table of the newest version (or of the given one)."""
        parts = [p for p in (manifest or self.current())["tables"].get(name, []) if p["rows"]]
        schema = self.stored(name)
        if not parts:
            return self.spark.createDataFrame([], schema)
        # With all columns given, no file is opened for its schema. The folders are partitions below one base.
        whole = T.StructType([T.StructField(LOAD, T.StringType()), *schema.fields])
        return (self.spark.read.schema(whole).option("basePath", f"{self.root}/{name}")
                .parquet(*[self.folder(name, p) for p in parts]).select(*schema.names))

    def read_all(self, manifest: dict | None = None) -> dict[str, DataFrame]:
        """Every table, all of one version."""
        manifest = manifest or self.current()
        return {name: self.read(name, manifest) for name in self.tables}

    def ledger(self) -> DataFrame:
        """What is in: table, extract_id (null for whole tables), load_id, rows, and the version."""
        now = self.current()
        rows = [(name, p["extract"], p["load"], p["rows"], now["version"]) for name, parts in now["tables"].items() for p in parts]
        return self.spark.createDataFrame(rows, f"table_name string, {EXTRACT} string, {LOAD} string, rows long, version long")

    # ------------------------------------------------------------------ writing
    def begin(self) -> Draft:
        return Draft(self)

    def rollback(self, version: int) -> None:
        """Publish an earlier version, if it is still kept, as the newest one."""
        old = self._manifest(version) if version in self._numbers() else None
        if old is None:
            raise ValueError(f"version {version} of {self.root} is not kept")
        self._put(old | {"version": self._numbers()[0] + 1})

    def expire(self, keep: int = 2) -> None:
        """Forget all but the newest versions and remove folders that none of them names.

        The default keeps the version before the newest for readers that began on it. Manifests go first, so
        a stop in between leaves only folders that the next call removes. Loads under way are left alone: a
        load's id begins with the version it is to become, and only older ones can be left over.
        """
        kept = self.versions()[:max(1, keep)]
        if not kept:
            return
        used = {(name, p["load"]) for n in kept for name, parts in self._manifest(n)["tables"].items() for p in parts}
        for number in self._numbers():
            if number < kept[-1]:
                remove(self.spark, f"{self.root}/_manifests/{number:09d}.json")
        for name in self.tables:
            for folder in _names(self.spark, f"{self.root}/{name}"):
                load = folder.removeprefix(f"{LOAD}=")
                if load != folder and int(load.split("-")[0]) <= kept[0] and (name, load) not in used:
                    remove(self.spark, f"{self.root}/{name}/{folder}")


class Draft:
    """A load that is being written: in for nobody until ``publish``.

    As a context manager it publishes at the end, and after an error (a failed check) it removes what it
    wrote and leaves every table as it was.
    """

    def __init__(self, store: Store):
        self.store, self.base = store, store.current()
        self.manifest = copy.deepcopy(self.base)
        # Torn manifests hold their numbers.
        self.manifest["version"] = max([self.base["version"], *store._numbers()[:1]]) + 1
        self._written: list[str] = []

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, where: TracebackType | None) -> None:
        if kind is None:
            self.publish()
        else:
            self.discard()

    def _write(self, name: str, df: DataFrame) -> list[dict]:
        """Write the rows to a folder of this load; what it holds, by extract."""
        store, unit = self.store, self.store.units.get(name)
        load = f"{self.manifest['version']:09d}-{uuid.uuid4().hex[:8]}"
        path = f"{store.root}/{name}/{LOAD}={load}"
        self._written.append(path)
        rows = store.rules(df.select(*store.stored(name).names), name)
        order = [*([EXTRACT, unit] if unit else []), *store.sort.get(name, ())]
        if order:
            rows = rows.sortWithinPartitions(*order)
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(EXTRACT, unit) if unit else writer).parquet(path)
        back = store.spark.read.schema(store.stored(name)).parquet(path)
        if not unit:
            return [{"extract": None, "load": load, "rows": back.count()}]
        # From file footers and folder names: one row per extract and unit.
        found: dict[str, dict] = {}
        for r in back.groupBy(EXTRACT, unit).agg(F.count("*").alias("n")).collect():
            if r[0] is None:
                raise ValueError(f"{name}: rows without {EXTRACT}")
            part = found.setdefault(r[0], {"extract": r[0], "load": load, "rows": 0, "units": {}})
            part["rows"] += r["n"]
            part["units"][str(r[1])] = r["n"]
        return [found[e] for e in sorted(found)]

    def replace(self, name: str, df: DataFrame) -> None:
        """The table is ``df`` from this version on."""
        self.manifest["tables"][name] = self._write(name, df)

    def load(self, name: str, df: DataFrame, extracts: Sequence[str] = (), may_shrink: bool = True) -> None:
        """The extracts in ``df`` (column ``extract_id``) replace their earlier loads; all others stay.

        ``extracts`` names extracts that count as loaded though no row of them is left. Without ``may_shrink``
        an extract that comes with fewer rows of a unit than are in is an error: for units that no sender
        has named, where fewer rows may mean that another delivery held the rest.
        """
        new = self._write(name, df)
        new += [{"extract": e, "load": new[0]["load"] if new else "", "rows": 0, "units": {}} for e in extracts if e not in {p["extract"] for p in new}]
        if any("None" in p["units"] for p in new):
            raise ValueError(f"{name}: rows without {self.store.units[name]}")
        old = {p["extract"]: p for p in self.manifest["tables"].get(name, [])}
        if not may_shrink:
            for p in new:
                for unit, n in old.get(p["extract"], {"units": {}})["units"].items():
                    if p["units"].get(unit, 0) < n:
                        raise ValueError(f"{name}: the load holds {p['units'].get(unit, 0)} rows of {unit}, {n} are in; name its extract")
        merged = old | {p["extract"]: p for p in new}
        self.manifest["tables"][name] = [merged[e] for e in sorted(merged)]

    def read(self, name: str) -> DataFrame:
        """A table as it will be, for checks before it is."""
        return self.store.read(name, self.manifest)

    def read_all(self) -> dict[str, DataFrame]:
        return self.store.read_all(self.manifest)

    def publish(self) -> int:
        if self.store.current()["version"] != self.base["version"]:
            self.discard()
            raise ConcurrentLoad(f"{self.store.root} has a version newer than {self.base['version']}")
        self.store._put(self.manifest)
        return self.manifest["version"]

    def discard(self) -> None:
        for path in self._written:
            remove(self.store.spark, path)
        self._written = []
