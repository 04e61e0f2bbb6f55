"""Versioned Parquet tables in the shared folder.

Parquet has no MERGE, so every layer write produces a new version directory
and the store points at it only after Spark's commit protocol finished the
write.  A path that is being read is never overwritten, so a failed or
retried job leaves the previous version intact (executors may be lost at any
time; the write is redone by task retry or by rerunning the step).

Large tables are kept in parts, one folder per value of a partition column (a
month).  A version of such a table is a list of parts; writing a new version
rewrites the touched parts only (copy on write) and names the old folders of
all others.  The list carries each part's row count and key range, so a merge
skips parts that cannot hold its keys, and values that hold for a whole version
(``loaded_at`` of a table that is loaded anew in every run) are kept there
once: a null in the files stands for them.

A pipeline run becomes visible to later processes only when
:meth:`LayerStore.commit` publishes its versions in the run manifest (one small
file per run, which one writer alone can create).  A run that dies half way
leaves unreferenced directories behind, never a half-updated warehouse; version
directories carry a per-process token so a retry never collides with them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidewater.session import shared_root
from tidewater.sources.commits import Conflict, publish

MANIFEST = "manifest"
MANIFEST_SCHEMA = ("run int, table_name string, version int, path string, rows long, "
                   "max_key long, marks string, committed_at string")


#: One row per part, and one (part and folder null) for the version itself.
PART_SCHEMA = ("part int, folder string, rows long, min_key long, max_key long, latest string, "
               "made_from string, schema string, constants string, state string")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder name of a null
CODEC = "zstd"  # of the files, whatever the session's default


@dataclass
class Part:
    folder: str
    rows: int
    min_key: int | None
    max_key: int | None
    latest: str | None
    made_from: str | None = None


@dataclass
class Parts:
    """A version of a table that is kept in parts."""
    column: str
    schema: StructType
    parts: dict[int | None, Part] = field(default_factory=dict)
    constants: dict[str, str] = field(default_factory=dict)
    state: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts.values())

    @property
    def latest(self) -> str | None:
        return max((p.latest for p in self.parts.values() if p.latest is not None), default=None)

    def holding(self, low: int | None, high: int | None) -> set:
        """Parts whose key range meets [low, high]."""
        if low is None or high is None:
            return set()
        return {m for m, p in self.parts.items()
                if p.max_key is None or (p.max_key >= low and p.min_key <= high)}


class LayerStore:
    """Named tables, each a sequence of immutable Parquet versions."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{shared_root(spark)}/tidewater-{uuid.uuid4().hex[:12]}").rstrip("/")
        self.token = uuid.uuid4().hex[:8]
        self.versions: dict[str, int] = {}
        self.paths: dict[tuple[str, int], str] = {}
        self._parts: dict[tuple[str, int], Parts | None] = {}

    def path(self, name: str, version: int | None = None) -> str:
        v = self.versions[name] if version is None else version
        return self.paths[(name, v)]

    def has(self, name: str) -> bool:
        return name in self.versions

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` as the next version of ``name``; return the new table."""
        version = self.versions.get(name, 0) + 1
        path = f"{self.root}/{name}/v{version:04d}-{self.token}"
        writer = df.write.mode("errorifexists").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        self.paths[(name, version)] = path
        self.versions[name] = version
        return self.read(name)

    def read(self, name: str, version: int | None = None, only: Iterable | None = None,
             raw: bool = False) -> DataFrame:
        """A version; of a table in parts ``only`` these, and with ``raw`` the
        files' own values, without those that hold for the whole version."""
        parts = self.parts(name, version)
        if parts is None:
            return self.spark.read.parquet(self.path(name, version))
        keep = parts.parts.keys() if only is None else parts.parts.keys() & set(only)
        column = parts.column
        schema = StructType.fromJson(parts.schema.jsonValue()).add(column, IntegerType())
        if not keep:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{name}"
        paths = [f"{base}/{parts.parts[m].folder}/{column}={NO_VALUE if m is None else m}"
                 for m in sorted(keep, key=lambda m: (m is not None, m))]
        df = self.spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("v")
        if parts.constants and not raw:
            df = df.select(*[F.coalesce(F.col(f.name), F.lit(parts.constants[f.name]).cast(f.dataType)).alias(f.name)
                             if f.name in parts.constants else F.col(f.name) for f in df.schema.fields])
        return df

    # ------------------------------------------------------------ tables in parts
    def parts(self, name: str, version: int | None = None) -> Parts | None:
        """The parts of a version; None for a table that is written whole."""
        key = (name, self.versions.get(name) if version is None else version)
        if key not in self._parts:
            path = self.paths.get(key)
            self._parts[key] = self._load_parts(path) if path and f"/{name}-parts/" in path else None
        return self._parts[key]

    def _load_parts(self, path: str) -> Parts:
        """Read a list of parts (one row per value of the partition column)."""
        out = None
        rows = self.spark.read.schema(PART_SCHEMA).parquet(path).collect()
        for r in rows:
            if r["schema"] is not None:
                state = json.loads(r["state"])
                out = Parts(state.pop("column"), StructType.fromJson(json.loads(r["schema"])),
                            constants=json.loads(r["constants"]), state=state)
        for r in rows:
            if r["schema"] is None:
                out.parts[r["part"]] = Part(r["folder"], r["rows"], r["min_key"], r["max_key"], r["latest"],
                                            r["made_from"])
        return out

    def write_parts(self, name: str, df: DataFrame, column: str, touched: Iterable, key: str,
                    latest: str | None = None, constants: Mapping[str, str] | None = None,
                    made_from: Mapping | None = None, state: dict | None = None) -> Parts:
        """Write ``df``, the new rows of the ``touched`` parts, as the next
        version; all other parts keep their files."""
        before = self.parts(name) if self.has(name) else None
        touched = set(touched)
        version = self.versions.get(name, 0) + 1
        tag = f"{version:04d}-{self.token}"
        new = Parts(column, StructType([f for f in df.schema.fields if f.name != column]),
                    {m: p for m, p in (before.parts.items() if before else ()) if m not in touched},
                    dict(constants or {}), dict(state or {}))
        if touched:
            path = f"{self.root}/{name}/v={tag}"
            df.write.mode("errorifexists").option("compression", CODEC).partitionBy(column).parquet(path)
            # two columns of the rows just written; one row per part comes back
            written = self.spark.read.schema(StructType.fromJson(new.schema.jsonValue()).add(column, IntegerType()))
            for r in (written.parquet(path).groupBy(column).agg(
                    F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"),
                    (F.max(latest).cast("string") if latest else F.lit(None).cast("string")).alias("latest"))
                    .collect()):
                new.parts[r[column]] = Part(f"v={tag}", r["rows"], r["low"], r["high"], r["latest"],
                                            (made_from or {}).get(r[column]))
        entries = [(m, p.folder, p.rows, p.min_key, p.max_key, p.latest, p.made_from, None, None, None)
                   for m, p in new.parts.items()]
        entries.append((None, None, None, None, None, None, None, json.dumps(new.schema.jsonValue()),
                        json.dumps(new.constants), json.dumps({**new.state, "column": column})))
        listed = f"{self.root}/{name}-parts/v{tag}"
        self.spark.createDataFrame(entries, PART_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(listed)
        self.versions[name] = version
        self.paths[(name, version)] = listed
        self._parts[(name, version)] = new
        return new

    def read_or(self, name: str, empty: DataFrame) -> DataFrame:
        return self.read(name) if self.has(name) else empty

    # ------------------------------------------------------------ run manifest
    def commit(self, run: int, versions: dict[str, int], rows: dict[str, int],
               max_keys: dict[str, int], marks: dict, at: str, manifest: str = MANIFEST,
               name: str | None = None) -> None:
        """Publish table versions in one manifest file.

        ``name`` (by default that of the run) is free for one writer only: a
        second one gets :class:`Conflict` and has to start from the state that
        the first one left.
        """
        fields = [f.split(" ")[0] for f in MANIFEST_SCHEMA.split(", ")]
        lines = [json.dumps(dict(zip(fields, (run, t, v, self.paths[(t, v)], rows.get(t), max_keys.get(t),
                                              json.dumps(marks), at), strict=True)))
                 for t, v in sorted(versions.items())]
        name = name or f"run-{run:08d}"
        if not publish(self.spark, f"{self.root}/{manifest}/{name}.json", "\n".join(lines) + "\n"):
            raise Conflict(f"{name} was committed by another writer")

    def load_manifest(self, manifest: str = MANIFEST) -> list[dict]:
        """Committed runs (one row per table version; small metadata)."""
        try:
            df = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.root}/{manifest}")
            return [r.asDict() for r in df.orderBy("run", "version", "table_name").collect()]
        except Exception as exc:  # no manifest yet: an empty warehouse
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return []
            raise

    def restore(self, entries: list[dict]) -> None:
        for e in entries:
            self.paths[(e["table_name"], e["version"])] = e["path"]
            if e["version"] >= self.versions.get(e["table_name"], 0):
                self.versions[e["table_name"]] = e["version"]

