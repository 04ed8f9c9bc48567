"""Published tables: immutable data folders and numbered manifests.

    <root>/data/<write>/[key=value/...]part-*     never changed once written
    <root>/versions/00000007.json                 one manifest per version

A manifest names the segments (folders) that make up a version, with counts and
bounds per segment, the extract files they came from and the table's sidecar.
Data are written first, into a folder of their own; the version exists from the
moment its manifest is renamed to its number. So

* a write that fails, at any point, leaves the old version, with its own
  sidecar, as the latest one: table and sidecar are one document;
* a reader that took a version keeps reading the same files while newer ones
  are published;
* of two writers that start from one version, the second to publish gets
  :class:`Conflict` and has to start again from the new version.

A manifest is metadata: one entry per segment, and segments are per write and
partition value, never per row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.landing import union_all
from ..sources import fs


class Conflict(RuntimeError):
    """Another writer published first."""


@dataclass(frozen=True)
class Segment:
    """A folder of a published table. ``keys`` are its partition values."""

    path: str                         # relative to the table's root
    version: int                      # the version it came with
    kind: str = "data"
    keys: dict = field(default_factory=dict)
    stats: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    version: int
    segments: tuple[Segment, ...]
    sidecar: dict
    files: dict                       # extract file -> what is known of it

    def of(self, kind: str) -> list[Segment]:
        return [s for s in self.segments if s.kind == kind]


class Published:
    """A published table under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- manifests --------------------------------------------------------------

    def _path(self, version: int) -> str:
        return f"{self.root}/versions/{version:08d}.json"

    def versions(self) -> list[int]:
        folder = f"{self.root}/versions"
        if not fs.exists(self.spark, folder):
            return []
        return sorted(int(n[:-5]) for n, _ in fs.children(self.spark, folder)
                      if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version's manifest; the latest one's, or None where there is none,
        if no version is given."""
        if version is None:
            version = max(self.versions(), default=0)
            if not version:
                return None
        doc = json.loads(fs.read_text(self.spark, self._path(version)))
        return Manifest(doc["version"], tuple(Segment(**s) for s in doc["segments"]),
                        doc["sidecar"], doc["files"])

    def publish(self, base: Manifest | None, segments: Iterable[Segment], sidecar: dict,
                files: dict | None = None) -> Manifest:
        """Make the successor of ``base`` out of ``segments``: one rename."""
        new = Manifest((base.version if base else 0) + 1, tuple(segments), sidecar, files or {})
        temporary = f"{self.root}/versions/_{uuid.uuid4().hex}"
        fs.write_text(self.spark, temporary, json.dumps(asdict(new), ensure_ascii=False))
        try:
            fs.move_new(self.spark, temporary, self._path(new.version))
        except FileExistsError as e:
            fs.delete(self.spark, temporary)
            raise Conflict(f"{self.root}: version {new.version} was published meanwhile") from e
        return new

    # --- data -------------------------------------------------------------------

    def folder(self) -> str:
        """A new data folder, relative to the root."""
        return f"data/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, version: int, kind: str = "data",
              partition_by: Sequence[str] = ()) -> list[Segment]:
        """Write ``df`` to a folder of its own; its segments, one per partition
        value. Nothing refers to them until they are published."""
        folder = self.folder()
        writer = df.write.mode("error")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{folder}")
        return [Segment(path, version, kind, keys)
                for path, keys in self._leaves(folder, len(partition_by))]

    def _leaves(self, folder: str, depth: int, keys: dict | None = None):
        if not depth:
            yield folder, keys or {}
            return
        for name, _ in fs.children(self.spark, f"{self.root}/{folder}"):
            key, mark, value = name.partition("=")
            if mark:
                yield from self._leaves(f"{folder}/{name}", depth - 1,
                                        {**(keys or {}), unquote(key): unquote(value)})

    def read(self, segments: Iterable[Segment], schema: T.StructType,
             at: str | None = None) -> DataFrame:
        """The rows of segments: one scan per write. ``schema`` includes the
        partition columns, as strings; ``at`` names a column for the version a
        row came with."""
        writes: dict[tuple[str, int], list[Segment]] = {}
        for s in segments:
            writes.setdefault((s.path.split("/")[1], s.version), []).append(s)
        frames = []
        for (write, version), parts in sorted(writes.items(), key=lambda x: (x[0][1], x[0][0])):
            df = self.spark.read.schema(schema).option(
                "basePath", f"{self.root}/data/{write}").parquet(
                    *[f"{self.root}/{s.path}" for s in parts]).select(*schema.names)
            frames.append(df.withColumn(at, F.lit(version)) if at else df)
        if not frames:
            schema = T.StructType([*schema.fields, T.StructField(at, T.IntegerType())]) \
                if at else schema
            return self.spark.createDataFrame([], schema)
        return union_all(frames)

    def clean_up(self, keep: int = 1) -> list[str]:
        """Forget all but the last ``keep`` versions and delete the data folders
        that none of these names (left by older versions or by failed writes).
        Not to be run while a writer is between its data and its manifest."""
        versions = self.versions()
        for v in versions[:-keep]:
            fs.delete(self.spark, self._path(v))
        named = {s.path.split("/")[1] for v in versions[-keep:]
                 for s in self.manifest(v).segments}
        folder = f"{self.root}/data"
        gone = [n for n, _ in fs.children(self.spark, folder) if n not in named] \
            if fs.exists(self.spark, folder) else []
        for name in gone:
            fs.delete(self.spark, f"{folder}/{name}")
        return gone


def with_stats(segments: Iterable[Segment], stats: dict[tuple, dict],
               by: Sequence[str]) -> list[Segment]:
    """Segments with the stats found for their partition values."""
    return [replace(s, stats=stats.get(tuple(s.keys.get(k) for k in by), {})) for s in segments]
