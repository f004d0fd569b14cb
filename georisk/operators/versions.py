"""Tables and models published together: data first, then one manifest by rename.

A store is a folder.  Every write goes to a folder of its own
(``<table>/__version=<id>/``, with partition folders below) that no reader knows yet.
Publishing writes the next manifest, ``_versions/<number>.json``, under another
name and renames it; the rename fails if that number exists.  A manifest names
the folders that make up each table, so readers of the newest one see the whole
of a publication or nothing of it, whatever fails in between, and readers of an
older one are not disturbed.  Replacing partitions is the same step: the new
manifest keeps the folders of the other partitions.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFEST = re.compile(r"^(\d{12})\.json$")
VERSION_COLUMN = "__version"


class Conflict(RuntimeError):
    """Another writer has published the version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------ files
    def _at(self, sub: str):
        p = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}")
        return p, p.getFileSystem(self._conf)

    def _names(self, sub: str) -> list[str]:
        p, fs = self._at(sub)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return [int(m[1]) for m in map(_MANIFEST.match, self._names("_versions")) if m]

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of ``version``, by default the newest; None if nothing has been published."""
        if version is None:
            found = self.versions()
            if not found:
                return None
            version = found[-1]
        p, fs = self._at(f"_versions/{version:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _rename_new(self, source, target) -> None:
        """Rename that refuses an existing target."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        kind = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        context.rename(source, target, self._jvm.java.lang.reflect.Array.newInstance(kind, 0))

    # ------------------------------------------------------------ writing
    def stage(self, name: str, df: DataFrame, partition_by: str | None = None, options: dict | None = None) -> dict:
        """Write ``df`` where no reader looks; the result is an entry of a manifest."""
        folder = f"{name}/{VERSION_COLUMN}={uuid.uuid4().hex[:16]}"
        writer = df.write.mode("errorifexists").options(**(options or {}))
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.path}/{folder}")
        parts = {"": folder}
        if partition_by:
            parts = {x: f"{folder}/{x}" for x in self._names(folder) if x.startswith(f"{partition_by}=")}
        return {"schema": df.schema.jsonValue(), "partition_by": partition_by, "parts": parts}

    def stage_model(self, name: str, fitted) -> dict:
        folder = f"{name}/{VERSION_COLUMN}={uuid.uuid4().hex[:16]}"
        fitted.write().save(f"{self.path}/{folder}")
        return {"model": folder}

    def staged(self, name: str, entry: dict) -> DataFrame:
        """The rows of an entry, published or not."""
        schema, by = T.StructType.fromJson(entry["schema"]), entry["partition_by"]
        if not entry["parts"]:
            return self.spark.createDataFrame([], schema)
        held = T.StructType([*schema.fields, T.StructField(VERSION_COLUMN, T.StringType())])
        reader = self.spark.read.schema(held)
        if by:
            reader = reader.option("basePath", f"{self.path}/{name}")
        found = reader.parquet(*[f"{self.path}/{x}" for x in entry["parts"].values()])
        return found.select(*schema.names)

    def publish(self, entries: dict, meta: dict | None = None, base: int | None = None) -> int:
        """Make ``entries`` the version after ``base`` (default: the newest); Conflict if there is one already."""
        if base is None:
            base = (self.versions() or [0])[-1]
        version = base + 1
        text = json.dumps({"version": version, "entries": entries, "meta": meta or {}}, indent=1)
        target, fs = self._at(f"_versions/{version:012d}.json")
        source, _ = self._at(f"_versions/.{version:012d}-{uuid.uuid4().hex}")
        out = fs.create(source, False)
        try:
            out.write(bytearray(text.encode()))
            out.hsync()
        finally:
            out.close()
        try:
            self._rename_new(source, target)
        except Exception as e:  # a Java exception: what counts is whether the version is taken
            fs.delete(source, False)
            if fs.exists(target):
                raise Conflict(f"version {version} of {self.path} has been published by another writer") from e
            raise
        return version

    def replace(self, tables: dict | None = None, models: dict | None = None, meta: dict | None = None, check=None) -> int:
        """A new version of the whole store: ``tables`` (frames) and ``models`` by name.

        ``check(name, rows)`` sees each stored table before anything is published; what it raises
        leaves the store as it was.
        """
        base = (self.versions() or [0])[-1]
        entries = {name: self.stage(name, df) for name, df in (tables or {}).items()}
        if check:
            for name, entry in entries.items():
                check(name, self.staged(name, entry))
        entries |= {name: self.stage_model(name, fitted) for name, fitted in (models or {}).items()}
        return self.publish(entries, meta, base)

    def replace_partitions(self, df: DataFrame, partition_by: str, values=(), name: str = "data", check=None) -> int:
        """Replace the partitions that ``df`` has rows of and those named in ``values``, in one version.

        A named value without rows ends up empty.  If another writer comes
        first, the change is put on top of what that one has published.
        """
        entry = self.stage(name, df, partition_by)
        if check:
            check(name, self.staged(name, entry))
        named = [self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
            partition_by, None if v is None else str(v)) for v in values]
        while True:
            base = self.versions()
            now = self.manifest(base[-1]) if base else {"entries": {}, "meta": {}}
            old = now["entries"].get(name)
            if old and old["partition_by"] != partition_by:
                raise ValueError(f"{name} is partitioned by {old['partition_by']}")
            kept = {k: x for k, x in (old["parts"] if old else {}).items() if k not in named}
            entries = now["entries"] | {name: entry | {"parts": kept | entry["parts"]}}
            try:
                return self.publish(entries, now["meta"], base[-1] if base else 0)
            except Conflict:
                continue

    # ------------------------------------------------------------ reading
    def _entry(self, name: str, version: int | None) -> dict:
        found = self.manifest(version)
        if not found or name not in found["entries"]:
            raise FileNotFoundError(f"{self.path} holds no {name}")
        return found["entries"][name]

    def read(self, name: str = "data", version: int | None = None) -> DataFrame:
        return self.staged(name, self._entry(name, version))

    def load_model(self, name: str = "model", version: int | None = None):
        from pyspark.ml import PipelineModel
        return PipelineModel.load(f"{self.path}/{self._entry(name, version)['model']}")

    def meta(self, version: int | None = None) -> dict:
        return (self.manifest(version) or {"meta": {}})["meta"]

    def vacuum(self, keep: int = 2) -> int:
        """Delete manifests but the newest ``keep``, and data folders that these don't name; call it without writers."""
        versions = self.versions()
        used = set()
        for v in versions[-keep:]:
            for e in self.manifest(v)["entries"].values():
                used |= {"/".join(x.split("/")[:2]) for x in [*e.get("parts", {}).values(), *([e["model"]] if "model" in e else [])]}
        gone = [f"_versions/{v:012d}.json" for v in versions[:-keep]]
        for name in self._names(""):
            if not name.startswith(("_", ".")):
                gone += [f"{name}/{x}" for x in self._names(name) if x.startswith(f"{VERSION_COLUMN}=") and f"{name}/{x}" not in used]
        for sub in gone:
            p, fs = self._at(sub)
            fs.delete(p, True)
        return len(gone)
