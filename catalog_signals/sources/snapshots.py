"""Outputs of a run that appear together or not at all.

A run writes every output into a folder of its own, ``<folder>/runs/<run>/<output>``. What readers see is
named by the newest file in ``<folder>/_manifests``, which is put in place, whole, by one rename that does
not overwrite, once all outputs are written. A run that dies before leaves the readers the run before,
and of two runs that began from the same state the second one to end fails. ``vacuum`` removes what no
kept manifest names.

The rename is atomic in file systems with an atomic rename, such as HDFS and local ones; elsewhere a
reader still never sees a mixture, but two concurrent runs need to be kept apart by their scheduler.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFESTS = "_manifests"
_RUNS = "runs"


class ConcurrentRun(RuntimeError):
    """Another run has committed since this one began."""


@dataclass(frozen=True)
class Manifest:
    """``outputs`` and ``layers`` map names to a path below the folder, a format and a schema."""

    version: int = 0
    outputs: dict[str, dict] = field(default_factory=dict)
    layers: dict[str, dict] = field(default_factory=dict)

    def paths(self) -> Iterator[str]:
        return (entry["path"] for part in (self.outputs, self.layers) for entry in part.values())


class _Store:
    """The file system of a folder, whichever it is, by way of Hadoop."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self.system = self._fs.Path(folder).getFileSystem(self._conf)

    def path(self, *parts: str) -> JavaObject:
        return self._fs.Path("/".join((self.folder, *parts)))

    def listed(self, *parts: str) -> list[JavaObject]:
        path = self.path(*parts)
        return list(self.system.listStatus(path)) if self.system.exists(path) else []

    def text(self, *parts: str) -> str:
        stream = self.system.open(self.path(*parts))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, text: str, *parts: str) -> None:
        """Put a file in place as a whole; fails if there is one."""
        target = self.system.makeQualified(self.path(*parts))
        temporary = self.system.makeQualified(self.path(*parts[:-1], f".{uuid.uuid4().hex}"))
        stream = self.system.create(temporary, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._fs.FileContext.getFileContext(target.toUri(), self._conf)
        nothing = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        try:
            context.rename(temporary, target, nothing)
        except Py4JJavaError:
            self.system.delete(temporary, False)
            raise

    def delete(self, *parts: str) -> None:
        self.system.delete(self.path(*parts), True)


def _versions(store: _Store) -> list[int]:
    names = [status.getPath().getName() for status in store.listed(_MANIFESTS)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _manifest(store: _Store, version: int) -> Manifest:
    return Manifest(**json.loads(store.text(_MANIFESTS, f"{version:012d}.json")))


def latest(spark: SparkSession, folder: str) -> Manifest:
    """The newest committed state of the folder; version 0, of nothing, if there is none."""
    store = _Store(spark, folder)
    versions = _versions(store)
    return _manifest(store, versions[-1]) if versions else Manifest()


def open_entry(spark: SparkSession, folder: str, entry: dict) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    return spark.read.format(entry["format"]).schema(schema).load(f"{folder}/{entry['path']}")


def read_outputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All outputs of the newest committed state, as one run left them."""
    return {name: open_entry(spark, folder, entry) for name, entry in latest(spark, folder).outputs.items()}


class Snapshot:
    """A run that is being written; leaving the ``with`` block without an error commits it.

    Outputs that other runs wrote to the folder, and this one doesn't, stay as they are.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.run = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
        self.base = latest(spark, folder)
        self.outputs, self.layers = dict(self.base.outputs), dict(self.base.layers)

    def __enter__(self) -> Snapshot:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None:
            self.commit()

    def save(self, name: str, df: DataFrame, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> dict:
        """Write to this run's folder, and what a manifest says about it."""
        path = f"{_RUNS}/{self.run}/{name}"
        df.write.format(fmt).partitionBy(*partition_by).save(f"{self.folder}/{path}")
        return {"path": path, "format": fmt, "schema": json.loads(df.schema.json())}

    def write(self, name: str, df: DataFrame, fmt: str = "parquet") -> DataFrame:
        """Write an output and read it back, so that later steps start from files, not from lineage."""
        self.outputs[name] = self.save(name, df, fmt)
        return open_entry(self.spark, self.folder, self.outputs[name])

    def commit(self) -> Manifest:
        manifest = Manifest(self.base.version + 1, self.outputs, self.layers)
        text = json.dumps({"version": manifest.version, "outputs": self.outputs, "layers": self.layers})
        store = _Store(self.spark, self.folder)
        store.system.mkdirs(store.path(_MANIFESTS))
        try:
            store.put_new(text, _MANIFESTS, f"{manifest.version:012d}.json")
        except Py4JJavaError as problem:
            if manifest.version in _versions(store):
                raise ConcurrentRun(f"{self.folder} has a version {manifest.version} already") from problem
            raise
        return manifest


def vacuum(spark: SparkSession, folder: str, keep: int = 2, older_than_hours: float = 24) -> list[str]:
    """Remove runs that none of the newest ``keep`` manifests names, and older manifests; the runs removed.

    Runs touched within ``older_than_hours`` stay, as they may be running. Readers that began from a
    manifest which is no longer kept lose their files.
    """
    store = _Store(spark, folder)
    versions = _versions(store)
    kept = {path.split("/")[1] for v in versions[-max(keep, 1) :] for path in _manifest(store, v).paths()}
    limit = (time.time() - older_than_hours * 3600) * 1000
    for version in versions[: -max(keep, 1)]:
        store.delete(_MANIFESTS, f"{version:012d}.json")
    old = [
        status.getPath().getName() for status in store.listed(_RUNS)
        if status.getPath().getName() not in kept and status.getModificationTime() <= limit
    ]
    for run in old:
        store.delete(_RUNS, run)
    return old
