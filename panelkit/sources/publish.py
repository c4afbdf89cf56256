"""Writing that never loses the earlier table, and row counts from the write itself.

A table is written to a hidden folder beside its place, with a manifest (rows, columns,
partitioning), and published by renaming: the earlier table steps aside, the new one takes
its place, then the earlier one goes. Until the first rename readers see the earlier table
whole, whatever fails; a run that dies between the renames is mended by :func:`recover`,
which the next write or read of that path calls. Only Hadoop's file system calls are used, so
the path may lie in any store that renames.

The rows are counted by an ``Observation`` on the write, not by a second job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest.json"


class _Store:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def siblings(self, path: str, kind: str) -> list[str]:
        """Hidden folders of a path, the oldest first."""
        at = self.path(path)
        if at.getParent() is None or not self.fs.exists(at.getParent()):
            return []
        found = self.fs.globStatus(self.path(f"{at.getParent()}/.{at.getName()}.{kind}-*")) or []
        return [str(s.getPath()) for s in sorted(found, key=lambda s: s.getModificationTime())]

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _hidden(path: str, kind: str) -> str:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.{name}.{kind}-{uuid.uuid4().hex}" if head else f".{name}.{kind}-{uuid.uuid4().hex}"


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while an action runs over it: ``rows_of(observation)``."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def rows_of(seen: Observation) -> int:
    """The count of the action that has run; a plan that Spark knows to be empty has none."""
    return int(seen.get.get("n_rows") or 0)


def recover(spark: SparkSession, path: str) -> bool:
    """Put an earlier table back that a run left aside when it died between two renames."""
    store = _Store(spark, path)
    if store.exists(path):
        return False
    aside = store.siblings(path, "old")
    if not aside:
        return False
    store.rename(aside[-1], path)
    return True


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
            options: Mapping[str, str] | None = None, notes: Mapping[str, object] | None = None) -> int:
    """Write ``df`` in place of what ``path`` holds; the rows written. On any failure the
    earlier table stays (or comes back) and the new folder goes. ``notes`` join the manifest."""
    spark = df.sparkSession
    store = _Store(spark, path)
    recover(spark, path)
    path = path.rstrip("/")
    fresh, aside = _hidden(path, "new"), _hidden(path, "old")
    try:
        rows, seen = counted(df, "write")
        rows.write.options(**(options or {})).partitionBy(*partition_by).format(fmt).save(fresh)
        n = rows_of(seen)
        write_manifest(spark, fresh, {"rows": n, "format": fmt, "columns": df.columns,
                                      "partition_by": list(partition_by), **(notes or {})})
        earlier = store.exists(path)
        if earlier:
            store.rename(path, aside)
        try:
            store.rename(fresh, path)
        except Exception:
            if earlier:
                store.rename(aside, path)
            raise
    except Exception:
        store.delete(fresh)
        raise
    for old in store.siblings(path, "old"):
        store.delete(old)
    return n


def write_manifest(spark: SparkSession, path: str, notes: Mapping[str, object]) -> None:
    _Store(spark, path).write(f"{path.rstrip('/')}/{MANIFEST}", json.dumps(dict(notes)))


def drop_manifest(spark: SparkSession, path: str) -> None:
    """From here on nothing is said about what the path holds."""
    _Store(spark, path).delete(f"{path.rstrip('/')}/{MANIFEST}")


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What the last write of a path says about it; None for tables written otherwise."""
    store = _Store(spark, path)
    place = f"{path.rstrip('/')}/{MANIFEST}"
    return json.loads(store.read(place)) if store.exists(place) else None
