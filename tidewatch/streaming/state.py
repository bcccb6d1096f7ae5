"""Keyed state of a stream: a table of changes, one version per micro-batch.

A batch writes only the rows of the keys it changed.  A reader takes, per key, the
newest row of the last compacted version and of the versions after it; every
``compact_after`` versions these are folded into one table and the older files are
removed.  A batch that is run again sees the versions before it and replaces its
own, and versions are removed only once a later batch has begun, so a restart
never misses one.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPACT_AFTER = 16


class KeyedState:
    """State rows by ``keys``; ``schema`` names all columns.  All columns must be orderable (no maps)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str, compact_after: int = COMPACT_AFTER):
        self.spark, self.path, self.keys, self.compact_after = spark, path, keys, compact_after
        self.schema = T._parse_datatype_string(schema)
        self.cols = [f.name for f in self.schema.fields]

    def _versions(self, kind: str) -> list[int]:
        """Finished versions of a kind (``base`` or ``delta``), oldest first."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, kind))
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        done = [s.getPath() for s in fs.listStatus(folder) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def _folder(self, kind: str, version: int) -> str:
        return os.path.join(self.path, kind, str(version))

    def _remove(self, kind: str, version: int) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(kind, version))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _parts(self, version: int) -> tuple[int | None, list[int]]:
        base = max((v for v in self._versions("base") if v < version), default=None)
        return base, [v for v in self._versions("delta") if v < version and (base is None or v > base)]

    def before(self, version: int) -> DataFrame:
        """The newest row of every key over all versions before ``version``."""
        base, deltas = self._parts(version)
        if version > 0 and (deltas[-1] if deltas else base) != version - 1:
            raise FileNotFoundError(f"the state of batch {version - 1} does not exist under {self.path}")
        paths = [self._folder("delta", v) for v in deltas] + ([self._folder("base", base)] if base is not None else [])
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_v", T.LongType())])).parquet(*paths)
        if len(paths) == 1:
            return rows.drop("_v")
        rest = [c for c in self.cols if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max(F.struct("_v", *rest)).alias("_r"))
        return newest.select(*[F.col(k) if k in self.keys else F.col(f"_r.{k}").alias(k) for k in self.cols])

    def write(self, changed: DataFrame, version: int) -> DataFrame:
        """Store the changed rows as ``version`` and read them back."""
        folder = self._folder("delta", version)
        changed.select(*self.cols).withColumn("_v", F.lit(version).cast("long")).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(self.schema).parquet(folder)

    def compact(self, version: int) -> None:
        """Called as batch ``version`` begins: fold what is before it, if there are many versions."""
        base, deltas = self._parts(version)
        if len(deltas) < self.compact_after:
            return
        self.before(version).withColumn("_v", F.lit(version - 1).cast("long")).write.mode("overwrite").parquet(self._folder("base", version - 1))
        for v in [v for v in self._versions("delta") if v < version]:
            self._remove("delta", v)
        for v in [v for v in self._versions("base") if v < version - 1]:
            self._remove("base", v)

    def size(self) -> tuple[int, int]:
        """(versions kept, files kept)."""
        base, deltas = self._versions("base"), self._versions("delta")
        files = [self.spark.read.parquet(self._folder(k, v)).inputFiles() for k, vs in (("base", base), ("delta", deltas)) for v in vs]
        return len(base) + len(deltas), sum(map(len, files))
