"""Helpers shared by the operators of this package."""
from __future__ import annotations

import gc
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ensure_checkpoint_dir

#: Rows per Arrow batch: with 100 kB texts a batch stays near 50 MB.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Settings the Python stages rely on: small Arrow batches and a shared checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of ended queries now.  It acts on what the driver no longer holds, hence the
    collections; results do not depend on it, only the disk in use does.  (The setting that removes them at a query's end
    was tried: it did not lower the disk in use on executors.)"""
    gc.collect()
    spark._jvm.System.gc()


def materialise(df: DataFrame, name: str, bucket: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Later plans start from the files: a lost executor rereads them instead of
    running the upstream plan again.  With ``bucket`` the files are bucketed by
    that column, and joins and groups by it leave the table where it is.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{run}"
    if bucket:
        known = f"{name.replace('-', '_')}_{run}"
        df.write.bucketBy(shuffle_parts(spark), bucket).option("path", path).saveAsTable(known)
        out = spark.table(known)
    else:
        df.write.parquet(path)
        known, out = None, spark.read.schema(df.schema).parquet(path)
    out._stage_path, out._stage_table = path, known
    return out


def discard(df: DataFrame) -> None:
    """Delete a table written by ``materialise`` that nothing reads any more."""
    spark = df.sparkSession
    if df._stage_table:
        spark.sql(f"DROP TABLE IF EXISTS {df._stage_table}")
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def fold(doc_id: int | None, parts: int) -> int:
    """crc32 of the id's decimal text, modulo ``parts`` (null id: crc32 of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def fold_column(column: str, parts: int):
    """The same as ``fold``, as a Column."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def shuffle_parts(spark: SparkSession) -> int:
    """Number of partitions that hand-partitioned tables are dealt to: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input never clash with new ones."""
    return df.select(*[F.col(f"`{n}`") for n in names])


# --- packed arrays in binary columns -------------------------------------------------

def pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(x)), kind)


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted unsigned numbers by their steps."""
    steps = np.diff(x, prepend=np.uint64(0))
    return b"4" + pack(steps.astype(np.uint32)) if len(steps) and steps.max() < 2**32 else b"8" + pack(steps)


def unpack_sorted(x: bytes) -> np.ndarray:
    x = bytes(x)
    return np.cumsum(unpack(x[1:], np.uint32 if x[:1] == b"4" else np.uint64), dtype=np.uint64)


def pack_planes(x: np.ndarray) -> bytes:
    """Counts by byte planes, of which the high ones compress to nothing."""
    kind = "<u4" if not len(x) or x.max() < 2**32 else "<u8"
    return kind[-1:].encode() + pack(x.astype(kind).view(np.uint8).reshape(len(x), int(kind[-1])).T)


def unpack_planes(x: bytes) -> np.ndarray:
    x = bytes(x)
    width = int(x[:1])
    planes = unpack(x[1:], np.uint8)
    return np.ascontiguousarray(planes.reshape(width, len(planes) // width).T).view(f"<u{width}").ravel().astype(np.int64)


def runs(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, end) of the runs of an array sorted by value."""
    cut = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(part[a]), int(a), int(b)) for a, b in zip(cut, [*cut[1:], len(part)])]
