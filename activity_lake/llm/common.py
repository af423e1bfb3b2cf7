"""Helpers of the operators: rows by table, written cuts, bucket counts, packed arrays."""

from __future__ import annotations

import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows with whole texts that an executor and its Python worker pass at a time; Spark's default is ten times as many.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Let the session read rows and pass them on to Python in batches that suit whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", BATCH_ROWS // 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared").rstrip("/")


def cut(df: DataFrame, purpose: str, packed: bool = False) -> DataFrame:
    """Write the rows as Parquet in the shared folder and read them back: computed once, no lineage behind it.

    Then nothing needs the shuffle files of the step any more. Spark removes them when the driver's JVM finds that out in a
    garbage collection, which is asked for here: the disks hold one step at a time. Packed blocks are compressed already and
    long; another codec and long pages would only take memory.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    writer = df.write.option("parquet.page.size.row.check.min", 1)
    (writer.option("compression", "uncompressed") if packed else writer).parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, base: str) -> str:
    """A column name that the table doesn't have yet (names compare without case)."""
    taken = {column.lower() for column in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def power_of_two(rows: int, per_bucket: int, least: int = 16) -> int:
    """The number of buckets, a power of two, that keeps about ``per_bucket`` of the rows in each."""
    buckets = least
    while buckets * per_bucket < rows:
        buckets *= 2
    return buckets


def text_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a column over the whole table."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0)).alias("n")).first()["n"]


#: A key is hot that holds more than this share of the rows; there can't be more hot keys than its inverse.
HOT_SHARE = 1_000


def join_spread(rows: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of rows to a lookup of one row a key, where a few keys may hold much of the rows.

    Rows of hot keys are dealt to as many parts as keep each below a thousandth of all rows, and the lookup's rows of these
    keys are repeated for the parts. At most a thousand keys can be hot: they are sent to all tasks, and the lookup grows by
    two thousand rows at most. Both tables are read twice, so they should be written ones. Null keys meet nothing.
    """
    total, parts, salt = rows.count(), unused(rows, "parts_"), unused(rows, "salt_")
    hot = F.broadcast(rows.groupBy(*keys).agg(F.ceil(F.count("*") * HOT_SHARE / F.lit(max(total, 1))).cast("int").alias(parts))
                      .filter(F.col(parts) > 1))
    rest = [c for c in rows.columns if c not in keys]
    dealt = rows.join(hot, keys, "left").withColumn(
        salt, F.when(F.col(parts).isNull(), 0).otherwise(F.pmod(F.xxhash64(*rest) if rest else F.spark_partition_id(), F.col(parts))).cast("int")).drop(parts)
    repeated = lookup.join(hot, keys, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))).drop(parts)
    return dealt.join(repeated, [*keys, salt], "left").drop(salt)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length in one compressed block; each column is laid out byte plane by byte plane."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(len(arrays[0]).to_bytes(8, "little") + b"".join(planes))


def unpack(block: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    rows, at, found = int.from_bytes(raw[:8], "little"), 8, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, rows * size, at).reshape(size, rows)
        found.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += rows * size
    return found


def unpack_all(blocks: list[bytes], *kinds: str) -> list[np.ndarray]:
    """The arrays of several blocks, joined."""
    parts = [unpack(block, *kinds) for block in blocks]
    return [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, kind) for i, kind in enumerate(kinds)]
