"""Places for intermediate results that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that setting is missing, a folder of our own on one machine (tests), and an error on a
    cluster, whose machines don't share such a folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
        if not folder:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
            folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folders: str | None = None) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: lineage ends there. ``folders``: a column of few values, each with a folder of its own."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(folders) if folders else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of ids that may be broadcast, after they have been counted.
BROADCAST_IDS = 400_000


def checked(ids: DataFrame, name: str = "ids", limit: int = BROADCAST_IDS) -> DataFrame:
    """A narrow frame of ids, written and counted: to be broadcast if it has at most ``limit`` rows, else hash-joined."""
    kept = written(ids, name)
    return F.broadcast(kept) if kept.count() <= limit else kept.hint("shuffle_hash")


def bitmap_of(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Packed bitmap (2**bits bits, whatever the input) of the hashes of a column; null values set nothing."""
    held = df.where(F.col(column).isNotNull()).select(F.shiftrightunsigned(F.xxhash64(column), 64 - bits).cast("int").alias("at")).distinct()
    packed = held.groupBy(F.shiftright("at", 12).alias("block")).agg(F.collect_set(F.expr("at & 4095")).alias("spots"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for block, spots in packed.toLocalIterator(prefetchPartitions=True):
        part = np.zeros(4096, np.uint8)
        part[spots] = 1
        out[block << 9 : (block + 1) << 9] = np.packbits(part, bitorder="little")
    return out


def in_bitmap(column: str, bits: int) -> F.Column:
    """Where a value's bit stands in ``bitmap_of``'s map."""
    return F.shiftrightunsigned(F.xxhash64(column), 64 - bits).cast("int")


def look_up(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
