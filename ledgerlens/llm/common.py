"""Helpers shared by the corpus operators: tables, shared storage, connected components, size-checked broadcast."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # rows of at most about 100 bytes: 20 MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where there is no cluster (tests), else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        jvm = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm.isDefined():
            return jvm.get()
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="ledgerlens-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the shared folder, which survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes to the shared folder and reads back: columnar, so that later passes prune columns."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcasts only below the bound on a counted number of rows of at most about 100 bytes (``hundreds`` for wider ones);
    beyond it Spark shuffles and splits skewed keys."""
    return F.broadcast(df) if rows <= bound else df


def hundreds(df: DataFrame, *texts: Column | str) -> int:
    """The size of df in rows of 100 bytes: its rows, and the bytes of the given texts over 100. A size for ``maybe_broadcast``."""
    size = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(0)) / 100
    return int(df.agg(F.sum(1 + size)).first()[0] or 0)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage that is no longer read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Batches of at most ``rows`` rows between Spark and Python, and of a quarter as many out of Parquet files, never more than
    the session allows already: texts of some kilobytes each need buffers of some megabytes then, and not of a hundred.

    Spark reads these settings when a plan is made or runs, so they hold for the session from here on; smaller batches change no result.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.parquet.columnarReaderBatchSize", max(1, rows // 4))):
        now = int(spark.conf.get(name))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def by_size(batch: pa.RecordBatch, column: str, rows: int = 2000, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``rows`` rows and about ``limit`` bytes of a text column, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = min(max(int(np.searchsorted(sizes, base + limit, "right")), at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def trim() -> None:
    """Gives the memory that a Python worker has freed back to the system: between tasks it idles beside the JVM and others."""
    pa.default_memory_pool().release_unused()
    if give := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        give(0)


def trimmed(run):
    """A pass over Arrow batches that ends with ``trim``."""

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return passes


def bit_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) edges: rows (node, root), root the smallest node reachable.

    Alternates large-star and small-star steps (each node's links move to its smallest neighbour), so that a group
    of any size needs a logarithmic number of rounds and no task holds a whole group: a step is one minimum by key
    and one join, both with map-side combining or skew splitting. Null ends are dropped; no edges give no rows.
    """
    links = cut(edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # large star: each larger neighbour of n points to n's minimum
        links = both.join(low, F.col("a") == F.col("n")).where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: n and its smaller neighbours point to the smallest of them
        low = links.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "n")
        moved = links.join(low, F.col("b") == F.col("n")).select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        links = cut(moved)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if tuple(now) == seen:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
        seen = tuple(now)
