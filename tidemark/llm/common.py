"""Helpers shared by the operators: table reading, Arrow-batch mapping, shared scratch
tables and connected components over link tables."""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_root, hadoop_fs, scratch_path

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    The driver may only have it on its own ``sys.path``; the archive goes through the shared
    folder, so a replacement executor fetches it as well.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import io
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = f"{checkpoint_root(spark)}/tidemark-{uuid.uuid4().hex[:12]}.zip"
    fs, hpath = hadoop_fs(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(buffer.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers, which give back at a task's end what memory
    they no longer use (a worker lives on, beside the executor's heap, for the tasks after)."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Return freed memory of the Arrow pool and the C library's heap to the system."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):   # another C library: nothing to ask for
        pass


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage ends there, so
    a lost executor costs one re-read and no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows (a measured bound, for broadcasts)."""
    return df.limit(bound + 1).count() <= bound


def small_or_shuffled(df: DataFrame, bound: int) -> DataFrame:
    """``df`` marked for broadcast if it is measured to have at most ``bound`` rows, else as it is."""
    return F.broadcast(df) if row_count_at_most(df, bound) else df


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of an undirected link table ``(u, v)`` of longs.

    Returns ``(node, component)`` for every node of a link, ``component`` the smallest node that
    can be reached.  Alternates large-star and small-star steps; each step is one shuffle whose
    per-node part is a minimum (partial sums before the shuffle) joined back to the links, so a
    node with a third of all links is split by the skew join.  Links go to a shared table after
    each round; the driver sees a count and a checksum only.
    """
    edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u <> v").distinct(), purpose)
    state = None
    while True:
        # large star: every larger neighbour of u goes to the smallest node of u's neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = (both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .where("u <> v").distinct())
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(least.select("u", F.col("low").alias("v"))).distinct())
        edges = materialize(small, purpose)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = tuple(now)
