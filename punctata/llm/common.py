"""Helpers shared by the training-data operators: shared tables, byte batches, components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset: a temporary folder if driver and executors are one process, else a folder of the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext.getCheckpointDir()
    if not held:
        if not folder and re.match(r"local(\[|$)", spark.sparkContext.master):
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.sparkContext.setCheckpointDir(folder)
        held = spark.sparkContext.getCheckpointDir()
    return (folder or held).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back, which cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes what ``stored`` wrote for these frames; nothing that is still to run may read them."""
    for df in frames:
        if path := _PATHS.pop(df, None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These names, changed where a column of ``df`` has the same in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text without decoding; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def release() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks and stages, and would keep the most they ever held."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``made``, after which memory is released."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from made(frames)
        release()

    return run


def batches(frames: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``most`` bytes of text; one longer text stands alone."""
    for frame in frames:
        if not frame.num_rows:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(frame.column(text)), 0), dtype=np.int64)
        at = 0
        ends = np.cumsum(sizes)
        while at < frame.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield frame.slice(at, to - at)
            at = to
    release()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, component), component the least node.

    Alternating large-star and small-star rounds, until the edges are stars; each is written to the
    shared folder. Only nodes with an edge to another node are returned. Both steps reduce by ``min`` on
    either side before rows meet, and joins are plain equi-joins that AQE can split, so a hub needs no
    single task.
    """
    pairs = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    for _ in range(rounds):
        if _stars(pairs):
            break
        before = pairs
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).where(F.col("a") != F.col("b"))
        large = large.distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        pairs = stored(small, "edges")
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _stars(pairs: DataFrame) -> bool:
    """Whether each ``a`` of the edges has one ``b``, which is no ``a`` itself."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(pairs.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def running_start(parts: DataFrame, part: str, amount: str, start: str) -> DataFrame:
    """Exclusive running sum of ``amount`` in order of ``part``; one row for each task of a stage, so small."""
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(start, F.coalesce(F.sum(amount).over(w), F.lit(0).cast("long")))
