"""Pieces that the operators of this package share.

Rows of a document table are identified by ``doc_id`` and the hash of their text, so that repeated ids, repeated rows
and null ids keep separate, well defined results. Null text counts as the empty text.
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this library where the driver has it (on a cluster it is installed or sent along)."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a session with all executors in the driver's
    process (tests) gets a temporary one; any other is told to name one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='spark-shared-', dir='/tmp')}"
        spark.sparkContext.setCheckpointDir(where)
    return where


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialises ``df`` in the shared folder, so that lost executors cost no recomputation of what is above it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As cut, through Parquet: a fraction of the size of a checkpoint."""
    folder = new_folder(df.sparkSession, "stored")
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_small_batches(docs: DataFrame) -> DataFrame:
    """docs, after the session's rows of an Arrow batch were lowered from Spark's default: texts are long rows, and a
    batch of them is held by the executor and by its Python worker. A session with a value of its own keeps it."""
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return docs


def in_larger_tasks(docs: DataFrame, size: int = 16 << 20) -> DataFrame:
    """docs in tasks of about ``size`` bytes of input or more, by Spark's estimate, without a shuffle: what each task has
    gathered of its rows meets again after the next shuffle, so many small tasks would shuffle the same keys many times."""
    estimate = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return docs.coalesce(max(1, min(estimate // size, 1 << 30)))


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) of the rows, with other columns by name; everything else is pruned."""
    return in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def sub_batches(batch: pa.RecordBatch, column: str = "text", most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes of a string or binary column (at least a row each): bounds numpy's scratch."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pc.binary_length(col).fill_null(0)).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)
    release()


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives memory that a batch no longer needs back to the system: workers live as long as their executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column without nulls as one array, and the offsets of its rows."""
    if pa.types.is_string(col.type):
        col = col.cast(pa.binary())
    elif pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    wide = pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32, count=len(col) + 1 + col.offset)[col.offset :].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and odd multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of an undirected edge list (a, b); root is the least node of the component.

    Alternates large-star and small-star steps until the edges form stars. Minima are taken by aggregation with map-side
    combine and joined back, so that a hub with many edges is never one task's group. The number of rounds grows with
    the logarithm of the component size.
    """
    e = cut(edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct())
    before = None
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = cut(small.select("x.u", "x.v").where("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
