"""Block positions: bounds of tables, ranges to load, loads by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.functions.ranges import batch_id, make_range
from rangeloom.sources.footers import bounds


def in_range(df: DataFrame, block: str, start: int, end: int) -> DataFrame:
    """Rows with start <= block < end; a predicate that reaches the scan."""
    return df.where((F.col(block) >= start) & (F.col(block) < end))


def from_block(df: DataFrame, block: str, least: int, detected: int, buffer: int = 200) -> DataFrame:
    """Rows from ``detected - buffer``, but not before ``least``."""
    return df.where(F.col(block) >= max(least, detected - buffer))


def max_block(df: DataFrame, block: str) -> int:
    """The highest block: from the files' footers if ``df`` is a table as read, else by a scan."""
    found = bounds(df, block)[1]
    if found is None:
        raise ValueError("the table has no blocks")
    return int(found)


def recent_range(df: DataFrame, block: str, n: int) -> tuple[int, int]:
    """(first, last) of the last n blocks before the highest, and it."""
    top = max_block(df, block)
    return max(0, top - n), top


def recent_blocks(df: DataFrame, block: str, n: int) -> DataFrame:
    """Rows of recent_range. The highest block is looked up first (``max_block``), so that the range is a literal that reaches the scan."""
    return df.where(F.col(block) >= recent_range(df, block, n)[0])


def resolve_end(df: DataFrame, block: str, spec: str | int | None) -> int | None:
    """An inclusive end: none (no end), ``latest``, ``-n`` (so many before the latest) or a number."""
    if spec is None:
        return None
    text = str(spec).strip().lower()
    if text == "latest":
        return max_block(df, block)
    n = int(text)
    return max_block(df, block) + n if text.startswith("-") else n


def partition_size(start: int, end: int, size: int | None = None, workers: int | None = None) -> int:
    """Blocks of a partition of [start, end): the size asked for, or an equal share of the workers, rounded up."""
    if end <= start:
        raise ValueError("the range is empty")
    if size is None and not workers:
        raise ValueError("a partition size or a number of workers is needed")
    if size is not None and size <= 0 or size is None and workers <= 0:
        raise ValueError("partition size and workers must be positive")
    return size if size is not None else -(-(end - start) // workers)


def block_partitions(spark: SparkSession, start: int, end: int, size: int | None = None, workers: int | None = None) -> DataFrame:
    """part, start_block, end_block (exclusive) of ranges that cover [start, end) without overlap."""
    step = partition_size(start, end, size, workers)
    n = -(-(end - start) // step)
    first = F.lit(start) + F.col("id") * step
    return spark.range(n).select(F.col("id").alias("part"), first.alias("start_block"), F.least(first + step, F.lit(end)).alias("end_block"))


def with_partition(df: DataFrame, block: str, network: str, start: int, end: int, step: int) -> DataFrame:
    """Rows of [start, end) with part and the id of their partition's range, whose end is its last block."""
    part: Column = F.floor((F.col(block) - start) / F.lit(step)).cast("long")
    first = F.lit(start) + F.col("part") * step
    own = in_range(df, block, start, end).withColumn("part", part)
    return own.withColumn("_batch_id", batch_id(make_range(F.lit(network), first, F.least(first + step, F.lit(end)) - 1)))


def partitioned_load(df: DataFrame, block: str, network: str, start: int, end: int, path: str | None = None, size: int | None = None, workers: int | None = None) -> DataFrame:
    """Loads [start, end) in one job, ranges side by side; rows loaded by partition, with its id.

    Every task writes whole block ranges; the returned counts are of what was written if a path is given.
    """
    spark = df.sparkSession
    rows = with_partition(df, block, network, start, end, partition_size(start, end, size, workers))
    if path:
        rows.repartitionByRange(block).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path)
    return rows.groupBy("part", "_batch_id").agg(F.count("*").alias("rows"), F.min(block).alias("first_block"), F.max(block).alias("last_block"))


def partition_totals(audit: DataFrame) -> DataFrame:
    """rows, seconds, completed, failed and rows a second of an audit table of partition loads."""
    done = F.col("success")
    return audit.agg(F.coalesce(F.sum(F.when(done, F.col("rows"))), F.lit(0)).alias("rows"), F.sum("seconds").alias("seconds"), F.count_if(done).alias("completed"), F.count_if(~done).alias("failed"), F.avg(F.when(done & (F.col("seconds") > 0), F.col("rows") / F.col("seconds"))).alias("rows_per_second"))
