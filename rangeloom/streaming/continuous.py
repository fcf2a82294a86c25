"""Continuous loads: block streams into an append-only log, with reorganisations and repeated deliveries.

The log keeps every data row with its ``_seq``; the ledger keeps every batch. Both are written by epoch folder, so an epoch
that is run again replaces its own files. What is current is a view (rangeloom.operators.reorg.published over the
ledger), so a reorganisation costs no rewrite; ``compact`` moves old epochs into a snapshot, so that a read replays the tail only (rangeloom.streaming.snapshot). What reorganisations void is also told while the stream runs: ``start_notices`` is a second query
over the batch marks, with the last range of each network in a state store (rangeloom.streaming.notices).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.ranges import RANGES, batch_id_list, parse_metadata
from rangeloom.operators.partition import from_block, max_block, partitioned_load
from rangeloom.sources.block_source import register
from rangeloom.streaming.notices import NOTICE, reorg_notices
from rangeloom.streaming.snapshot import Snapshot

LEDGER = T.StructType([T.StructField("_seq", T.LongType()), T.StructField("_ranges", RANGES), T.StructField("_ranges_complete", T.BooleanType()), T.StructField("_notice", T.BooleanType())])


def read_block_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of rows with ``_seq`` and ``_metadata_json`` (text, from the source) as ``_ranges`` and
    ``_ranges_complete`` columns. Metadata that cannot be read gives no ranges; the rows are kept."""
    envelope = T.StructType([*schema.fields, T.StructField("_seq", T.LongType()), T.StructField("_metadata_json", T.StringType()), T.StructField("_notice", T.BooleanType())])
    reader = spark.readStream.schema(envelope)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    ranges, complete = parse_metadata(F.col("_metadata_json"))
    return reader.parquet(path).withColumn("_ranges", ranges).withColumn("_ranges_complete", complete).drop("_metadata_json")


def read_blocks(spark: SparkSession, path: str, block: str, network: str, schema: T.StructType, blocks_per_trigger: int = 0, blocks_per_task: int = 10_000, start: int = 0, table: ContinuousTable | None = None) -> DataFrame:
    """A stream of the blocks of a table that grows, as read_block_stream gives it; offsets are block positions. A new query goes on after what
    the ledger of ``table`` has."""
    register(spark)
    options = {"path": path, "block": block, "network": network, "schema": schema.json(), "start": start, "blocksPerTask": blocks_per_task, "blocksPerTrigger": blocks_per_trigger}
    stream = spark.readStream.format("blocks").options(**options | ({"ledger": f"{table.root}/ledger"} if table else {})).load()
    ranges, complete = parse_metadata(F.col("_metadata_json"))
    return stream.withColumn("_ranges", ranges).withColumn("_ranges_complete", complete).drop("_metadata_json")


class ContinuousTable:
    """A table that a block stream feeds. Restarts go on from the checkpoint; its epochs replace themselves."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _apply(self, rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        try:
            batches = rows.groupBy("_seq").agg(F.first("_ranges").alias("_ranges"), F.bool_or("_ranges_complete").alias("_ranges_complete"), F.bool_or(F.coalesce("_notice", F.lit(False))).alias("_notice"))
            data = rows.where(~F.coalesce("_notice", F.lit(False))).withColumn("_batch_id", batch_id_list(F.col("_ranges"))).drop("_ranges", "_ranges_complete", "_notice")
            data.write.mode("overwrite").parquet(f"{self.root}/log/epoch={epoch}")
            # after the rows, so that no batch is known whose rows are not there
            batches.write.mode("overwrite").parquet(f"{self.root}/ledger/epoch={epoch}")
        finally:
            rows.unpersist()

    def _folders(self, name: str, prefix: str) -> dict[int, str]:
        """Folders below ``name`` whose names are a prefix and a number."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [x.getPath() for x in fs.listStatus(p)] if fs.exists(p) else []
        return {int(x.getName().removeprefix(prefix)): x.toString() for x in found if x.getName().startswith(prefix)}

    def _base(self, fresh: bool) -> int:
        """The number of the checkpoint to go on from: the epoch folders of its query begin with it."""
        known = self._folders("", "checkpoint-")
        if known and not fresh:
            return max(known)
        ledger = self._folders("ledger", "epoch=")
        for epoch, folder in self._folders("log", "epoch=").items():
            if epoch not in ledger:  # its batches are not known, so they come again
                p = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        return max([-1, *ledger, *known]) + 1

    def start(self, stream: DataFrame, available_now: bool = False, fresh: bool = False):
        """Starts the query; with available_now it ends when the source has no more, but after one micro-batch of a source written in Python
        (read_blocks), as Spark has no admission by steps there: ``load`` reads all of it. fresh: without the source's place in the checkpoint, as
        a stream that goes on after the ledger (read_blocks) does not need it."""
        base = self._base(fresh)
        writer = stream.writeStream.option("checkpointLocation", f"{self.root}/checkpoint-{base}").foreachBatch(lambda rows, epoch: self._apply(rows, base + epoch))
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def load(self, stream: DataFrame, fresh: bool = False) -> None:
        """Reads all that the source has, in as many micro-batches as its limits ask for. While the source grows faster than it is read, this goes on."""
        query = self.start(stream, fresh=fresh)
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def start_notices(self, stream: DataFrame, available_now: bool = False):
        """Starts the query that tells of reorganisations as their batches arrive; it has a checkpoint and an output of its own."""
        writer = reorg_notices(stream).writeStream.format("parquet").option("checkpointLocation", f"{self.root}/notices-checkpoint").option("path", f"{self.root}/notices").outputMode("append")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def _ledger(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*LEDGER.fields, T.StructField("epoch", T.LongType())])).parquet(f"{self.root}/ledger")

    def ledger(self) -> DataFrame:
        return self._ledger().drop("epoch")

    def notices(self) -> DataFrame:
        """_seq, network, start, end of what the batches seen so far made void."""
        return self.spark.read.schema(NOTICE).parquet(f"{self.root}/notices")

    def _log(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/log")

    def log(self) -> DataFrame:
        return self._log().drop("epoch")

    def current(self) -> DataFrame:
        """The rows that are in the table after everything that has arrived: the snapshot, if there is one, and a replay of the epochs after it."""
        return Snapshot(self.spark, self.root).current(self._log(), self._ledger())

    def compact(self, depth: int = 0) -> bool:
        """Moves the epochs that lie ``depth`` blocks below each network's highest one into the snapshot; whether there were any."""
        return Snapshot(self.spark, self.root).compact(self._log(), self._ledger(), depth)


def hybrid_load(history: DataFrame, block: str, network: str, least: int, path: str, table: ContinuousTable, stream: DataFrame, buffer: int = 200, workers: int = 4, available_now: bool = True):
    """Loads history up to its highest block by ranges, then starts the stream from ``buffer`` blocks before that.

    Returns the counts by range and the streaming query; rows of the overlap are told apart by ``combined``.
    """
    top = max_block(history, block)
    counts = partitioned_load(history, block, network, least, top + 1, path, workers=workers)
    return counts, table.start(from_block(stream, block, least, top, buffer), available_now)


def combined(history: DataFrame, live: DataFrame, keys: list[str]) -> DataFrame:
    """History and live rows; where both have a key the live row counts."""
    return history.join(live, keys, "left_anti").unionByName(live, allowMissingColumns=True)


def await_load(query, seconds: float | None = None) -> bool:
    """Waits for a streaming load to end; stops it and returns False after so many seconds."""
    done = query.awaitTermination(seconds) if seconds is not None else (query.awaitTermination() or True)
    if not done:
        query.stop()
    return bool(done)
