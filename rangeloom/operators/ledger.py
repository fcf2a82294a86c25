"""The ledger of processed batches: resume points, gaps, marks, removal.

A ledger row is one range of one batch: connection, table, network, start, end, hash, prev_hash, batch_id. Functions that
do not need the first two take any table with network, start and end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeloom.functions.ranges import ids_of

KEY = ["connection", "table", "network", "batch_id"]


def mark_processed(ledger: DataFrame, batches: DataFrame) -> DataFrame:
    """The ledger with the complete ones of ``batches`` (``_ranges_complete``) added once each."""
    new = batches.where(F.coalesce("_ranges_complete", F.lit(False))).select(*ledger.columns)
    return ledger.unionByName(new).dropDuplicates([c for c in KEY if c in ledger.columns])


def unprocessed_batches(batches: DataFrame, ledger: DataFrame, ids: str = "_batch_id") -> DataFrame:
    """Rows whose batch ids are not all in the ledger. Only distinct id lists are looked up."""
    lists = batches.select(ids).distinct().select(ids, F.explode(ids_of(F.col(ids))).alias("id"))
    known = ledger.select(F.col("batch_id").alias("id"), F.lit(True).alias("known")).distinct()
    done = lists.join(known, "id", "left").groupBy(ids).agg(F.bool_and(F.coalesce("known", F.lit(False))).alias("all")).where("all").select(ids)
    return batches.join(done, ids, "left_anti")


def max_position(ledger: DataFrame) -> DataFrame:
    """For each network the range with the greatest end, with its hashes; among equal ends the one that starts last."""
    fields = [c for c in ("start", "end", "hash", "prev_hash", "batch_id") if c in ledger.columns]
    top = F.max_by(F.struct(*fields), F.struct("end", "start"))
    return ledger.groupBy("network").agg(top.alias("x")).select("network", "x.*")


def detect_gaps(ledger: DataFrame, bucket: int = 1 << 20) -> DataFrame:
    """network, gap_start, gap_end of the blocks between ranges that no range covers; ranges may overlap.

    How far earlier ranges reach is the greatest end within the bucket of ``bucket`` blocks, or of all buckets before it: windows
    run over a bucket's rows, and over one row for each bucket.
    """
    own = ledger.select("network", "start", "end").withColumn("bucket", F.floor(F.col("start") / bucket))
    ends = own.groupBy("network", "bucket").agg(F.max("end").alias("top"))
    carried = ends.withColumn("carried", F.max("top").over(Window.partitionBy("network").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).drop("top")
    before = Window.partitionBy("network", "bucket").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = own.withColumn("inner", F.max("end").over(before)).join(carried, ["network", "bucket"]).withColumn("reach", F.greatest("inner", "carried"))
    return reach.where(F.col("start") > F.col("reach") + 1).select("network", (F.col("reach") + 1).alias("gap_start"), (F.col("start") - 1).alias("gap_end"))


def remaining(ledger: DataFrame) -> DataFrame:
    """network and the block after its greatest end: where loading goes on."""
    return ledger.groupBy("network").agg((F.max("end") + 1).alias("at"))


def resume_position(ledger: DataFrame, with_gaps: bool = False) -> DataFrame:
    """network, start, end, is_gap. Without gaps the greatest ranges; with gaps every hole, then the mark where loading
    goes on (start = end = the next block)."""
    if not with_gaps:
        return max_position(ledger).select("network", "start", "end", F.lit(False).alias("is_gap"))
    gaps = detect_gaps(ledger).select("network", F.col("gap_start").alias("start"), F.col("gap_end").alias("end"), F.lit(True).alias("is_gap"))
    marks = remaining(ledger).select("network", F.col("at").alias("start"), F.col("at").alias("end"), F.lit(False).alias("is_gap"))
    return gaps.unionByName(marks)


def resume_plan(ledger: DataFrame, end: int | None, size: int | None = None, workers: int = 4, least: int = 1_000_000) -> DataFrame:
    """network, start_block, end_block (exclusive), priority: gaps (0) before what remains up to ``end`` (1), in parts.

    Part size of a gap: size, or a worker's share but not below ``least``; of the rest: size or a worker's share.
    """
    blocks = F.col("z") - F.col("a")
    share = F.lit(size) if size else F.greatest(F.lit(1), F.ceil(blocks / workers).cast("long"))
    gap_share = F.lit(size) if size else F.greatest(F.lit(least), F.floor(blocks / workers).cast("long"))
    gaps = detect_gaps(ledger).select("network", F.col("gap_start").alias("a"), (F.col("gap_end") + 1).alias("z"), F.lit(0).alias("priority"))
    plan = gaps = gaps.withColumn("step", gap_share.cast("long"))
    if end is not None:
        rest = remaining(ledger).where(F.col("at") < end).select("network", F.col("at").alias("a"), F.lit(end).cast("long").alias("z"), F.lit(1).alias("priority"))
        plan = gaps.unionByName(rest.withColumn("step", share.cast("long")))
    parts = plan.select("network", "z", "priority", "step", F.explode(F.sequence(F.col("a"), F.col("z") - 1, F.col("step"))).alias("start_block"))
    return parts.select("network", "start_block", F.least(F.col("start_block") + F.col("step"), F.col("z")).alias("end_block"), "priority")


def invalidate_from(ledger: DataFrame, network: str, block: int) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): a network's rows that end at ``block`` or after it are removed."""
    gone = (F.col("network") == network) & (F.col("end") >= block)
    return ledger.where(~gone), ledger.where(gone)


def cleanup_before(ledger: DataFrame, network: str, block: int) -> DataFrame:
    """The ledger without a network's rows that end before ``block``."""
    return ledger.where((F.col("network") != network) | (F.col("end") >= block))
