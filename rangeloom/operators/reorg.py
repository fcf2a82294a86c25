"""Reorganisations: later batches that replace blocks of earlier ones.

Batches are rows ``_seq, _ranges, _ranges_complete, _notice`` in stream order: a data batch, or a notice that blocks from
a start on are void. A range that differs from its network's previous one and starts no later than that ended replaces
what ends at or after its start. Everything is decided on batches, with windows by network; table rows are only joined
with the verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rangeloom.functions.ranges import FIELDS, batch_id, ids_of, make_range
from rangeloom.operators.ledger import invalidate_from


def exploded(batches: DataFrame) -> DataFrame:
    """One row for each range of each batch."""
    return batches.select("_seq", F.explode("_ranges").alias("r")).select("_seq", *[F.col(f"r.{f}").alias(f) for f in FIELDS])


def _same(a: str, b: str) -> Column:
    """Equality of all fields of two range columns; missing hashes are equal."""
    out = F.col(b).isNotNull()
    for f in FIELDS:
        out = out & F.col(f"{a}.{f}").eqNullSafe(F.col(f"{b}.{f}"))
    return out


#: Values of _seq in a bucket.
BUCKET = 1 << 20


def _dealt(rows: DataFrame, bucket: int) -> DataFrame:
    """rows by network and bucket of ``_seq``: one exchange that all passes over them share."""
    return rows.withColumn("__bucket", F.floor(F.col("_seq") / bucket)).repartition("network", "__bucket")


def _joined_by_bucket(rows: DataFrame, value: Column, name: str, summary: Column, inner, across, both, later: bool = False) -> DataFrame:
    """Dealt rows with ``name``: ``both`` of what ``inner`` makes of the values before (or after) a row in its bucket, and of what ``across``
    makes of the summaries of the buckets before (or after) it."""
    span = (1, Window.unboundedFollowing) if later else (Window.unboundedPreceding, -1)
    own = rows.withColumn("__value", value)
    each = own.groupBy("network", "__bucket").agg(summary.alias("__summary"))
    far = each.withColumn("__far", across("__summary").over(Window.partitionBy("network").orderBy("__bucket").rowsBetween(*span))).drop("__summary")
    near = own.withColumn("__near", inner("__value").over(Window.partitionBy("network", "__bucket").orderBy("_seq").rowsBetween(*span)))
    return near.join(far, ["network", "__bucket"]).withColumn(name, both("__near", "__far")).drop("__value", "__near", "__far")


def _last_before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Dealt rows with ``name``: the last value, nulls passed over, of the rows before in the network."""
    last = lambda c: F.last(c, ignorenulls=True)
    return _joined_by_bucket(rows, value, name, F.max_by("__value", F.when(F.col("__value").isNotNull(), F.col("_seq"))), last, last, F.coalesce)


def _least_after(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Dealt rows with ``name``: the least value of the rows after in the network."""
    return _joined_by_bucket(rows, value, name, F.min("__value"), F.min, F.min, F.least, later=True)


def _with_previous(ranges: DataFrame, bucket: int = BUCKET) -> DataFrame:
    dealt = _dealt(ranges.withColumn("cur", F.struct(*FIELDS)), bucket)
    return _last_before(dealt, F.col("cur"), "prev").drop("__bucket")


def _voids(ranges: DataFrame, bucket: int) -> DataFrame:
    """Ranges with ``prev`` that differ from it and start no later than it ends."""
    return _with_previous(ranges, bucket).where(~_same("cur", "prev") & (F.col("start") <= F.col("prev.end")))


def detect_reorgs(ranges: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """_seq, network, start, end of what each range (``_seq`` and range fields) invalidates."""
    return _voids(ranges, bucket).select("_seq", "network", "start", F.greatest("end", "prev.end").alias("end"))


def first_voided_by(ranges: DataFrame, size: int = 1000, bucket: int = BUCKET) -> DataFrame:
    """_seq, network, start, end and by_seq of the ranges that a later one made void, by_seq being the first that did.

    Of the ranges that are not void yet the one before always ends last, so what a void is the first to hit lies between its start
    and that end: all voids together reach over no more blocks than were delivered. Ranges meet them in the buckets of ``size`` blocks.
    """
    voids = _voids(ranges, bucket).select(F.col("_seq").alias("by_seq"), "network", F.col("start").alias("void"), F.col("prev.end").alias("top"))
    blocks = lambda a, z: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(z) / size)))
    own = ranges.select("_seq", "network", "start", "end", blocks("start", "end").alias("block"))
    met = own.join(voids.select("by_seq", "network", "void", blocks("void", "top").alias("block")), ["network", "block"])
    return met.where("by_seq > _seq AND void <= end").groupBy("_seq", "network", "start", "end").agg(F.min("by_seq").alias("by_seq"))


def detect_duplicates(ranges: DataFrame) -> DataFrame:
    """_seq of the batches all of whose ranges equal their networks' previous ones."""
    own = _with_previous(ranges).withColumn("same", _same("cur", "prev"))
    return own.groupBy("_seq").agg(F.bool_and("same").alias("same")).where("same").select("_seq")


def _ranged(batches: DataFrame, bucket: int) -> DataFrame:
    """A row for each range of the batches, with plain flags: what it equals, what it makes void and what voids it later.

    ``_given`` (alive, goes_on), where a batch has it, is its verdict after the batches that are not here any more: it voids nothing again.
    """
    given = F.col("_given") if "_given" in batches.columns else F.lit(None).cast("struct<alive:boolean,goes_on:boolean>")
    base = batches.select("_seq", "_ranges", F.coalesce("_ranges_complete", F.lit(False)).alias("complete"), F.coalesce("_notice", F.lit(False)).alias("notice"), given.alias("given"))
    flags = ["_seq", "_ranges", "complete", "notice", "given"]
    rows = _dealt(base.select(*flags, F.explode("_ranges").alias("cur")).select(*flags, "cur", "cur.network", "cur.start", "cur.end"), bucket)
    # of the last data batch before: its range and its place
    rows = _last_before(rows, F.when(~F.col("notice"), F.struct("cur", "_seq")), "before").withColumn("prev", F.col("before.cur")).withColumn("turn", F.col("before._seq"))
    rows = rows.withColumn("eq", _same("cur", "prev"))
    voids = F.when(F.col("given").isNull() & (F.col("notice") | (~F.col("eq") & (F.col("start") <= F.col("prev.end")))), F.col("start"))
    return _least_after(rows.withColumn("void", voids), F.col("void"), "void_later")


def least_voids(batches: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """network and the least block from which on a batch made earlier ones void."""
    return _ranged(batches, bucket).where("void IS NOT NULL").groupBy("network").agg(F.min("void").alias("void"))


def judged(batches: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """_seq, key and run of each data batch (equal ranges in a row are a run, a microbatch), alive, goes_on, and whether its rows are in the
    table (``_in``)."""
    rows = _ranged(batches, bucket)
    since = Window.partitionBy("network", "turn").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("noticed", F.min(F.when(F.col("notice"), F.col("start"))).over(since))
    alive = F.coalesce("given.alive", F.lit(True)) & (F.col("void_later").isNull() | (F.col("end") < F.col("void_later")))
    goes_on = F.coalesce("given.goes_on", F.col("eq") & (F.col("noticed").isNull() | (F.col("noticed") > F.col("end"))))
    once = [F.first(c).alias(c) for c in ("_ranges", "complete")]  # a batch's ranges all carry these
    data = rows.where(~F.col("notice")).groupBy("_seq").agg(*once, F.bool_and(alive).alias("alive"), F.bool_and(goes_on).alias("goes_on")).withColumn("key", F.to_json("_ranges"))
    runs = Window.partitionBy("key").orderBy("_seq")
    data = data.withColumn("run", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(runs))
    run = Window.partitionBy("key", "run")
    before = F.max("complete").over(run.orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1))
    data = data.withColumn("done", F.max("complete").over(run)).withColumn("done_before", F.coalesce(before, F.lit(False)))
    return data.withColumn("_in", F.expr("alive and done and not done_before")).select("_seq", "_ranges", "complete", "key", "run", "alive", "goes_on", "_in")


def published(batches: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """_seq of the data batches whose rows are in the table after the whole stream.

    A batch is in if nothing later replaces any of its ranges, its microbatch (equal ranges in a row) got complete, and
    it is not a second delivery of a complete microbatch.
    """
    return judged(batches, bucket).where("_in").select("_seq")


def current_rows(log: DataFrame, batches: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``log`` (with ``_seq``) that are in the table after all batches."""
    return log.join(published(batches, bucket), "_seq", "left_semi")


def delete_batches(rows: DataFrame, affected: DataFrame) -> DataFrame:
    """rows without those whose id list has a member in ``affected`` (batch_id). Only distinct lists are looked into."""
    lists = rows.select("_batch_id").distinct()
    hit = lists.select("_batch_id", F.explode(ids_of(F.col("_batch_id"))).alias("batch_id")).join(affected.select("batch_id"), "batch_id", "left_semi")
    return rows.join(hit.select("_batch_id").distinct(), "_batch_id", "left_anti")


def apply_reorg(rows: DataFrame, ledger: DataFrame, network: str, block: int) -> tuple[DataFrame, DataFrame]:
    """(rows, ledger) after a network's blocks from ``block`` on became void: whole batches go, also those that only
    overlap."""
    kept, removed = invalidate_from(ledger, network, block)
    return delete_batches(rows, removed), kept


def mark_superseded(rows: DataFrame, affected: DataFrame, reorg: Column | str) -> DataFrame:
    """Keeps history: current rows of affected batches get ``_is_current`` false and the id of the range that voided
    them. affected: batch_id and the columns that ``reorg`` is made of."""
    ids = affected.select("batch_id", (F.col(reorg) if isinstance(reorg, str) else reorg).alias("by"))
    lists = rows.select("_batch_id").distinct().select("_batch_id", F.explode(ids_of(F.col("_batch_id"))).alias("batch_id"))
    hit = lists.join(ids, "batch_id").groupBy("_batch_id").agg(F.min("by").alias("by"))
    out = rows.join(hit, "_batch_id", "left")
    now = F.col("by").isNotNull() & F.col("_is_current")
    marked = out.withColumn("_reorg_batch_id", F.when(now, F.col("by")).otherwise(F.col("_reorg_batch_id"))).withColumn("_is_current", F.when(now, False).otherwise(F.col("_is_current")))
    return marked.select(*rows.columns)


def history_views(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Registers ``<name>_current`` and ``<name>_history``; returns both."""
    current = rows.where("_is_current").drop("_is_current", "_reorg_batch_id")
    current.createOrReplaceTempView(f"{name}_current")
    rows.createOrReplaceTempView(f"{name}_history")
    return current, rows


def add_batch_columns(rows: DataFrame, ranges: str | Column = "_ranges", with_json: bool = False, with_history: bool = False) -> DataFrame:
    """rows with ``_batch_id``, and on request ``_block_ranges`` (JSON) and the history columns."""
    from rangeloom.functions.ranges import batch_id_list, ranges_json

    r = F.col(ranges) if isinstance(ranges, str) else ranges
    out = rows.withColumn("_batch_id", batch_id_list(r))
    if with_json:
        out = out.withColumn("_block_ranges", ranges_json(r))
    if with_history:
        out = out.withColumn("_is_current", F.lit(True)).withColumn("_reorg_batch_id", F.lit(None).cast("string"))
    return out


def range_ids(ranges: DataFrame) -> DataFrame:
    """ranges with ``batch_id``."""
    return ranges.withColumn("batch_id", batch_id(make_range("network", "start", "end", "hash", "prev_hash")))


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """One range for each network: least start, greatest end with its hash, parent hash of the first in order."""
    return ranges.groupBy("network").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max_by("hash", F.struct("end", "_seq")).alias("hash"), F.min_by("prev_hash", "_seq").alias("prev_hash"))


def range_overlaps(a: DataFrame, b: DataFrame, size: int = 1000) -> DataFrame:
    """Pairs of ranges of one network that share a block: network, a_start, a_end, b_start, b_end.

    Ranges meet in the buckets of ``size`` blocks they reach into, and a pair counts in its first common bucket.
    """
    side = lambda df, x: df.select("network", F.col("start").alias(f"{x}_start"), F.col("end").alias(f"{x}_end"), F.explode(F.sequence(F.floor(F.col("start") / size), F.floor(F.col("end") / size))).alias("bucket"))
    met = side(a, "a").join(side(b, "b"), ["network", "bucket"])
    met = met.where((F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & (F.col("bucket") == F.floor(F.greatest("a_start", "b_start") / size)))
    return met.drop("bucket")
