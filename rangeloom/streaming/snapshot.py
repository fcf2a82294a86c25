"""The canonical table in two parts: a snapshot of old epochs, and the tail of the stream that is still replayed.

A snapshot is made of segments. A segment holds the rows of the batches of its epochs that were in the table when it was made,
and a row for each of their ranges. Beside them a commit keeps what the next batches must know of those before: the last microbatch
of each network with its verdict (``carry``), the highest block of each network, and the batches of older segments that were void by then. Reading
merges the segments with a replay of the tail only. A reorganisation of the tail that reaches into the snapshot takes the batches it
hits out at read, so the result is that of the full replay at any depth; the finality depth only makes that rare.

Epochs are written in the order of ``_seq``. The newest epoch is never compacted, as it may be written again.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.operators.reorg import judged, least_voids

GIVEN = "struct<alive:boolean,goes_on:boolean>"


class Snapshot:
    """The snapshot under ``root`` of a log and a ledger, both with ``epoch``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/snapshot"

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def state(self) -> dict | None:
        """The last commit: epoch, folders of rows, ranges, dead and carry, and the highest block by network."""
        fs, p = self._fs()
        if not fs.exists(p):
            return None
        epochs = [int(x.getPath().getName().partition("-")[2]) for x in fs.listStatus(p) if x.getPath().getName().startswith("commit-")]
        return json.loads(self.spark.read.text(f"{self.root}/commit-{max(epochs)}").first()[0]) if epochs else None

    def _read(self, folders: list[str]) -> DataFrame:
        parts = [self.spark.read.parquet(f"{self.root}/{f}") for f in folders]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _write(self, df: DataFrame, what: str) -> str:
        folder = f"{what}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        return folder

    def _tail(self, ledger: DataFrame, state: dict | None, upto: int | None = None) -> DataFrame:
        """The batches after the snapshot, with those that it carries over."""
        own = ledger.where(F.col("epoch") > (state["epoch"] if state else -1))
        own = (own if upto is None else own.where(F.col("epoch") <= upto)).drop("epoch").withColumn("_given", F.lit(None).cast(GIVEN))
        return own.unionByName(self._read([state["carry"]])) if state else own

    def _log(self, log: DataFrame, state: dict | None, upto: int | None = None) -> DataFrame:
        own = log.where(F.col("epoch") > (state["epoch"] if state else -1))
        own = (own if upto is None else own.where(F.col("epoch") <= upto)).drop("epoch")
        return own.unionByName(self._read([state["carried_rows"]]), allowMissingColumns=True) if state else own

    def _hit(self, tail: DataFrame, state: dict) -> DataFrame | None:
        """_seq of the snapshot's batches that the tail makes void; None if it does not reach so far."""
        deep = [(r["network"], r["void"]) for r in least_voids(tail).collect() if r["void"] <= state["tops"].get(r["network"], -1)]  # a row for each network
        if not deep:
            return None
        below = reduce(lambda a, b: a | b, [(F.col("network") == n) & (F.col("end") >= v) for n, v in deep])
        return self._read(state["ranges"]).where(below).select("_seq").distinct()

    def current(self, log: DataFrame, ledger: DataFrame) -> DataFrame:
        """The rows that are in the table now."""
        state = self.state()
        tail = self._tail(ledger, state)
        live = self._log(log, state).join(judged(tail).where("_in").select("_seq"), "_seq", "left_semi")
        if not state:
            return live
        settled = self._read(state["rows"])
        if state["dead"]:
            settled = settled.join(self._read(state["dead"]), "_seq", "left_anti")
        hit = self._hit(tail, state)
        settled = settled if hit is None else settled.join(hit, "_seq", "left_anti")
        return settled.unionByName(live, allowMissingColumns=True)

    def final_epoch(self, ledger: DataFrame, depth: int) -> int | None:
        """The last epoch such that it and all before it end ``depth`` blocks or more below each network's highest block; the newest one never counts."""
        state = self.state()
        own = ledger.where(F.col("epoch") > (state["epoch"] if state else -1))
        ends = own.where(~F.coalesce("_notice", F.lit(False))).select("epoch", F.explode("_ranges").alias("r")).groupBy("epoch", "r.network").agg(F.max("r.end").alias("end"))
        tops = ends.groupBy("network").agg(F.max("end").alias("top"))
        if state and state["tops"]:
            known = self.spark.createDataFrame(list(state["tops"].items()), "network string, top long")  # a row for each network
            tops = tops.unionByName(known).groupBy("network").agg(F.max("top").alias("top"))
        late = ends.join(tops, "network").where(F.col("end") > F.col("top") - depth).agg(F.min("epoch").alias("first"))
        newest = own.agg(F.max("epoch").alias("newest"))
        first, newest = late.crossJoin(newest).first()
        if newest is None:
            return None
        upto = min(newest, newest + 1 if first is None else first) - 1
        return upto if upto > (state["epoch"] if state else -1) else None

    def compact(self, log: DataFrame, ledger: DataFrame, depth: int = 0) -> bool:
        """Moves the final epochs of the tail into a new segment; whether there were any. Only the tail is read, nothing old is rewritten."""
        state, upto = self.state(), self.final_epoch(ledger, depth)
        if upto is None:
            return False
        head = self._tail(ledger, state, upto)
        verdicts = self.spark.read.parquet(f"{self.root}/{self._write(judged(head), 'verdicts')}")
        notice = F.coalesce("_notice", F.lit(False))
        ranges = head.select("_seq", notice.alias("notice"), F.explode("_ranges").alias("r")).select("_seq", "notice", "r.*")
        last = ranges.where("not notice").groupBy("network").agg(F.max("_seq").alias("last"))
        runs = verdicts.join(last.select(F.col("last").alias("_seq")).distinct(), "_seq", "left_semi").select("key", "run").distinct()
        kept = verdicts.join(runs, ["key", "run"], "left_semi")
        carried = kept.select("_seq", "_ranges", F.col("complete").alias("_ranges_complete"), F.lit(False).alias("_notice"), F.struct("alive", "goes_on").alias("_given"))
        late = ranges.where("notice").join(last, "network").where("_seq > last").select("_seq").distinct()
        notices = head.where(notice).join(late, "_seq", "left_semi").select("_seq", "_ranges", "_ranges_complete", "_notice", F.struct(F.lit(False).alias("alive"), F.lit(False).alias("goes_on")).alias("_given"))
        done = verdicts.where("_in").select("_seq").join(kept.select("_seq"), "_seq", "left_anti")
        rows = self._log(log, state, upto)
        settled = ranges.where("not notice").join(done, "_seq", "left_semi").select("_seq", "network", "start", "end")
        ends = ranges.where("not notice").groupBy("network").agg(F.max("end").alias("end")).collect()  # a row for each network
        tops = {r["network"]: max(r["end"], (state or {"tops": {}})["tops"].get(r["network"], r["end"])) for r in ends}
        dead = [] if state is None or (hit := self._hit(head, state)) is None else [self._write(hit, "dead")]
        now = {
            "epoch": upto,
            "rows": [*(state["rows"] if state else []), self._write(rows.join(done, "_seq", "left_semi"), "rows")],
            "ranges": [*(state["ranges"] if state else []), self._write(settled.repartitionByRange("network", "end").sortWithinPartitions("network", "end"), "ranges")],
            "dead": [*(state["dead"] if state else []), *dead],
            "carry": self._write(carried.unionByName(notices), "carry"),
            "carried_rows": self._write(rows.join(carried.select("_seq"), "_seq", "left_semi"), "carried"),
            "tops": {**(state["tops"] if state else {}), **tops},
        }
        fs, _ = self._fs()
        # of two compactions of the same epochs the second finds the file there
        out = fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commit-{upto}"), False)
        out.write(bytearray(json.dumps(now).encode()))
        out.close()
        return True
