"""Reorganisations as a stream: a keyed state store holds the last range of each network.

Every task first drops the repeated batch marks of its rows (a batch's rows all carry its ranges); what is left is grouped by network and
meets the network's last range from the state store. State has one value for each network, restarts go on from the
checkpoint, and a batch that comes again after a restart is known by its ``_seq`` and told of once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rangeloom.functions.ranges import FIELDS

NOTICE = "_seq long, network string, start long, end long"
_LAST = "seq long, start long, end long, hash string, prev_hash string"
MARKS = ["seq", *FIELDS]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastRange(StatefulProcessor):
    """What each range of a network makes void, given the range before it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        marks = {x for part in rows for x in part[MARKS].astype(object).where(part[MARKS].notna(), None).itertuples(index=False, name=None)}
        before, found = self.last.get(), []
        for seq, network, start, end, *hashes in sorted(marks, key=lambda m: (m[0], m[2], m[3])):
            if before is not None and seq <= before[0]:
                continue  # delivered again
            now = (int(seq), int(start), int(end), *hashes)
            if before is not None and now[1:] != tuple(before[1:]) and start <= before[2]:
                found.append((now[0], network, now[1], max(now[2], before[2])))
            before = now
        if before is not None:
            self.last.update(before)
        yield pd.DataFrame(found, columns=["_seq", "network", "start", "end"])


def _distinct_marks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each mark once for a task's batch of rows."""
    for part in parts:
        yield part.drop_duplicates()


def use_state_store(spark: SparkSession) -> None:
    """State with named values needs the RocksDB store; a session that has it configured keeps its setting."""
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def reorg_notices(stream: DataFrame) -> DataFrame:
    """_seq, network, start and end of what the batches of a stream (``_seq``, ``_ranges``, ``_notice``) make void, as they arrive."""
    use_state_store(stream.sparkSession)
    rows = stream.where(~F.coalesce("_notice", F.lit(False))).select("_seq", F.explode("_ranges").alias("r"))
    marks = rows.select(F.col("_seq").alias("seq"), *[F.col(f"r.{f}").alias(f) for f in FIELDS])
    return marks.mapInPandas(_distinct_marks, marks.schema).groupBy("network").transformWithStateInPandas(LastRange(), outputStructType=NOTICE, outputMode="append", timeMode="none")
