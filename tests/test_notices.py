"""Reorganisations told by a running stream: restarts, repeated deliveries, size of the state."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import types as T

from rangeloom.operators import reorg
from rangeloom.streaming import continuous

SCHEMA = T.StructType([T.StructField("b", T.LongType())])


def batches(seed, n=60, networks="abc"):
    r, at, out = random.Random(seed), dict.fromkeys(networks, 0), []
    for seq in range(1, n + 1):
        own = []
        for net in r.sample(networks, r.randint(1, 2)):
            start = at[net] if r.random() < 0.7 else max(0, at[net] - r.randint(1, 12))
            end = start + r.randint(0, 5)
            own.append({"network": net, "numbers": {"start": start, "end": end}, "hash": r.choice([None, f"h{seq}"])})
            at[net] = end + 1
        out.append((seq, own))
    return out


def deliver(spark, source, part):
    rows = [(k, seq, json.dumps({"ranges": own, "ranges_complete": True}), False) for seq, own in part for k in range(3)]
    rows.append((0, part[-1][0], json.dumps({"ranges": [{"network": "a", "start": 0, "end": 0}]}), True))  # a notice is no batch
    spark.createDataFrame(rows, "b long, _seq long, _metadata_json string, _notice boolean").repartition(2).write.mode("append").parquet(source)


@pytest.mark.parametrize("seed", [1, 2])
def test_a_stream_that_stops_and_goes_on_tells_what_a_replay_finds(spark, tmp_path, seed):
    source, root, all_ = f"file://{tmp_path}/src", f"file://{tmp_path}/t", batches(seed)
    for a in range(0, len(all_), 20):
        deliver(spark, source, all_[a : a + 20])
        if a == 20:
            deliver(spark, source, all_[a + 10 : a + 20])  # again, after a source that lost its place
        table = continuous.ContinuousTable(spark, root)  # another query that goes on from the checkpoint
        q = table.start_notices(continuous.read_block_stream(spark, source, SCHEMA), available_now=True)
        assert continuous.await_load(q)
    rows = [(seq, x["network"], x["numbers"]["start"], x["numbers"]["end"], x["hash"], None) for seq, own in all_ for x in own]
    ranges = spark.createDataFrame(rows, "_seq long, network string, start long, end long, hash string, prev_hash string")
    want = sorted(map(tuple, reorg.detect_reorgs(ranges).select("_seq", "network", "start", "end").collect()))
    assert sorted(map(tuple, table.notices().collect())) == want and want
    kept = [p.numRowsTotal for progress in q.recentProgress for p in progress.stateOperators]
    assert kept and max(kept) <= 3  # a value for each network
    assert not list(Path(tmp_path / "t").glob("last*"))
