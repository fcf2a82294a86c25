"""The canonical table from a snapshot and the tail equals the full replay, whatever is compacted when."""

import random

import pytest
from pyspark.sql import functions as F

from rangeloom.operators import reorg
from rangeloom.plans import registered
from rangeloom.streaming.snapshot import Snapshot

LEDGER = "_seq long, _ranges array<struct<network:string,start:long,end:long,hash:string,prev_hash:string>>, _ranges_complete boolean, _notice boolean, epoch long"


def stream(seed, n):
    """Batches with repeats, parts of microbatches, notices and reorganisations, some of them deep."""
    r, rows, at = random.Random(seed), [], {"a": 0, "b": 0}
    for seq in range(n):
        kind = r.random()
        if rows and kind < 0.3:
            last = next((x for x in reversed(rows) if not x[3]), None)
            if last:
                rows.append((seq, last[1], r.random() < 0.5, False))
                continue
        if kind < 0.36:
            net = r.choice("ab")
            start = max(0, at[net] - r.randint(1, 9))
            rows.append((seq, [(net, start, start, None, None)], True, True))
            at[net] = start
            continue
        own = []
        for net in ("a", "b") if r.random() < 0.3 else (r.choice("ab"),):
            deep = 60 if r.random() < 0.08 else 6
            start = at[net] if r.random() < 0.8 else max(0, at[net] - r.randint(1, deep))
            end = start + r.randint(0, 6)
            own.append((net, start, end, r.choice([None, f"h{seq}"]), None))
            at[net] = end + 1
        rows.append((seq, own, r.random() < 0.7, False))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_and_tail_equal_the_full_replay(spark, tmp_path, seed):
    r, root = random.Random(100 + seed), f"file://{tmp_path}"
    rows, snap, at, epoch, hits = stream(seed, 70), Snapshot(spark, root), 0, 0, 0
    want = None
    while at < len(rows):
        part = rows[at : at + r.randint(12, 20)]
        at += len(part)
        spark.createDataFrame([(*x, epoch) for x in part], LEDGER).drop("epoch").coalesce(1).write.parquet(f"{root}/ledger/epoch={epoch}")
        data = [(x[0], k) for x in part if not x[3] for k in range(2)]
        spark.createDataFrame(data, "_seq long, k int").coalesce(1).write.parquet(f"{root}/log/epoch={epoch}")
        epoch += 1
        ledger, log = spark.read.parquet(f"{root}/ledger"), spark.read.parquet(f"{root}/log")
        if r.random() < 0.8:
            hits += snap.compact(log, ledger, depth=r.choice([0, 5, 20]))
        got = sorted((x._seq, x.k) for x in snap.current(log, ledger).collect())
        want = sorted((x._seq, x.k) for x in log.join(reorg.published(ledger.drop("epoch")), "_seq", "left_semi").select("_seq", "k").collect())
        assert got == want, (epoch, snap.state())
    assert hits and want


def test_a_read_replays_the_tail_only(spark, tmp_path):
    root, snap = f"file://{tmp_path}", Snapshot(spark, f"file://{tmp_path}")
    for e in range(6):
        spark.createDataFrame([(e, [("a", e * 10, e * 10 + 9, f"h{e}", None)], True, False)], LEDGER.rpartition(",")[0]).coalesce(1).write.parquet(f"{root}/ledger/epoch={e}")
        spark.range(3).select(F.lit(e).cast("long").alias("_seq"), "id").coalesce(1).write.parquet(f"{root}/log/epoch={e}")
    ledger, log = spark.read.parquet(f"{root}/ledger"), spark.read.parquet(f"{root}/log")
    assert snap.compact(log, ledger, depth=15) and snap.state()["epoch"] == 3
    assert not snap.compact(log, ledger, depth=15)
    now = snap.current(log, ledger)
    assert now.count() == 18
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(epoch") >= 2 and "(epoch#" in plan and "> 3)" in plan
    before = snap.state()["rows"]
    assert snap.compact(log, ledger) and snap.state()["epoch"] == 4 and snap.state()["rows"][:1] == before
    with pytest.raises(Exception, match="exist"):  # a second writer of the same commit
        out = snap._fs()[0].create(spark._jvm.org.apache.hadoop.fs.Path(f"{snap.root}/commit-4"), False)
        out.close()


def test_registered_replay_through_a_snapshot(spark):
    assert "canonical_snapshot" in registered.QUERIES
