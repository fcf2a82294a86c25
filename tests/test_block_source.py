"""A stream by block positions: admission, restarts from the checkpoint and from the ledger, files that are rewritten."""

import shutil

import pytest
from pyspark.sql import types as T

from rangeloom.sources import block_source
from rangeloom.streaming import continuous

SCHEMA = T.StructType([T.StructField("b", T.LongType()), T.StructField("v", T.StringType())])


def grow(spark, path, low, high, files=2):
    spark.range(low, high).selectExpr("id AS b", "CAST(id * 2 AS STRING) AS v").repartition(files).write.mode("append").parquet(f"file://{path}")


def run(spark, tmp_path, table, fresh=False, **how):
    how = {"blocks_per_trigger": 30, "blocks_per_task": 8, **how}
    q = table.start(continuous.read_blocks(spark, f"file://{tmp_path}/chain", "b", "n", SCHEMA, table=table, **how), True, fresh)
    assert continuous.await_load(q)
    return [p.numInputRows for p in q.recentProgress if p.numInputRows]


def test_micro_batches_are_ranges_of_blocks(spark, tmp_path):
    table = continuous.ContinuousTable(spark, f"file://{tmp_path}/t")
    grow(spark, tmp_path / "chain", 0, 100)
    sizes = []
    for _ in range(4):  # available-now takes what one trigger may
        sizes += run(spark, tmp_path, table)
    assert max(sizes) <= 30 and sum(sizes) == 100
    # the same rows in other files, and more of them
    shutil.rmtree(tmp_path / "chain")
    grow(spark, tmp_path / "chain", 0, 130, files=3)
    sizes = run(spark, tmp_path, table)
    assert sum(sizes) == 30
    # a query without a checkpoint goes on after the ledger
    grow(spark, tmp_path / "chain", 130, 150)
    assert sum(run(spark, tmp_path, table, fresh=True)) == 20
    assert not run(spark, tmp_path, table, fresh=True) and not run(spark, tmp_path, table)
    rows = sorted((r.b, r.v) for r in table.current().select("b", "v").collect())
    assert rows == [(i, str(2 * i)) for i in range(150)] and table.log().count() == 150
    ends = sorted(r.end for x in table.ledger().collect() for r in x._ranges)
    assert ends[-1] == 149 and all(r.start // 8 == r.end // 8 for x in table.ledger().collect() for r in x._ranges)


def test_a_load_takes_all_there_is(spark, tmp_path):
    table = continuous.ContinuousTable(spark, f"file://{tmp_path}/t")
    there = []
    for low, high in ((0, 100), (200, 250)):  # the second load starts with more than a trigger's blocks that are not there
        grow(spark, tmp_path / "chain", low, high)
        there += range(low, high)
        for fresh in (True, False):  # the second time there is nothing left
            table.load(continuous.read_blocks(spark, f"file://{tmp_path}/chain", "b", "n", SCHEMA, table=table, blocks_per_trigger=30, blocks_per_task=8), fresh)
            assert sorted(r.b for r in table.current().collect()) == there
            assert table.log().count() == len(there)
    assert len(list((tmp_path / "t" / "ledger").glob("epoch=*"))) > 4


def test_rows_of_an_epoch_without_a_ledger_come_once(spark, tmp_path):
    table = continuous.ContinuousTable(spark, f"file://{tmp_path}/t")
    grow(spark, tmp_path / "chain", 0, 40)
    run(spark, tmp_path, table, blocks_per_trigger=0)
    shutil.rmtree(tmp_path / "t" / "ledger" / "epoch=0")  # it died between the rows and their batches
    run(spark, tmp_path, table, fresh=True, blocks_per_trigger=0)
    assert table.current().count() == 40 == table.log().count()


def test_positions(spark, tmp_path):
    path, ledger = f"file://{tmp_path}/chain", f"file://{tmp_path}/none"
    grow(spark, tmp_path / "chain", 10, 30)
    assert block_source.highest_block(path, "b") == 29 and block_source.ledger_position(ledger, "n") is None
    reader = block_source.BlockReader({"path": path, "block": "b", "blockspertrigger": "7", "blockspertask": "4", "start": "12"}, SCHEMA)
    assert reader.initialOffset() == {"block": 12} and reader.latestOffset() == {"block": 19}
    assert [(p.start, p.end) for p in reader.partitions({"block": 12}, {"block": 19})] == [(12, 16), (16, 19)]
    assert reader.latestOffset() == {"block": 26} and reader.partitions({"block": 19}, {"block": 19}) == []
    reader.commit({"block": 26})
    assert reader.latestOffset() == {"block": 30}
    with pytest.raises(ValueError):
        block_source.BlockReader({"path": path, "block": "b", "blockspertask": "0"}, SCHEMA)
