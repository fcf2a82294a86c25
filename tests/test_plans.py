"""What the plans of registered queries must have: filters and columns at the scan, no Python, sized broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from rangeloom.operators import joins
from rangeloom.plans import registered
from rangeloom.sources import chain

FOLDER = "/root/testdata/sf0.001"
LAZY = sorted(set(registered.QUERIES) - {"continuous_load", "hybrid_load", "jdbc_round_trip", "load_audit", "upsert", "partitioned_load_stats", "indexer_output", "derived_dataset", "label_join"} - registered.EAGER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(registered.QUERIES["block_range_filter"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_orderkey,1000)" in p and "LessThan(l_orderkey,5000)" in p
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>", p) or "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,..." in p
    assert "l_shipdate" not in p and "Exchange" not in p


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join_of_tables(spark, name):
    p = plan(registered.QUERIES[name](spark, FOLDER))
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", p)


def test_small_labels_are_broadcast_and_large_ones_are_not(spark, monkeypatch):
    rows = chain.read(spark, FOLDER, "customer")
    sets = registered._nation_labels(spark, FOLDER)
    assert "BroadcastHashJoin" in plan(joins.label_join(rows, sets, "n_nationkey", "c_nationkey"))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in plan(joins.label_join(rows, sets, "n_nationkey", "c_nationkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_windows_run_on_batches(spark):
    p = plan(registered.QUERIES["replay_with_reorgs"](spark, FOLDER))
    assert "Window" in p and not re.search(r"SinglePartition.*event_id", p)


def test_recent_blocks_are_a_literal_at_the_scan(spark):
    p = plan(registered.QUERIES["recent_blocks"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderkey,[0-9]+\)", p) and "Join" not in p


def test_bounds_and_counts_come_from_footers(spark, tmp_path):
    from rangeloom.operators import partition
    from rangeloom.sources import datasets, footers

    spark.range(1000).selectExpr("id AS b", "CAST(id AS STRING) AS s", "CAST(NULL AS INT) AS e").repartition(3).write.parquet(f"file://{tmp_path}/t")
    df = spark.read.parquet(f"file://{tmp_path}/t")
    asked = footers.from_footers(df.select("b"), F.min("b"), F.max("b"), F.count("*"), columns=["b"])
    p = plan(asked)
    assert "PushedAggregation: [MIN(b), MAX(b), COUNT(*)]" in p and "ReadSchema: struct<min(b):bigint,max(b):bigint,count(*):bigint>" in p
    assert footers.bounds(df, "b") == (0, 999, 1000) and footers.bounds(df, "e") == (None, None, 1000) and footers.bounds(df, "s")[1] == "999"
    assert footers.bounds(df.where("b < 10"), "b") == (0, 9, 10) and footers.plain_paths(df.where("b < 10")) is None
    assert footers.plain_paths(df.select((F.col("b") + 1).alias("b"))) is None and footers.plain_paths(spark.range(3)) is None
    assert partition.max_block(df, "b") == 999 and partition.max_block(df.select("b").where("b < 5"), "b") == 4
    got = datasets.table_progress(df, "b").first()
    assert got[:4] == (0, 999, 1000, 3) and got.bytes == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert datasets.table_stats(df).first()[:3] == (1000, 3, 3)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_batch_events_are_decoded_once(spark):
    """No filter that Spark adds for what is exploded decodes the data once more, and data is made once for all that refers to it."""
    p = plan(registered.QUERIES["decode_batch_events"](spark, FOLDER))
    assert not any("transform(" in line for line in p.split("\n") if line.lstrip(" +-:").startswith("Filter"))
    assert p.count("unhex(") < 10


def test_words_of_wide_numbers_are_made_once(spark):
    p = plan(registered.QUERIES["wide_numbers"](spark, FOLDER))
    assert p.count("unhex(") < 10 and p.count("aggregate(transform(") == 1
