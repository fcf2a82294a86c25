import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.operators import kv
from rangeloom.sinks import jdbc
from rangeloom.sources import datasets
from rangeloom.streaming import continuous

MANIFEST = {"kind": "rpc", "network": "n", "tables": {"blocks": {"schema": {"arrow": {"fields": [
    {"name": "block_num", "type": "UInt64", "nullable": False}, {"name": "timestamp", "type": {"Timestamp": ["Nanosecond", "+00:00"]}, "nullable": False},
    {"name": "hash", "type": {"FixedSizeBinary": 32}, "nullable": False}, {"name": "fee", "type": {"Decimal128": [38, 0]}, "nullable": True}, {"name": "missing", "type": "Utf8", "nullable": True},
]}}}}}


def test_declared_datasets(spark, tmp_path):
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    path = tmp_path / "b.parquet"
    t = pa.table({"block_num": pa.array([1, 2**40], pa.uint64()), "timestamp": pa.array([1_700_000_000_000_000_001] * 2, pa.timestamp("ns", "UTC")), "hash": pa.array([b"x" * 32] * 2, pa.binary(32)), "fee": pa.array([1, None], pa.decimal128(38, 0))})
    pq.write_table(t, path)
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", True)
    try:
        df = datasets.read_dataset(spark, MANIFEST, "blocks", f"file://{path}")
        assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "timestamp", "binary", "decimal(38,0)", "string"]
        r = df.orderBy("block_num").collect()
        assert (r[1].block_num, r[0].timestamp, r[0].missing) == (2**40, datetime.datetime(2023, 11, 14, 22, 13, 20), None)
        pq.write_table(t.set_column(0, "block_num", pa.array([2**63, 1], pa.uint64())), path)
        with pytest.raises(Exception, match="beyond 63 bits"):
            datasets.read_dataset(spark, MANIFEST, "blocks", f"file://{path}").collect()
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    found = datasets.describe_tables(spark, {"blocks": datasets.declared_schema(MANIFEST, "blocks")})
    assert [r.column for r in found.where("type = 'binary'").collect()] == ["hash"]


def test_derived_datasets(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "block_num long, v string")
    df, manifest = datasets.register_derived(spark, "d", "SELECT block_num, v FROM eth.blocks WHERE block_num > 1", {"eth": {"blocks": rows}}, {"eth": "_/eth@1.0.0"}, f"file://{tmp_path}/d")
    assert df.count() == 1 and json.loads(json.dumps(manifest))["dependencies"] == {"eth": "_/eth@1.0.0"}
    assert datasets.declared_schema(manifest, "d") == df.schema
    assert [f.name for f in datasets.output_schema(spark, "SELECT 1 AS x", True)] == ["_block_num", "x"]
    assert [b.num_rows for b in datasets.stream_batches(spark.range(25).coalesce(1), 10)] == [10, 10, 5]
    got = datasets.collect_table(spark.range(25))
    assert got.num_rows == 25 and sorted(got.column("id").to_pylist()) == list(range(25))
    with pytest.raises(ValueError):
        datasets.collect_table(spark.range(100_000), 1000)
    assert datasets.adhoc_select(rows, ["v"], "block_num = 2").first()[0] == "b"


def test_definitions():
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("l", T.ArrayType(T.IntegerType())), T.StructField("d", T.DecimalType(10, 2)), T.StructField("t", T.TimestampType())])
    assert jdbc.create_table("postgresql", "x", schema, True) == ['CREATE TABLE IF NOT EXISTS "x" ("id" BIGINT NOT NULL, "l" TEXT, "d" NUMERIC(10,2), "t" TIMESTAMPTZ, "_batch_id" TEXT)', 'CREATE INDEX IF NOT EXISTS "x_batch" ON "x" ("_batch_id")']
    assert "Array(Int32)" in jdbc.create_table("clickhouse", "x", schema)[0] and "Nullable(Decimal(10,2))" in jdbc.create_table("clickhouse", "x", schema)[0]
    assert "VARIANT" in jdbc.create_table("snowflake", "x", schema)[0] and "list<int>" in jdbc.create_table("iceberg", "x", schema)[0]


def test_jdbc(spark, tmp_path):
    table = jdbc.JdbcTable(spark, f"jdbc:derby:{tmp_path}/db;create=true", "t", jdbc.DERBY)
    table.write(spark.range(5), "overwrite")
    table.write(spark.range(2), "append")
    assert table.read().count() == 7
    assert datasets.jdbc_schema(spark, f"jdbc:derby:{tmp_path}/db", "t", jdbc.DERBY)[0].dataType == T.LongType()
    with pytest.raises(ValueError):
        table.write(spark.range(1), "upsert")


def test_transactional_loads(spark, tmp_path):
    table = jdbc.JdbcTable(spark, f"jdbc:derby:{tmp_path}/db;create=true", "t", jdbc.DERBY, column_types="_batch_id VARCHAR(100)")
    rows = spark.range(6).repartition(3).selectExpr("id", "CAST(concat('b', id div 2) AS STRING) AS _batch_id")
    held = lambda: sorted((r.id, r._batch_id) for r in table.read().collect())
    # a task that committed its rows and runs again: an attempt more of a partition, and then of all of them
    table._loaded("a")
    rows.limit(0).write.options(**table.options).jdbc(table.url, table.table, "append", table.properties)
    stage = table._stage(rows, "a")
    table._stage(rows, "a", "append")
    assert spark.read.jdbc(table.url, stage, properties=table.properties).count() == 12
    table._merge(stage, "a", rows.columns, [], [])
    assert held() == [(i, f"b{i // 2}") for i in range(6)]
    assert not table.load(rows, "a") and len(held()) == 6
    # a load that fails inside its transaction leaves nothing, and its next try all
    broken = spark.range(3).selectExpr("id + 100 AS id", "'x' AS _batch_id", "1 AS extra")
    with pytest.raises(Exception, match="EXTRA|extra"):
        table.load(broken, "b", void_batches=["b0"])
    assert len(held()) == 6 and table.load(broken.drop("extra"), "b", void_batches=["b0", "b2"])
    assert held() == [(2, "b1"), (3, "b1"), (100, "x"), (101, "x"), (102, "x")]
    assert table.load(spark.range(3, 5).selectExpr("id", "'n|b1' AS _batch_id"), "c", keys=["id"])
    assert held()[:3] == [(2, "b1"), (3, "n|b1"), (4, "n|b1")]
    write = table.epoch_writer("stream", keys=["id"])
    for epoch in (0, 0, 1, 1):
        write(spark.range(200 + epoch, 202 + epoch).selectExpr("id", "'s' AS _batch_id"), epoch)
    assert [i for i, b in held() if b == "s"] == [200, 201, 202]
    assert table.load(rows.limit(0), "d", void_batches=["b1"]) and [i for i, b in held() if "b1" in b] == []


def test_key_values(spark):
    df = spark.createDataFrame([(1, "a", True, None), (1, "b", None, 2.0)], "id long, v string, f boolean, x double")
    hashes = [r.fields for r in kv.kv_hash(df, F.col("id").cast("string"), ["v", "f", "x"]).collect()]
    assert hashes == [{"v": "a", "f": "1"}, {"v": "b", "x": "2.0"}]
    assert kv.kv_json(df, F.col("id").cast("string"), F.col("v"), ["v"]).collect()[0].value == '{"v":"b"}'
    assert kv.kv_list(df, F.col("id"), F.col("v"), ["v"]).first()["values"] == ['{"v":"a"}', '{"v":"b"}']
    assert kv.kv_set(df).count() == 2 and kv.kv_rows(df, F.col("id")).first().value.v == "a"
    late = kv.with_expiry(df, 60)
    assert kv.unexpired(late).count() == 2 and kv.unexpired(late, F.current_timestamp() + F.expr("interval 2 minutes")).count() == 0


def test_streams(spark, tmp_path):
    rng = lambda a, z, h: json.dumps({"ranges": [{"network": "n", "numbers": {"start": a, "end": z}, "hash": h}], "ranges_complete": True})
    schema = T.StructType([T.StructField("b", T.LongType())])
    source = f"file://{tmp_path}/src"

    def deliver(rows):
        spark.createDataFrame(rows, "b long, _seq long, _metadata_json string, _notice boolean").coalesce(1).write.mode("append").parquet(source)

    deliver([(1, 1, rng(1, 2, "a"), False), (2, 1, rng(1, 2, "a"), False), (3, 2, rng(3, 4, "b"), False)])
    table = continuous.ContinuousTable(spark, f"file://{tmp_path}/t")

    def run():
        return continuous.await_load(table.start(continuous.read_block_stream(spark, source, schema, 1), available_now=True))

    assert run()
    assert sorted(r.b for r in table.current().collect()) == [1, 2, 3]
    deliver([(33, 3, rng(3, 5, "c"), False), (7, 4, "broken", False)])
    assert run()
    assert sorted(r.b for r in table.current().collect()) == [1, 2, 33]
    deliver([(0, 5, rng(2, 2, None), True)])
    assert run()
    assert table.current().count() == 0 and table.log().count() == 5
    history = spark.range(1, 11).withColumnRenamed("id", "b")
    live = continuous.ContinuousTable(spark, f"file://{tmp_path}/live")
    counts, q = continuous.hybrid_load(history, "b", "n", 1, f"file://{tmp_path}/h", live, continuous.read_block_stream(spark, source, schema), buffer=8, workers=2)
    assert continuous.await_load(q) and sum(r.rows for r in counts.collect()) == 10
    assert continuous.combined(history, live.log().select("b"), ["b"]).where("b <= 10").count() == 10
