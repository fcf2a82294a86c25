"""Lake tables: merge at read, files that changes touch, writers that meet or die, maintenance."""

import json

import pytest
from pyspark.sql import functions as F

from rangeloom.sinks import lake


def rows(spark, *v):
    return spark.createDataFrame([(i, s, i % 2) for i, s in v], "id long, v string, k long")


def held(table, *columns):
    return sorted(tuple(r) for r in table.read().select(*columns).collect())


def scanned(df):
    """Files that the scans of a plan read when it ran."""
    df.collect()
    plan, todo, n = df._jdf.queryExecution().executedPlan(), [], 0
    todo.append(plan)
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.finalPhysicalPlan()
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            n += p.metrics().apply("numFiles").value()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return n


def test_modes(spark, tmp_path):
    table = lake.LakeTable(spark, f"file://{tmp_path}/t", partition_by=["k"], max_rows_per_file=2)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(rows(spark, (1, "a"), (2, "a"), (3, "a")))
    table.write(rows(spark, (2, "b"), (3, "b"), (3, "a"), (4, "b")), "upsert", keys=["id"], order=["v"])
    assert held(table, "id", "v") == [(1, "a"), (2, "b"), (3, "b"), (4, "b")]
    table.write(rows(spark, (5, "c")).withColumn("extra", F.lit(1)))
    assert "extra" in table.read().columns and table.read().count() == 5
    table.write(rows(spark, (2, "d")).drop("v"), "upsert", keys=["id"])
    assert held(table, "id", "v") == [(1, "a"), (2, None), (3, "b"), (4, "b"), (5, "c")]
    assert sorted(r.v for r in table.read(0).collect()) == ["a", "a", "a"]  # an earlier version
    table.write(rows(spark), "overwrite")
    assert table.read().count() == 0 and "id" in table.read().columns
    table.write(rows(spark), "upsert", keys=["id"])
    table.write(rows(spark, (9, "z")), "upsert", keys=["id"])
    assert held(table, "id") == [(9,)]
    for bad in (lambda: table.write(rows(spark, (9, "z")).drop("k")), lambda: table.write(rows(spark, (9, "z")), "other"), lambda: table.write(rows(spark, (9, "z")), "upsert"), lambda: table.read(99)):
        with pytest.raises(ValueError):
            bad()
    strict = lake.LakeTable(spark, f"file://{tmp_path}/s", evolve=False)
    strict.write(rows(spark, (1, "a")))
    audit = lake.load(rows(spark, (2, "b")).withColumn("extra", F.lit(1)), strict, "append", "s").first()
    assert not audit.success and "extra" in audit.error
    assert lake.load(spark.range(7), lake.LakeTable(spark, f"file://{tmp_path}/e"), "overwrite").first().rows == 7


def test_an_upsert_of_few_keys_rewrites_no_file_and_reads_few(spark, tmp_path):
    table = lake.LakeTable(spark, f"file://{tmp_path}/t", keys=["id"], buckets=16)
    for part in range(4):  # later keys in later files
        table.write(spark.range(part * 5000, part * 5000 + 5000).withColumn("v", F.lit("old")))
    before = dict(table._listed(table.state()))
    some = spark.range(15_000, 15_010).select((F.col("id") * 1).alias("id"), F.lit("new").alias("v"))
    assert 0 < len(table.candidates(some)) <= len(before) / 4
    table.write(spark.range(0, 20_000, 100).withColumn("v", F.lit("new")), "upsert")
    after = dict(table._listed(table.state()))
    assert all(after.get(f) == n for f, n in before.items()) and len(before) == 64
    assert table.read().count() == 20_000 and table.read().where("v = 'new'").count() == 200
    table.write(some, "upsert")
    got = table.read().where("v = 'new'").agg(F.count("*"), F.count_distinct("id")).first()
    assert tuple(got) == (209, 209)


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    import random

    r, want = random.Random(4), {}
    tables = [lake.LakeTable(spark, f"file://{tmp_path}/a", keys=["id"], buckets=3), lake.LakeTable(spark, f"file://{tmp_path}/b", partition_by=["k"])]
    for step in range(5):
        part = [(r.randint(0, 30), f"{step}-{j}") for j in range(12)]
        for i, v in sorted(part, key=lambda x: x[1]):
            want[i] = max(v, want[i]) if want.get(i, "").startswith(f"{step}-") else v
        for t in tables:
            t.write(rows(spark, *part), "upsert", keys=["id"], order=["v"])
        if step == 2:
            for t in tables:
                t.compact(1 << 30)
    for t in tables:
        assert {r.id: r.v for r in t.read().collect()} == want


def test_deletion_by_batch_reads_the_files_the_index_names(spark, tmp_path):
    table = lake.LakeTable(spark, f"file://{tmp_path}/t")
    assert table.delete_batches(spark.createDataFrame([("a",)], "batch_id string")) == []
    for n in range(6):
        table.write(spark.createDataFrame([(n * 10 + i, f"b{n}" if i else f"b{n}|c{n}") for i in range(4)], "id long, _batch_id string").coalesce(1))
    before = table.state()["data"]
    assert len(table.delete_batches(spark.createDataFrame([("c3",), ("nothing",)], "batch_id string"))) == 1
    assert len(table.delete_batches(spark.createDataFrame([("b5",), ("b5",)], "batch_id string"))) == 1
    assert [x for (x,) in held(table, "id")] == [n * 10 + i for n in range(6) for i in range(4) if n != 5 and (n, i) != (3, 0)]
    assert table.state()["data"] == before
    files = [f for f, _ in table._listed(table.state())][:2]
    assert scanned(table._scan({**table.state(), "deleted": []}, files)) == 2


def test_two_writers(spark, tmp_path):
    one, two = (lake.LakeTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    one.write(rows(spark, (1, "a"), (2, "a")))
    seen = two.state()
    put = two._put(rows(spark, (3, "c")))
    one.write(rows(spark, (1, "b")), "upsert", keys=["id"])  # meanwhile
    with pytest.raises(RuntimeError, match="another writer"):
        two._commit(seen, lambda s: two._with(s, put))
    two._commit(seen, lambda s: two._with(s, put), again=True)  # an append goes on from the newer version
    assert held(one, "id", "v") == [(1, "b"), (2, "a"), (3, "c")]
    for _ in range(3):
        one.write(rows(spark, (4, "d")), retry_id="load-7")
    assert held(one, "id") == [(1,), (2,), (3,), (4,)]


def test_a_writer_that_dies_blocks_no_one(spark, tmp_path):
    table = lake.LakeTable(spark, f"file://{tmp_path}/t")
    table.write(rows(spark, (1, "a")))
    put = table._put(rows(spark, (2, "lost")))  # data and a draft of the next version, then nothing
    fs, p = table._fs("drafts/dead")
    out = fs.create(p, False)
    out.write(bytearray(json.dumps({"version": 1}).encode()[:5]))
    out.close()
    table.write(rows(spark, (3, "b")), "overwrite")
    table.write(rows(spark, (4, "b")), "upsert", keys=["id"])
    table.write(rows(spark, (5, "b")))
    assert held(table, "id") == [(3,), (4,), (5,)]
    assert table.remove_old() == 0 and table.remove_old(0) > 0
    assert not (tmp_path / "t" / "data" / f"__commit={put['data'][0]}").exists() and table.read().count() == 3


def test_compaction_takes_small_and_worn_files_only(spark, tmp_path):
    table = lake.LakeTable(spark, f"file://{tmp_path}/t", partition_by=["k"])
    table.write(spark.range(20_000).select("id", F.col("id").cast("string").alias("v"), (F.col("id") % 2).alias("k")).coalesce(1))
    large = dict(table._listed(table.state()))
    for n in range(4):
        table.write(rows(spark, *[(100_000 + n * 10 + i, "x") for i in range(3)]).coalesce(1))
    limit = min(large.values())
    went = table.compact(target_bytes=10 * limit, small_bytes=limit)
    assert len(went) == 8 and not set(went) & set(large)
    assert len(table._listed(table.state())) == 4 and set(large) < set(dict(table._listed(table.state())))
    assert table.read().count() == 20_012 and table.compact(10 * limit, limit) == []
    table.write(spark.range(1, 20_000, 2).select("id", F.lit("y").alias("v"), (F.col("id") % 2).alias("k")).where("id < 8000"), "upsert", keys=["id"])
    worn = table.compact(target_bytes=10 * limit, small_bytes=0)
    assert len(worn) == 1 and table.state()["deleted"] == []
    assert table.read().count() == 20_012 and table.read().where("v = 'y'").count() == 4000
    assert table.read(table.versions()[1]).count() == 20_003  # kept versions can still be read
    assert table.remove_old(0) > 0 and len(table.versions()) == 1
    assert table.read().count() == 20_012 and table.remove_old(0) == 0
    assert lake.merged_bins({"d/a": 5, "d/b": 5, "d/c": 9, "d/k=1/a": 1}, 10) == [["d/a", "d/b"]]
