"""Contract cases of block ranges, ledgers, reorganisations, labels, partitions and merges."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rangeloom.functions import ranges
from rangeloom.operators import joins, ledger, merge, partition, reorg
from rangeloom.sources.labels import LabelRegistry, as_labels, read_labels

RANGES = "_seq long, network string, start long, end long, hash string, prev_hash string"


def table(spark, rows, schema=RANGES):
    return spark.createDataFrame(rows, schema)


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def python_id(network, start, end, hash_=None, prev=None):
    bounds = f"{network}:{start}:{end}"
    end_hash = hash_ or hashlib.sha256(bounds.encode()).hexdigest()
    return hashlib.sha256(f"{bounds}:{end_hash}:{prev or ''}".encode()).hexdigest()[:16]


def batches(spark, rows):
    """rows: (seq, [(network, start, end, hash)], complete, notice)"""
    data = [(s, [(n, a, z, h, None) for n, a, z, h in r], c, v) for s, r, c, v in rows]
    return spark.createDataFrame(data, "_seq long, _ranges array<struct<network:string,start:long,end:long,hash:string,prev_hash:string>>, _ranges_complete boolean, _notice boolean")


def test_batch_ids(spark):
    rows = [(1, "eth", 1, 9, None, None), (2, "eth", 1, 9, "", "p"), (3, "poly", 0, 0, "h", None)]
    got = [r.batch_id for r in reorg.range_ids(table(spark, rows)).orderBy("_seq").collect()]
    assert got == [python_id(*r[1:]) for r in rows]
    with pytest.raises(Exception, match="ends before"):
        reorg.range_ids(table(spark, [(1, "eth", 9, 1, None, None)])).collect()


def test_range_json(spark):
    text = ['{"network":"a","numbers":{"start":1,"end":2},"hash":"h","prev_hash":"p"}', '{"network":"a","start":3,"end":4}', "no json"]
    got = spark.createDataFrame([(t,) for t in text], "t string").select(ranges.parse_range(F.col("t")).alias("r")).collect()
    assert [tuple(r.r) if r.r and r.r.network else None for r in got] == [("a", 1, 2, "h", "p"), ("a", 3, 4, None, None), None]
    found, complete = ranges.parse_metadata(F.col("t"))
    meta = spark.createDataFrame([('{"ranges":[{"network":"a","numbers":{"start":1,"end":2}}],"ranges_complete":true}',), ("broken",), (None,)], "t string").select(found.alias("r"), complete.alias("c")).collect()
    assert [(len(r.r), r.c) for r in meta] == [(1, True), (0, False), (0, False)]
    one = spark.range(1).select(ranges.make_range(F.lit("a"), F.lit(1), F.lit(2)).alias("r"))
    assert one.select(ranges.range_to_json(F.col("r"))).first()[0] == '{"network":"a","start":1,"end":2}'
    assert one.select(ranges.ranges_json(F.array("r"))).first()[0] == '[{"network":"a","start":1,"end":2,"hash":null,"prev_hash":null}]'
    assert one.select(ranges.contains_block(F.col("r"), F.lit(2)), ranges.contains_block(F.col("r"), F.lit(3))).first()[:] == (True, False)


def test_reorg_detection(spark):
    rows = [(1, "eth", 100, 200, "a", None), (2, "poly", 50, 150, "b", None), (3, "eth", 180, 280, "c", None), (4, "poly", 151, 250, "d", None)]
    assert values(reorg.detect_reorgs(table(spark, rows)), "network", "start", "end") == [("eth", 180, 280)]
    three = [(1, "eth", 100, 200, "a", None), (1, "poly", 50, 150, "b", None), (1, "arb", 500, 600, "c", None), (2, "eth", 150, 250, "d", None), (2, "poly", 140, 240, "e", None), (2, "arb", 601, 700, "f", None)]
    assert values(reorg.detect_reorgs(table(spark, three)), "network", "start", "end") == [("eth", 150, 250), ("poly", 140, 240)]
    same = [(1, "eth", 100, 200, None, None), (2, "eth", 100, 200, None, None)]
    assert not reorg.detect_reorgs(table(spark, same)).collect()
    assert values(reorg.detect_duplicates(table(spark, same)), "_seq") == [(2,)]
    assert values(reorg.detect_reorgs(table(spark, [(1, "eth", 100, 300, "a", None), (2, "eth", 250, 280, "b", None)])), "start", "end") == [(250, 300)]


def rows_of(spark, found):
    """found: (rows, [(network, start, end)]) for each batch; rows with their id list, and the ledger."""
    data, marks = [], []
    for n, own in found:
        data += [("|".join(python_id(*r) for r in own),)] * n
        marks += [(net, a, z, python_id(net, a, z)) for net, a, z in own]
    return spark.createDataFrame(data, "_batch_id string"), spark.createDataFrame(marks, "network string, start long, end long, batch_id string")


def test_reorg_deletion(spark):
    data, marks = rows_of(spark, [(3, [("eth", 100, 102)]), (2, [("eth", 103, 104)]), (2, [("eth", 105, 106)]), (2, [("eth", 107, 108)])])
    left, kept = reorg.apply_reorg(data, marks, "eth", 104)
    assert left.count() == 3 and values(kept, "start") == [(100,)]
    data, marks = rows_of(spark, [(3, [("eth", 150, 175)])])
    assert reorg.apply_reorg(data, marks, "eth", 160)[0].count() == 0
    data, marks = rows_of(spark, [(1, [("eth", 100, 100)]), (1, [("poly", 100, 100)]), (2, [("eth", 90, 100), ("poly", 90, 100)])])
    assert reorg.apply_reorg(data, marks, "eth", 100)[0].count() == 1


def test_microbatches(spark):
    r = [("eth", 100, 110, "h")]
    three = [(1, r, False, False), (2, r, False, False), (3, r, True, False)]
    assert values(reorg.published(batches(spark, three)), "_seq") == [(1,), (2,), (3,)]
    again = [*three, (4, r, True, False)]
    assert values(reorg.published(batches(spark, again)), "_seq") == [(1,), (2,), (3,)]
    assert not reorg.published(batches(spark, three[:2])).collect()


def simulate(rows):
    """The rules one batch after the other: what is stored after the stream."""
    stored, pending, prev, key, done = [], [], {}, None, False
    for seq, r, complete, notice in rows:
        def void(network, start):
            nonlocal stored, pending, key
            hit = lambda b: any(n == network and z >= start for n, _, z, _ in b[1])
            stored, pending = [b for b in stored if not hit(b)], [b for b in pending if not hit(b)]
            if key is not None and any(n == network and z >= start for n, _, z, _ in key):
                key = None

        if notice:
            for n, a, _, _ in r:
                void(n, a)
            continue
        goes_on = key is not None and key == r and all(prev.get(n) == (n, a, z, h) for n, a, z, h in r)
        for n, a, z, h in r:
            p = prev.get(n)
            if p is not None and p != (n, a, z, h) and a <= p[2]:
                void(n, a)
        for x in r:
            prev[x[0]] = x
        if not goes_on:
            pending, done = [], False
        key = r
        if done:
            continue
        pending.append((seq, r))
        if complete:
            stored, pending, done = stored + pending, [], True
    return sorted(s for s, _ in stored)


@pytest.mark.parametrize("seed", range(6))
def test_replay_equals_a_simulation(spark, seed):
    r = random.Random(seed)
    rows, at = [], {"a": 0, "b": 0}
    for seq in range(120):
        kind = r.random()
        if rows and kind < 0.25:  # the last batch again, or another part of it
            last = next((x for x in reversed(rows) if not x[3]), None)
            if last:
                rows.append((seq, last[1], r.random() < 0.5, False))
                continue
        if kind < 0.35:
            n = r.choice("ab")
            start = max(0, at[n] - r.randint(0, 12))
            rows.append((seq, [(n, start, start, None)], True, True))
            at[n] = start
            continue
        own = []
        for n in ("a", "b") if r.random() < 0.3 else (r.choice("ab"),):
            start = at[n] if r.random() < 0.75 else max(0, at[n] - r.randint(1, 15))
            end = start + r.randint(0, 6)
            own.append((n, start, end, r.choice([None, f"h{seq}"])))
            at[n] = end + 1
        rows.append((seq, own, r.random() < 0.7, False))
    for bucket in (reorg.BUCKET, 7):
        got = [x for (x,) in values(reorg.published(batches(spark, rows), bucket), "_seq")]
        assert got == simulate(rows)


@pytest.mark.parametrize("seed", range(3))
def test_first_voids_equal_a_search(spark, seed):
    r, rows, at = random.Random(seed), [], {"a": 0, "b": 0}
    for seq in range(80):
        n = r.choice("ab")
        start = at[n] if r.random() < 0.7 else max(0, at[n] - r.randint(1, 40))
        end = start + r.randint(0, 6)
        rows.append((seq, n, start, end, f"h{seq}", None))
        at[n] = end + 1
    voids, last = [], {}
    for seq, n, a, z, _, _ in rows:
        if n in last and a <= last[n]:
            voids.append((seq, n, a))
        last[n] = z
    want = sorted((s, n, a, z, min(v for v, m, b in voids if m == n and v > s and b <= z)) for s, n, a, z, _, _ in rows if any(m == n and v > s and b <= z for v, m, b in voids))
    for size, bucket in ((1000, 1 << 20), (5, 9)):
        got = values(reorg.first_voided_by(table(spark, rows), size, bucket), "_seq", "network", "start", "end", "by_seq")
        assert sorted(got) == want and want


def test_history(spark):
    rows = spark.createDataFrame([("a", True, None), ("b|c", True, None), ("d", False, "old"), ("b", False, "old")], "_batch_id string, _is_current boolean, _reorg_batch_id string")
    out = reorg.mark_superseded(rows, spark.createDataFrame([("c", "r"), ("b", "s"), ("d", "s")], "batch_id string, by string"), "by")
    assert sorted(map(tuple, out.collect())) == [("a", True, None), ("b", False, "old"), ("b|c", False, "r"), ("d", False, "old")]
    current, history = reorg.history_views(out, "t")
    assert spark.table("t_current").count() == current.count() == 1 and spark.table("t_history").count() == history.count() == 4


def test_gaps_and_resume(spark):
    led = table(spark, [(1, "eth", 0, 100, None, None), (2, "eth", 200, 300, None, None), (3, "eth", 500, 600, None, None)])
    for bucket in (1 << 20, 64, 1):
        assert values(ledger.detect_gaps(led, bucket), "gap_start", "gap_end") == [(101, 199), (301, 499)]
    assert values(ledger.resume_position(led, True), "start", "end", "is_gap") == [(101, 199, True), (301, 499, True), (601, 601, False)]
    over = table(spark, [(1, "eth", 0, 1000, None, None), (2, "eth", 1100, 1200, None, None), (3, "eth", 1050, 1300, None, None)])
    assert values(ledger.detect_gaps(over), "gap_start", "gap_end") == [(1001, 1049)]
    assert values(ledger.resume_plan(led, 700, size=100), "start_block", "end_block", "priority") == [(101, 200, 0), (301, 401, 0), (401, 500, 0), (601, 700, 1)]
    assert values(ledger.resume_plan(led, 700, workers=3), "start_block", "end_block", "priority") == [(101, 200, 0), (301, 500, 0), (601, 634, 1), (634, 667, 1), (667, 700, 1)]
    assert values(ledger.resume_plan(led, 500, size=1000), "priority") == [(0,), (0,)]
    assert values(ledger.max_position(led), "start", "end") == [(500, 600)]


def test_state(spark):
    led = spark.createDataFrame([("c", "t", "eth", "a", 0, 9), ("c", "t", "poly", "b", 0, 9)], "connection string, table string, network string, batch_id string, start long, end long")
    data = spark.createDataFrame([("a",), ("a|b",), ("a|x",), ("x",)], "_batch_id string")
    assert values(ledger.unprocessed_batches(data, led), "_batch_id") == [("a|x",), ("x",)]
    new = led.withColumn("_ranges_complete", F.lit(True)).unionByName(led.withColumn("batch_id", F.lit("n")).withColumn("_ranges_complete", F.col("network") == "eth"))
    assert values(ledger.mark_processed(led, new), "network", "batch_id") == [("eth", "a"), ("eth", "n"), ("poly", "b")]
    kept, removed = ledger.invalidate_from(led, "eth", 9)
    assert values(kept, "network") == [("poly",)] and values(removed, "network") == [("eth",)]
    assert ledger.cleanup_before(led, "eth", 10).count() == 1


@pytest.mark.parametrize("start,end,size,workers,want", [(0, 100, None, 4, 4), (0, 100, 30, None, 4), (7, 10, None, 8, 3), (1000, 1001, None, 1, 1), (5, 105, 100, None, 1), (0, 10, None, 3, 3)])
def test_partitions(spark, start, end, size, workers, want):
    parts = values(partition.block_partitions(spark, start, end, size, workers), "start_block", "end_block")
    assert len(parts) == want and parts[0][0] == start and parts[-1][1] == end
    assert all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False)) and all(a < z for a, z in parts)


def test_partition_errors_and_bounds(spark):
    for bad in ((5, 5, 1, None), (0, 9, 0, None), (0, 9, None, 0), (0, 9, None, None)):
        with pytest.raises(ValueError):
            partition.partition_size(*bad)
    df = spark.range(100, 1000).withColumnRenamed("id", "b")
    assert partition.max_block(df, "b") == 999 and partition.recent_range(df, "b", 50) == (949, 999)
    assert partition.recent_blocks(df, "b", 50).count() == 51
    assert [partition.resolve_end(df, "b", x) for x in (None, "latest", "-100", "500")] == [None, 999, 899, 500]
    assert partition.from_block(df, "b", 0, 999, 200).count() == 201
    with pytest.raises(ValueError):
        partition.max_block(df.limit(0), "b")
    counts = partition.partitioned_load(df, "b", "t", 100, 1000, size=400)
    assert values(counts, "part", "rows", "first_block", "last_block") == [(0, 400, 100, 499), (1, 400, 500, 899), (2, 100, 900, 999)]
    assert {r._batch_id for r in counts.collect()} == {python_id("t", 100, 499), python_id("t", 500, 899), python_id("t", 900, 999)}
    audit = spark.createDataFrame([(10, 2.0, True), (30, 3.0, True), (5, 1.0, False)], "rows long, seconds double, success boolean")
    assert partition.partition_totals(audit).first()[:] == (40, 6.0, 2, 1, 7.5)


def test_label_join(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text("token_address,symbol,decimals\n0x" + "a0" * 20 + ",USDC,6\n0x" + "C0" * 20 + ",WETH,18\n0x" + "d0" * 20 + ",DAI,18\n")
    sets = read_labels(spark, f"file://{path}")
    data = spark.createDataFrame([(bytearray(b"\xa0" * 20), 100), (bytearray(b"\xc0" * 20), 200), (bytearray(b"\xff" * 20), 300)], "address binary, amount long")
    out = joins.label_join(data, sets, "token_address", "address")
    assert out.columns == ["address", "amount", "symbol", "decimals"]
    assert values(out, "amount", "symbol", "decimals") == [(100, "USDC", "6"), (200, "WETH", "18")]
    assert out.schema["decimals"].dataType.simpleString() == "string"
    as_text = data.withColumn("address", F.concat(F.lit("0x"), F.hex("address")))
    assert values(joins.label_join(as_text, sets, "token_address", "address"), "amount") == [(100,), (200,)]
    text_keys = as_labels(sets.select(F.lower(F.hex("token_address")).alias("key"), "symbol"))
    assert values(joins.label_join(data, text_keys, "key", "address"), "symbol") == [("USDC",), ("WETH",)]
    with pytest.raises(ValueError):
        joins.label_join(data, sets, "none", "address")
    with pytest.raises(ValueError):
        joins.label_join(data, sets, "token_address", "none")
    with pytest.raises(Exception, match="not hex"):
        as_labels(spark.createDataFrame([("zz",)], "address string")).collect()
    assert as_labels(sets, ["nothing"]).schema["token_address"].dataType.simpleString() == "string"


def test_label_registry(spark):
    reg = LabelRegistry(spark)
    reg.clear()
    reg.add("a", as_labels(spark.createDataFrame([("k", "v")], "key string, v string")))
    reg.add("b", as_labels(spark.createDataFrame([("k", "w")], "key string, v string")))
    reg.add("a", as_labels(spark.createDataFrame([("k", "x")], "key string, v string")))
    assert reg.names() == ["a", "b"] and reg.get("a").first().v == "x"
    assert reg.remove("b") and not reg.remove("b")
    with pytest.raises(KeyError):
        reg.get("b")
    reg.clear()
    assert reg.names() == []


def test_merges(spark):
    a, b = spark.createDataFrame([(i, "old", i) for i in (1, 2, 3)], "id long, v string, at long"), spark.createDataFrame([(2, "new", 1), (3, "first", 1), (3, "new", 2), (4, "new", 1)], "id long, v string, at long")
    assert values(merge.upsert(a, b, ["id"], ["at"]), "id", "v") == [(1, "old"), (2, "new"), (3, "new"), (4, "new")]
    assert merge.upsert_counts(a, b, ["id"]).first()[:] == (2, 1)
    added, rejected = merge.insert_if_absent(a, b, ["id"], ["at"])
    assert values(added, "id", "v") == [(1, "old"), (2, "old"), (3, "old"), (4, "new")] and values(rejected, "id", "v") == [(2, "new"), (3, "first"), (3, "new")]
    assert values(merge.first_per_key(b, ["id"], ["at"]), "id", "v") == [(2, "new"), (3, "first"), (4, "new")]
    wide = b.withColumn("extra", F.lit(1))
    assert merge.evolve_schema(a, wide).columns == ["id", "v", "at", "extra"]
    with pytest.raises(ValueError):
        merge.check_schema(a, wide)
    assert merge.check_schema(wide, a) == ["extra"]
