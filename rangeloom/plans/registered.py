"""Every registered query over the given tables and, where SQL can express it, the SQL that must give the same rows."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions import encoding, evm, ranges
from rangeloom.operators import analytics, joins, kv, ledger, merge, partition, reorg, text_index, vectors
from rangeloom.sinks import jdbc, lake
from rangeloom.sources import abi, chain, datasets, labels
from rangeloom.sources.chain import read
from rangeloom.streaming import continuous

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-shared-', dir='/tmp')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


# --- scans, projections, partitions -------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey >= 1000 AND l_orderkey < 5000")
def block_range_filter(spark, d):
    return partition.in_range(read(spark, d, "lineitem"), "l_orderkey", 1000, 5000).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= (SELECT greatest(0, max(o_orderkey) - 1000) FROM orders)")
def recent_blocks(spark, d):
    return partition.recent_blocks(read(spark, d, "orders"), "o_orderkey", 1000).select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, count(*) AS tx_count FROM lineitem GROUP BY l_orderkey")
def tx_per_block(spark, d):
    return analytics.tx_per_block(read(spark, d, "lineitem"), "l_orderkey")


@query(
    "WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) + 1 AS hi FROM orders), s AS (SELECT lo, hi, (hi - lo + 15) // 16 AS step FROM b) "
    "SELECT i AS part, lo + i * step AS start_block, least(lo + (i + 1) * step, hi) AS end_block FROM s, range(0, 16) t(i) WHERE lo + i * step < hi"
)
def block_partitions(spark, d):
    bounds = read(spark, d, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return partition.block_partitions(spark, bounds[0], bounds[1] + 1, workers=16)


@query(
    "WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) + 1 AS hi FROM lineitem), s AS (SELECT lo, hi, (hi - lo + 7) // 8 AS step FROM b) "
    "SELECT (l_orderkey - lo) // step AS part, count(*) AS row_count, min(l_orderkey) AS first_block, max(l_orderkey) AS last_block FROM lineitem, s GROUP BY 1"
)
def partitioned_load_stats(spark, d):
    li = read(spark, d, "lineitem")
    b = li.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    out = partition.partitioned_load(li.select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey", "lineitem", b[0], b[1] + 1, scratch(spark, "load"), workers=8)
    return out.select("part", F.col("rows").alias("row_count"), "first_block", "last_block")


@query("SELECT min(o_orderkey) AS start_block, max(o_orderkey) AS current_block, count(*) AS \"rows\", count(DISTINCT o_orderkey % 3) AS files, true AS bytes_agree FROM orders")
def table_progress(spark, d):
    """A table in a folder for each remainder of three; its bytes are those of the files of its folders."""
    path = scratch(spark, "progress")
    read(spark, d, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % 3).alias("part")).repartition("part").write.partitionBy("part").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    size = sum(x.getLen() for part in fs.listStatus(folder) if part.isDirectory() for x in fs.listStatus(part.getPath()) if x.getPath().getName().endswith(".parquet"))
    return datasets.table_progress(spark.read.parquet(path), "o_orderkey").withColumn("bytes_agree", F.col("bytes") == size).drop("bytes")


@query("SELECT count(*) AS \"rows\", 6 AS \"columns\", count(DISTINCT o_orderkey) AS \"keys\", count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders")
def table_stats(spark, d):
    o = read(spark, d, "orders")
    known = datasets.table_stats(o).select("rows", "columns")
    return known.join(merge.distinct_check(o, "o_orderkey"), "rows")


@query("SELECT o_orderpriority, count(*) AS \"rows\", 2 AS \"columns\", count(DISTINCT o_orderstatus) AS files FROM orders GROUP BY 1")
def table_files(spark, d):
    """Rows and files of a table for each priority, with a file for each status."""
    path, out = scratch(spark, "files"), None
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o.repartition("o_orderpriority", "o_orderstatus").write.partitionBy("o_orderpriority", "o_orderstatus").parquet(path)
    for (p,) in o.select("o_orderpriority").distinct().collect():  # a table each
        t = spark.read.parquet(f"{path}/o_orderpriority={p}")
        row = datasets.table_stats(t).select(F.lit(p).alias("o_orderpriority"), "rows", "columns", "files")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "SELECT o_orderkey AS block_num, c_custkey AS customer, c_mktsegment AS segment, CAST(round(o_totalprice * 100) AS BIGINT) AS cents "
    "FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000"
)
def derived_dataset(spark, d):
    sql = (
        "SELECT o_orderkey AS block_num, c_custkey AS customer, c_mktsegment AS segment, CAST(round(o_totalprice * 100) AS BIGINT) AS cents "
        "FROM shop.orders JOIN shop.customer ON o_custkey = c_custkey WHERE o_totalprice > 200000"
    )
    path = scratch(spark, "derived")
    _, manifest = datasets.register_derived(spark, "large_orders", sql, {"shop": {"orders": read(spark, d, "orders"), "customer": read(spark, d, "customer")}}, path=path)
    return datasets.read_dataset(spark, manifest, "large_orders", path)


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size > 10")
def adhoc_select(spark, d):
    return datasets.adhoc_select(read(spark, d, "part"), ["p_partkey", "p_name", "p_retailprice"], "p_size > 10", None)


# --- joins --------------------------------------------------------------------------------------------------------

_LABELS = "SELECT c_custkey, c_name, c_acctbal, CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"


def _nation_labels(spark, d):
    return labels.as_labels(read(spark, d, "nation").select("n_nationkey", "n_name"))


@query("SELECT c_custkey, c_name, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 20")
def label_join(spark, d):
    """A label set written as CSV and read back as text; customers of nations without a label drop."""
    path = scratch(spark, "labels")
    read(spark, d, "nation").where("n_nationkey < 20").select("n_nationkey", "n_name").write.option("header", True).csv(path)
    rows = read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return joins.label_join(rows, labels.read_labels(spark, path), "n_nationkey", "c_nationkey")


@query("SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def label_join_lines(spark, d):
    """Order lines with the supplier's label."""
    sets = labels.as_labels(read(spark, d, "supplier").select("s_suppkey", "s_name"))
    return joins.label_join(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), sets, "s_suppkey", "l_suppkey").drop("l_suppkey")


@query(
    "SELECT n_name, c_mktsegment, count(*) AS row_count FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "GROUP BY 1, 2 ORDER BY row_count DESC, n_name, c_mktsegment LIMIT 10"
)
def top_labels(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    rows = joins.enrich_inner(read(spark, d, "orders").select("o_custkey"), c, "o_custkey")
    return analytics.top_labels(joins.label_join(rows, _nation_labels(spark, d), "n_nationkey", "c_nationkey"), ["n_name", "c_mktsegment"])


@query("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON unhex(printf('%040x', o_custkey)) = unhex(printf('%040x', c_custkey))")
def hex_key_join(spark, d):
    """Orders with the customer's address as hex text, labels with it as bytes."""
    address = lambda c: F.concat(F.lit("0x"), F.lower(F.lpad(F.hex(c), 40, "0")))
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey", address("o_custkey").alias("owner"))
    sets = labels.as_labels(read(spark, d, "customer").select(address("c_custkey").alias("address"), "c_mktsegment"))
    return joins.label_join(rows, sets, "address", "owner").drop("owner")


@query("SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey")
def enrich_inner(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return joins.enrich_inner(read(spark, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey")


@query(
    "WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n_errors FROM events WHERE event_type = 'error' GROUP BY 1) "
    "SELECT event_id, event_type, n_errors FROM events LEFT JOIN h ON date_trunc('hour', ts) = hour"
)
def enrich_left_hourly(spark, d):
    e = read(spark, d, "events")
    hourly = e.where("event_type = 'error'").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n_errors"))
    return joins.enrich_left_hourly(e.select("event_id", "event_type", "ts"), hourly, "ts", "hour").select("event_id", "event_type", "n_errors")


# --- batches and ranges in SQL ------------------------------------------------------------------------------------

_BLOCKS = "blocks AS (SELECT event_id, user_id, value, ts, event_type AS network, event_id // 10 AS block_num, (event_id // 10) // 10 AS slot FROM events)"
_BATCHES = f"WITH {_BLOCKS}, batches AS (SELECT network, slot, min(block_num) AS \"start\", max(block_num) AS \"end\", 'h' || network || min(block_num) AS hash FROM blocks GROUP BY 1, 2)"
_IDS = (
    ", ids AS (SELECT *, substr(sha256(network || ':' || \"start\" || ':' || \"end\" || ':' || hash || ':'), 1, 16) AS batch_id FROM batches)"
)
_PLACES = ", places AS (SELECT network, dense_rank() OVER (ORDER BY network) AS n FROM (SELECT DISTINCT network FROM batches))"
_STREAM = (
    _PLACES + ", two AS (SELECT network, slot, \"start\", \"end\", hash, 0 AS turn FROM batches UNION ALL "
    "SELECT network, slot, greatest(\"start\" - 5, 0), \"end\", 'r' || network || greatest(\"start\" - 5, 0), 1 FROM batches WHERE slot % 7 = 3), "
    "stream AS (SELECT two.*, (slot * 2 + turn) * 1000 + n AS _seq FROM two JOIN places USING (network)), "
    "seen AS (SELECT *, lag(\"start\") OVER w AS p_start, lag(\"end\") OVER w AS p_end, lag(hash) OVER w AS p_hash FROM stream WINDOW w AS (PARTITION BY network ORDER BY _seq)), "
    "voids AS (SELECT _seq, network, \"start\", greatest(\"end\", p_end) AS \"end\" FROM seen WHERE (\"start\", \"end\", hash) IS DISTINCT FROM (p_start, p_end, p_hash) AND \"start\" <= p_end)"
)


@query(_BATCHES + _IDS + " SELECT network, \"start\", \"end\", batch_id FROM ids")
def batch_ids(spark, d):
    return reorg.range_ids(chain.batches(spark, d)).select("network", "start", "end", "batch_id")


@query(_BATCHES + _IDS + " SELECT batch_id AS _batch_id, count(*) AS row_count FROM blocks JOIN ids USING (network, slot) GROUP BY 1")
def rows_per_batch(spark, d):
    return analytics.rows_per_batch(_identified(spark, d))


def _identified(spark, d) -> DataFrame:
    """Events with the id of their batch."""
    b = chain.batches(spark, d).select("network", "slot", F.array(ranges.make_range("network", "start", "end", "hash", "prev_hash")).alias("_ranges"))
    return reorg.add_batch_columns(chain.blocks(spark, d).join(b, ["network", "slot"])).drop("_ranges")


@query(
    _BATCHES + ", w AS (SELECT network, greatest(\"start\" - 3, 0) AS \"start\", \"end\" + 3 AS \"end\" FROM batches) "
    "SELECT a.network, a.\"start\" AS a_start, a.\"end\" AS a_end, b.\"start\" AS b_start, b.\"end\" AS b_end FROM w a JOIN batches b ON a.network = b.network AND NOT (a.\"end\" < b.\"start\" OR b.\"end\" < a.\"start\")"
)
def range_overlap(spark, d):
    b = chain.batches(spark, d)
    wide = b.select("network", F.greatest(F.col("start") - 3, F.lit(0)).alias("start"), (F.col("end") + 3).alias("end"))
    return reorg.range_overlaps(wide, b, 10)


@query(
    _BATCHES + " SELECT network, min(\"start\") AS \"start\", max(\"end\") AS \"end\", max_by(hash, \"end\") AS hash FROM batches GROUP BY network"
)
def merge_ranges(spark, d):
    return reorg.merge_ranges(chain.batches(spark, d).withColumn("_seq", F.col("slot"))).drop("prev_hash")


@query(
    _BATCHES + _IDS + " SELECT network, \"start\", \"end\", hash, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY network ORDER BY \"end\" DESC, \"start\" DESC) AS k FROM ids) WHERE k = 1"
)
def max_position(spark, d):
    return ledger.max_position(reorg.range_ids(chain.batches(spark, d))).drop("prev_hash")


_HOLED = " WHERE slot % 5 <> 4"
_GAPS = (
    _BATCHES + ", held AS (SELECT * FROM batches" + _HOLED + "), reach AS (SELECT *, max(\"end\") OVER (PARTITION BY network ORDER BY \"start\", \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM held), "
    "gaps AS (SELECT network, r + 1 AS gap_start, \"start\" - 1 AS gap_end FROM reach WHERE \"start\" > r + 1)"
)


def _held(spark, d):
    return chain.batches(spark, d).where("slot % 5 <> 4")


@query(_GAPS + " SELECT network, gap_start, gap_end FROM gaps ORDER BY network, gap_start")
def detect_gaps(spark, d):
    return ledger.detect_gaps(_held(spark, d)).orderBy("network", "gap_start")


@query(_GAPS + " SELECT network, gap_start AS \"start\", gap_end AS \"end\", true AS is_gap FROM gaps UNION ALL SELECT network, max(\"end\") + 1, max(\"end\") + 1, false FROM held GROUP BY network")
def resume_position(spark, d):
    return ledger.resume_position(_held(spark, d), with_gaps=True)


@query(
    _GAPS + ", todo AS (SELECT network, gap_start AS a, gap_end + 1 AS z, 0 AS priority FROM gaps UNION ALL SELECT network, max(\"end\") + 1, 1000000, 1 FROM held GROUP BY network HAVING max(\"end\") + 1 < 1000000) "
    "SELECT network, a + k * 5000 AS start_block, least(a + (k + 1) * 5000, z) AS end_block, priority FROM todo, range(0, 201) t(k) WHERE a + k * 5000 < z"
)
def resume_plan(spark, d):
    return ledger.resume_plan(_held(spark, d), 1_000_000, size=5000)


@query(_BATCHES + _STREAM + " SELECT _seq, network, \"start\", \"end\" FROM voids")
def detect_reorgs(spark, d):
    return reorg.detect_reorgs(chain.stream(spark, d))


@query(_BATCHES + _PLACES + " SELECT (slot * 2 + 1) * 1000 + n AS _seq FROM batches JOIN places USING (network) WHERE slot % 7 = 3")
def detect_duplicates(spark, d):
    return reorg.detect_duplicates(chain.stream(spark, d, "repeat"))


def _stream_batches(spark, d) -> DataFrame:
    r = ranges.make_range("network", "start", "end", "hash", "prev_hash")
    return chain.stream(spark, d).select("_seq", F.array(r).alias("_ranges"), F.lit(True).alias("_ranges_complete"), F.lit(False).alias("_notice"))


def _stream_rows(spark, d) -> DataFrame:
    """The rows that each batch of the stream delivers: those of its network and blocks."""
    s = chain.stream(spark, d).select("_seq", "network", "start", "end", F.explode(F.sequence(F.expr("start div 10"), F.expr("end div 10"))).alias("slot"))
    rows = chain.blocks(spark, d).join(s, ["network", "slot"]).where("block_num BETWEEN start AND end")
    return rows.select("_seq", "network", "event_id", "user_id", "block_num", "value")


_PUBLISHED = ", published AS (SELECT s.* FROM stream s WHERE NOT EXISTS (SELECT 1 FROM voids v WHERE v.network = s.network AND v._seq > s._seq AND v.\"start\" <= s.\"end\"))"
_CURRENT = _PUBLISHED + ", current_rows AS (SELECT p._seq, p.network, b.event_id, b.user_id, b.block_num, b.value FROM published p JOIN blocks b ON b.network = p.network AND b.block_num BETWEEN p.\"start\" AND p.\"end\")"
_REPLAY = _BATCHES + _STREAM + _CURRENT + " SELECT network, _seq, count(*) AS row_count, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM current_rows GROUP BY 1, 2"


def _by_batch(rows: DataFrame) -> DataFrame:
    return rows.groupBy("network", "_seq").agg(F.count("*").alias("row_count"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


@query(_REPLAY)
def replay_with_reorgs(spark, d):
    return _by_batch(reorg.current_rows(_stream_rows(spark, d), _stream_batches(spark, d)))


@query(_BATCHES + " SELECT network, \"start\", \"end\" FROM batches WHERE NOT (network = 'click' AND \"end\" >= 200)")
def invalidate_from_block(spark, d):
    return ledger.invalidate_from(chain.batches(spark, d), "click", 200)[0].select("network", "start", "end")


@query(_BATCHES + " SELECT b.event_id, b.network, b.block_num FROM blocks b ANTI JOIN (SELECT network, slot FROM batches WHERE network = 'click' AND \"end\" >= 205) x USING (network, slot)")
def apply_reorg(spark, d):
    rows, _ = reorg.apply_reorg(_identified(spark, d), reorg.range_ids(chain.batches(spark, d)), "click", 205)
    return rows.select("event_id", "network", "block_num")


@query(
    _BATCHES + _STREAM + ", hit AS (SELECT s._seq, min(v._seq) AS by_seq FROM stream s JOIN voids v ON v.network = s.network AND v._seq > s._seq AND v.\"start\" <= s.\"end\" GROUP BY 1) "
    "SELECT s.network, b.event_id, s._seq, hit.by_seq IS NULL AS _is_current, CAST(hit.by_seq AS VARCHAR) AS _reorg_batch_id FROM stream s JOIN blocks b ON b.network = s.network AND b.block_num BETWEEN s.\"start\" AND s.\"end\" LEFT JOIN hit USING (_seq)"
)
def superseded_history(spark, d):
    """History of the stream's rows: what was voided, and by which batch first."""
    s = reorg.range_ids(chain.stream(spark, d))
    hit = reorg.first_voided_by(s, 10).join(s.select("_seq", "network", "batch_id"), ["_seq", "network"])
    hit = hit.select(F.concat_ws("-", "batch_id", "_seq").alias("batch_id"), F.col("by_seq").cast("string").alias("by_seq"))
    rows = _stream_rows(spark, d).join(s.select("_seq", F.concat_ws("-", "batch_id", "_seq").alias("_batch_id")), "_seq").withColumn("_is_current", F.lit(True)).withColumn("_reorg_batch_id", F.lit(None).cast("string"))
    _, history = reorg.history_views(reorg.mark_superseded(rows, hit, "by_seq"), "stream_rows")
    return history.select("network", "event_id", "_seq", "_is_current", "_reorg_batch_id")


@query(_BATCHES + " SELECT network, \"start\", \"end\" FROM batches WHERE network <> 'view' OR \"end\" >= 300")
def cleanup_before(spark, d):
    return ledger.cleanup_before(chain.batches(spark, d), "view", 300).select("network", "start", "end")


@query(_BATCHES + " SELECT b.event_id, b.network, b.block_num FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM batches x WHERE x.network = b.network AND x.slot = b.slot AND x.slot % 2 = 0)")
def unprocessed_batches(spark, d):
    known = reorg.range_ids(chain.batches(spark, d).where("slot % 2 = 0")).select("batch_id")
    return ledger.unprocessed_batches(_identified(spark, d), known).select("event_id", "network", "block_num")


@query(_BATCHES + _IDS + " SELECT network, \"start\", \"end\", batch_id FROM ids WHERE slot % 2 = 0 OR slot % 3 = 0")
def mark_processed(spark, d):
    b = reorg.range_ids(chain.batches(spark, d)).select("network", "start", "end", "batch_id", "slot")
    marked = ledger.mark_processed(b.where("slot % 2 = 0"), b.withColumn("_ranges_complete", F.col("slot") % 3 == 0))
    return marked.drop("slot")


# --- changing tables ----------------------------------------------------------------------------------------------


def _slices(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders in two slices that share keys; the second changes what it repeats."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X"))


_SLICES = "WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), a AS (SELECT * FROM o WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus FROM o WHERE o_orderkey % 2 = 0)"


@query(_SLICES + " SELECT * FROM a UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)")
def insert_if_absent(spark, d):
    return merge.insert_if_absent(*_slices(spark, d), ["o_orderkey"], ["o_custkey"])[0]


@query(_SLICES + " SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY k DESC) AS n FROM (SELECT *, 0 AS k FROM a UNION ALL SELECT *, 1 FROM b)) WHERE n = 1")
def upsert(spark, d):
    """Through a lake table: first slice written, second upserted, read back."""
    first, second = _slices(spark, d)
    table = lake.LakeTable(spark, scratch(spark, "orders"))
    table.write(first)
    table.write(second, "upsert", keys=["o_orderkey"], order=["o_custkey"])
    return table.read()


@query("SELECT o_orderkey, o_custkey, NULL AS priority FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1")
def evolve_schema(spark, d):
    o = read(spark, d, "orders")
    return merge.evolve_schema(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority")))


# --- owners, logs -------------------------------------------------------------------------------------------------

_LATEST = "latest AS (SELECT l_partkey, l_suppkey FROM (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS n FROM lineitem) WHERE n = 1)"


def _latest(spark, d):
    return analytics.latest_by(read(spark, d, "lineitem"), "l_partkey", "l_suppkey", ["l_orderkey", "l_linenumber", "l_suppkey"])


@query(f"WITH {_LATEST} SELECT l_partkey, l_suppkey FROM latest")
def latest_owner(spark, d):
    return _latest(spark, d)


@query(f"WITH {_LATEST} SELECT l_suppkey, array_to_string(list_sort(list(l_partkey)), ',') AS tokens, count(*) AS token_count FROM latest GROUP BY 1")
def owner_holdings(spark, d):
    out = analytics.owner_holdings(_latest(spark, d), "l_partkey", "l_suppkey")
    return out.withColumn("tokens", F.array_join(F.col("tokens").cast("array<string>"), ","))


@query("SELECT l_orderkey AS block_num, l_linenumber AS log_index, l_partkey AS from_id, l_suppkey AS to_id, CAST(l_quantity AS BIGINT) AS amount FROM lineitem")
def decode_events(spark, d):
    logs = chain.logs(spark, d).where((F.col("topic0") == evm.event_topic(chain.TRANSFER)) & F.col("topic3").isNull())
    dec = evm.decode_event(chain.TRANSFER, F.col("topic1"), F.col("topic2"), F.col("topic3"), F.col("data"))
    number = lambda c: F.conv(F.hex(c), 16, 10).cast("long")
    return logs.select("block_num", "log_index", dec.alias("dec")).select("block_num", "log_index", number(F.col("dec")["from"]).alias("from_id"), number(F.col("dec")["to"]).alias("to_id"), F.col("dec")["value"].cast("long").alias("amount"))


_POSITIONS = "WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS BIGINT), l_returnflag) - 1 AS position, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) "


@query(
    _POSITIONS + "SELECT l_orderkey AS block_num, CAST(position AS INTEGER) AS position, CAST(l_partkey AS BIGINT) AS id, CASE WHEN l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 THEN CAST(l_quantity AS BIGINT) END AS amount FROM x"
)
def decode_batch_events(spark, d):
    """Events whose parameters are arrays; logs that are cut short or point beyond their data lose the array that is broken."""
    logs = chain.batch_logs(spark, d).where(F.col("topic0") == evm.event_topic(chain.TRANSFER_BATCH))
    none = F.lit(None).cast("binary")
    dec = evm.decode_event(chain.TRANSFER_BATCH, none, none, none, F.col("data"), wide="none")
    # posexplode would filter by the size of what it explodes, and decode for that once more, all that data is made of within
    arrays = logs.select("block_num", dec.alias("e")).select("block_num", "e.ids", "e.values")
    both = arrays.select("block_num", F.posexplode_outer("ids").alias("position", "id"), "values")
    return both.where("position is not null").select("block_num", "position", F.col("id").cast("long").alias("id"), F.get("values", F.col("position")).cast("long").alias("amount"))


@query(
    _POSITIONS + "SELECT l_orderkey AS block_num, CAST(position AS INTEGER) AS position, CAST(l_partkey AS BIGINT) AS part, l_returnflag AS flag, -CAST(l_quantity AS BIGINT) AS quantity, "
    "CAST(count(*) FILTER (l_linenumber % 2 = 0) OVER (PARTITION BY l_orderkey) AS INTEGER) AS n_even, CAST(coalesce(sum(l_linenumber) FILTER (l_linenumber % 2 = 1) OVER (PARTITION BY l_orderkey), 0) AS BIGINT) AS sum_odd FROM x"
)
def decode_nested_events(spark, d):
    """Events with arrays of tuples that hold texts and negative numbers, and with arrays of arrays."""
    logs, none = chain.fill_logs(spark, d), F.lit(None).cast("binary")
    dec = evm.decode_event(chain.FILLED, none, none, none, F.col("data"))
    even, odd = F.col("e.numbers")[0], F.col("e.numbers")[1]
    counted = logs.select("block_num", dec.alias("e")).select("block_num", F.size(even).alias("n_even"), F.aggregate(odd, F.lit(0).cast("long"), lambda s, x: s + x.cast("long")).alias("sum_odd"), F.posexplode("e.legs").alias("position", "leg"))
    return counted.select("block_num", "position", F.col("leg.part").cast("long").alias("part"), "leg.flag", F.col("leg.quantity").cast("long").alias("quantity"), "n_even", "sum_odd")


@query("SELECT l_orderkey AS block_num, l_linenumber AS log_index, '0x' || lower(printf('%064x', l_partkey)) AS topic1, '0x' || lower(printf('%064x', CAST(l_quantity AS BIGINT))) AS data FROM lineitem")
def hex_encode_binary(spark, d):
    return encoding.hex_encode_binary(chain.logs(spark, d).select("block_num", "log_index", "topic1", "data"))


# --- key-value layouts --------------------------------------------------------------------------------------------


@query("SELECT 'event:' || event_id AS key, event_type AS f_type, CAST(user_id AS VARCHAR) AS f_user FROM events")
def kv_hash(spark, d):
    e = read(spark, d, "events").withColumn("id", F.col("event_id"))
    out = kv.kv_hash(e, encoding.key_from_pattern(e, "{table}:{id}", "event"), ["event_type", "user_id"])
    return out.select("key", F.col("fields")["event_type"].alias("f_type"), F.col("fields")["user_id"].alias("f_user"))


@query("SELECT CAST(user_id AS VARCHAR) AS key, '{\"event_id\":' || max(event_id) || ',\"event_type\":\"' || max_by(event_type, event_id) || '\"}' AS value FROM events GROUP BY user_id")
def kv_json(spark, d):
    e = read(spark, d, "events").select("event_id", "event_type", "user_id")
    return kv.kv_json(e, encoding.composite_key(e, ["user_id"]), F.col("event_id"), ["event_id", "event_type"])


@query("SELECT DISTINCT p_brand AS member FROM part")
def kv_set(spark, d):
    return kv.kv_set(read(spark, d, "part"), "p_brand")


@query("SELECT p_name AS member, max_by(p_retailprice, p_partkey) AS score FROM part GROUP BY p_name")
def kv_zset(spark, d):
    return kv.kv_zset(read(spark, d, "part"), "p_name", F.col("p_retailprice"), F.col("p_partkey"))


@query("WITH z AS (SELECT max_by(p_retailprice, p_partkey) AS score FROM part GROUP BY p_name) SELECT count(*) AS size, min(score) AS min_score, max(score) AS max_score FROM z")
def zset_score_range(spark, d):
    return kv.zset_score_range(kv_zset(spark, d))


@query(_BATCHES + " SELECT 'block_index:events:' || network || ':' || \"start\" || '-' || \"end\" AS key, count(*) AS n_ids FROM blocks JOIN batches USING (network, slot) GROUP BY 1")
def kv_range_index(spark, d):
    b = chain.batches(spark, d).select("network", "slot", F.array(ranges.make_range("network", "start", "end")).alias("_ranges"))
    out = kv.kv_range_index(chain.blocks(spark, d).join(b, ["network", "slot"]), "events", F.col("event_id"))
    return out.select("key", F.size("ids").cast("long").alias("n_ids"))


@query("SELECT event_id AS pos, '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || '}' AS value FROM events")
def kv_entries(spark, d):
    e = read(spark, d, "events")
    return kv.kv_entries(e, F.col("event_id"), ["event_id", "user_id"])


# --- text forms, pages, search, output ----------------------------------------------------------------------------


@query(_BATCHES + " SELECT network, \"start\", \"end\", hash, NULL::VARCHAR AS prev_hash FROM batches")
def range_json_round_trip(spark, d):
    b = chain.batches(spark, d).select(ranges.make_range("network", "start", "end", "hash", "prev_hash").alias("r"))
    nested = F.concat(F.lit('{"network":"'), F.col("r.network"), F.lit('","numbers":{"start":'), F.col("r.start").cast("string"), F.lit(',"end":'), F.col("r.end").cast("string"), F.lit('},"hash":"'), F.col("r.hash"), F.lit('"}'))
    text = F.when(F.col("r.start") % 20 == 0, nested).otherwise(ranges.range_to_json(F.col("r")))
    return b.select(ranges.parse_range(text).alias("r")).select("r.*")


@query("SELECT p_partkey, p_name, p_retailprice, (SELECT count(*) FROM part) AS total, (SELECT count(*) FROM part) > 75 AS has_next FROM part ORDER BY p_retailprice DESC, p_partkey OFFSET 50 LIMIT 25")
def list_page(spark, d):
    return analytics.list_page(read(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), "p_retailprice", page=3, size=25, descending=True, ties=["p_partkey"])


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey > 100 ORDER BY p_partkey LIMIT 50")
def keyset_page(spark, d):
    return analytics.keyset_page(read(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", 100, 50)


@query(
    "WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents), tf AS (SELECT doc_id, word, count(*) AS tf FROM w WHERE word IN ('the', 'license', 'stupid') GROUP BY 1, 2), "
    "df AS (SELECT word, ln(1 + (SELECT count(*) FROM documents) / count(*)) AS idf FROM tf GROUP BY 1) "
    "SELECT doc_id, round(sum(tf * idf), 6) AS score FROM tf JOIN df USING (word) GROUP BY 1 ORDER BY sum(tf * idf) DESC, doc_id LIMIT 50"
)
def keyword_search(spark, d):
    return analytics.keyword_search(read(spark, d, "documents"), "doc_id", "text", "the license stupid", 50).withColumn("score", F.round("score", 6))


@query(ORACLE["keyword_search"])
def keyword_search_indexed(spark, d):
    """The same from an inverted index that is built first and read as far as its bounds ask for."""
    path = scratch(spark, "text_index")
    text_index.build(read(spark, d, "documents"), "doc_id", "text", path)
    best, _ = text_index.TextIndex(spark, path).search("the license stupid", "doc_id", 50)
    return best.withColumn("score", F.round("score", 6))


@query(
    "WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])), 6) AS similarity FROM embeddings, q "
    "ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) DESC, vec_id LIMIT 20"
)
def semantic_search(spark, d):
    e = read(spark, d, "embeddings")
    query_vector = F.array(*[F.lit(float(x)) for x in e.where("vec_id = 0").first()["embedding"]])
    return analytics.semantic_search(e, "vec_id", "embedding", query_vector, 20).withColumn("similarity", F.round("similarity", 6))


@query(
    "WITH q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) AS c FROM embeddings, q), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, rank, round(c, 6) AS similarity FROM r WHERE rank <= 20"
)
def semantic_search_each(spark, d):
    e = read(spark, d, "embeddings")
    path = scratch(spark, "vectors")
    vectors.VectorIndex.build(e, "vec_id", "embedding", path)
    found, _ = vectors.VectorIndex(spark, path).search_each(e.where("vec_id % 100 = 0"), "vec_id", "embedding", scratch(spark, "search"), 20)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS value FROM orders")
def indexer_output(spark, d):
    path = scratch(spark, "indexer")
    lake.write_indexer(read(spark, d, "orders"), path, "o_orderdate", "o_orderkey", "o_totalprice")
    return spark.read.parquet(path)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def extract_metadata(spark, d):
    return read(spark, d, "events").select("event_id", encoding.extract_fields(F.col("props"), "k long")["k"].alias("k"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events")
def timestamp_text(spark, d):
    return read(spark, d, "events").select("event_id", encoding.timestamp_text(F.col("ts")).alias("ts_text"))


@query("SELECT event_type, event_type = 'error' AS transient, count(*) AS n FROM events GROUP BY 1, 2")
def transient_errors(spark, d):
    e = read(spark, d, "events").withColumn("message", F.when(F.col("event_type") == "error", F.concat(F.lit("Request Timed Out after "), F.col("value").cast("string"))).otherwise(F.lit("no such table")))
    return e.select("event_type", encoding.is_transient(F.col("message")).alias("transient")).groupBy("event_type", "transient").agg(F.count("*").alias("n"))


# --- sinks and streams --------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def jdbc_round_trip(spark, d):
    """Through a Derby database in memory: written twice with truncation, read back."""
    table = jdbc.JdbcTable(spark, f"jdbc:derby:memory:x{uuid.uuid4().hex};create=true", "customer", jdbc.DERBY)
    rows = read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    table.write(rows, "overwrite")
    table.write(rows, "overwrite")
    out = table.read()
    return out.select([F.col(c).alias(c.lower()) for c in out.columns])


@query("SELECT CAST(\"columns\" AS INTEGER) AS \"columns\", \"rows\", true AS success FROM (SELECT 4 AS \"columns\", count(*) AS \"rows\" FROM lineitem)")
def load_audit(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return lake.load(rows, lake.LakeTable(spark, scratch(spark, "lake")), "overwrite", "lineitem").select("columns", "rows", "success")


def _delivered(spark, d) -> tuple[str, T.StructType]:
    """The replay's rows as deliveries that follow each other, a file each: their folder and the columns beside the marks."""
    rows = _stream_rows(spark, d).join(_stream_batches(spark, d).select("_seq", F.concat(F.lit('{"ranges":'), ranges.ranges_json(F.col("_ranges")), F.lit(',"ranges_complete":true}')).alias("_metadata_json")), "_seq")
    source = scratch(spark, "source")
    cuts = chain.stream(spark, d).agg(F.percentile_approx("_seq", [0.25, 0.5, 0.75])).first()[0]
    for low, high in zip([-1, *cuts], [*cuts, 1 << 62], strict=True):
        part = rows.where((F.col("_seq") > low) & (F.col("_seq") <= high)).withColumn("_notice", F.lit(False))
        part.repartition(1).write.mode("append").parquet(source)
    return source, T.StructType([f for f in rows.schema if f.name not in ("_seq", "_metadata_json")])


@query(_REPLAY)
def continuous_load(spark, d):
    """The replay as a stream of several epochs, read until there are no more deliveries."""
    source, schema = _delivered(spark, d)
    table = continuous.ContinuousTable(spark, scratch(spark, "table"))
    continuous.await_load(table.start(continuous.read_block_stream(spark, source, schema, files_per_trigger=1), available_now=True))
    return _by_batch(table.current())


@query(_REPLAY)
def canonical_snapshot(spark, d):
    """The replay from a snapshot of all epochs but the newest, made in two steps, and the tail."""
    source, schema = _delivered(spark, d)
    table = continuous.ContinuousTable(spark, scratch(spark, "table"))
    continuous.await_load(table.start(continuous.read_block_stream(spark, source, schema, files_per_trigger=1), available_now=True))
    table.compact(depth=1 << 40)  # nothing is so deep
    table.compact(depth=50)
    table.compact()
    return _by_batch(table.current())


@query(_BATCHES + _STREAM + " SELECT _seq, network, \"start\", \"end\" FROM voids")
def reorg_notices(spark, d):
    """What a running stream tells of reorganisations, delivery by delivery, from a state store with a value for each network."""
    source, schema = _delivered(spark, d)
    table = continuous.ContinuousTable(spark, scratch(spark, "table"))
    continuous.await_load(table.start_notices(continuous.read_block_stream(spark, source, schema, files_per_trigger=1), available_now=True))
    return table.notices()


@query("SELECT event_id, event_id // 10 AS block_num, value FROM events WHERE event_id // 10 >= 50")
def block_position_stream(spark, d):
    """A table of blocks as a stream that is cut by block positions: two queries, the second goes on after the ledger of the first."""
    path, root = scratch(spark, "chain"), scratch(spark, "table")
    rows = chain.blocks(spark, d).select("event_id", "block_num", "value")
    top, table = partition.max_block(rows, "block_num"), continuous.ContinuousTable(spark, root)
    rows.where(F.col("block_num") <= top // 2).repartition(3).write.parquet(path)
    for k in range(2):
        stream = continuous.read_blocks(spark, path, "block_num", "events", rows.schema, blocks_per_trigger=top // 4 + 1, blocks_per_task=top // 16 + 1, start=50, table=table)
        table.load(stream, fresh=True)
        if not k:  # more blocks; the first query's checkpoint is not used again
            rows.where(F.col("block_num") > top // 2).repartition(2).write.mode("append").parquet(path)
    return table.current().select("event_id", "block_num", "value")


@query(_BATCHES + " SELECT event_id, network, block_num FROM blocks WHERE slot % 5 <> 0")
def microbatch_assembly(spark, d):
    """Each batch comes in two parts of one range, the second completes it; every fifth batch never gets complete."""
    b = chain.batches(spark, d).select("network", "slot", F.array(ranges.make_range("network", "start", "end", "hash", "prev_hash")).alias("_ranges"))
    place = chain.stream(spark, d).where("turn = 0").select("network", "slot", F.col("_seq").alias("place"))
    parts = b.join(place, ["network", "slot"]).select("network", "slot", "_ranges", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"), "place").where("part = 0 OR slot % 5 <> 0")
    parts = parts.withColumn("_seq", 2 * F.col("place") + F.col("part"))
    marks = parts.select("_seq", "_ranges", (F.col("part") == 1).alias("_ranges_complete"), F.lit(False).alias("_notice"))
    rows = chain.blocks(spark, d).withColumn("part", (F.col("event_id") % 2).cast("int")).join(parts.select("network", "slot", "part", "_seq"), ["network", "slot", "part"])
    return reorg.current_rows(rows, marks).select("event_id", "network", "block_num")


@query("SELECT event_type AS network, count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def hybrid_load(spark, d):
    """The older half of the blocks as history in ranges, then a stream that starts 200 blocks before its end."""
    rows = chain.blocks(spark, d).select("event_id", "network", "slot", "block_num")
    middle = partition.max_block(rows, "block_num") // 2
    past = partition.in_range(rows, "block_num", 0, middle)
    live = rows.where(F.col("block_num") >= middle - 500).join(chain.stream(spark, d).where("turn = 0").select("network", "slot", "_seq", "start", "end"), ["network", "slot"])
    meta = F.concat(F.lit('{"ranges":'), ranges.ranges_json(F.array(ranges.make_range("network", "start", "end"))), F.lit(',"ranges_complete":true}'))
    source, path = scratch(spark, "source"), scratch(spark, "history")
    live.select("event_id", "network", "block_num", "_seq", meta.alias("_metadata_json"), F.lit(False).alias("_notice")).repartitionByRange(2, "_seq").write.parquet(source)
    schema = T.StructType([rows.schema["event_id"], rows.schema["network"], rows.schema["block_num"]])
    table = continuous.ContinuousTable(spark, scratch(spark, "live"))
    _, running = continuous.hybrid_load(past, "block_num", "events", 0, path, table, continuous.read_block_stream(spark, source, schema), buffer=200)
    continuous.await_load(running)
    both = continuous.combined(spark.read.parquet(path).select("event_id", "network", "block_num"), table.current().select("event_id", "network", "block_num"), ["event_id"])
    return both.groupBy("network").agg(F.count("*").alias("row_count"), F.sum("event_id").alias("ids"))


# --- what the other operators do, one query each ------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders")
def stream_batches(spark, d):
    """A result in Arrow batches of 1000 rows, made by the tasks and read again."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    return datasets.unpacked_batches(datasets.packed_batches(o, 1000), o.schema)


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def collect_table(spark, d):
    """An aggregate as an Arrow table on the driver, and back."""
    return spark.createDataFrame(datasets.collect_table(read(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))))


def _counted_columns(spark, d, tables: list[str], type_: str | None, name: str | None) -> DataFrame:
    """Rows with a value of each column that describe_tables and columns_of find."""
    described = datasets.describe_tables(spark, {t: read(spark, d, t).schema for t in tables})
    found, out = [(r.table, r.column) for r in datasets.columns_of(described, type_, name).collect()], None  # columns of the named tables
    for t in tables:
        own = [c for x, c in found if x == t]
        if own:
            counts = read(spark, d, t).agg(*[F.count(c).alias(c) for c in own]).unpivot([], own, "column", "filled").withColumn("table", F.lit(t))
            out = counts if out is None else out.unionByName(counts)
    return described.join(out, ["table", "column"])


_FILLED = "SELECT '{0}' AS \"table\", '{1}' AS \"column\", '{2}' AS type, true AS nullable, count({1}) AS filled FROM {0}"


@query(" UNION ALL ".join(_FILLED.format(t, c, k) for t, c, k in (("customer", "c_custkey", "bigint"), ("customer", "c_name", "string"), ("customer", "c_nationkey", "int"), ("customer", "c_acctbal", "double"), ("customer", "c_mktsegment", "string"), ("nation", "n_nationkey", "int"), ("nation", "n_name", "string"), ("nation", "n_regionkey", "int"))))
def describe_tables(spark, d):
    return _counted_columns(spark, d, ["customer", "nation"], None, None)


@query(" UNION ALL ".join(_FILLED.format(t, c, "double") for t, c in (("orders", "o_totalprice"), ("customer", "c_acctbal"), ("part", "p_retailprice"))))
def columns_by_type(spark, d):
    return _counted_columns(spark, d, ["orders", "customer", "part"], "double", "price|bal")


@query("SELECT o_orderkey AS _block_num, o_custkey AS customer, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_totalprice > 100000")
def output_schema(spark, d):
    """The schema of a query that never runs, with the block column first, laid over the rows of another one."""
    read(spark, d, "orders").createOrReplaceTempView("orders_of_schema")
    schema = datasets.output_schema(spark, "SELECT o_custkey AS customer, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders_of_schema", with_block=True)
    rows = read(spark, d, "orders").where("o_totalprice > 100000").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100))
    return rows.toDF(*schema.names).select([F.col(f.name).cast(f.dataType) for f in schema])


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def label_registry(spark, d):
    """A set that is added, replaced and found by name among others."""
    sets = labels.LabelRegistry(spark)
    nations = _nation_labels(spark, d)
    sets.add("nations", nations.limit(0))
    sets.add("nations", nations)
    sets.add("others", nations.limit(1))
    sets.remove("others")
    (name,) = sets.names()
    out = joins.label_join(read(spark, d, "customer").select("c_custkey", "c_nationkey"), sets.get(name), "n_nationkey", "c_nationkey").drop("c_nationkey")
    sets.clear()
    return out


@query("SELECT l_orderkey AS block_num, l_linenumber AS log_index, l_suppkey AS to_id FROM lineitem")
def abi_events(spark, d):
    """Logs decoded by the signature that a contract's interface description gives."""
    path = scratch(spark, "abi")
    parts = [{"name": n, "type": t, "indexed": i} for n, t, i in (("from", "address", True), ("to", "address", True), ("value", "uint256", False))]
    spark.createDataFrame([(json.dumps([{"type": "event", "name": "Transfer", "inputs": parts}, {"type": "function", "name": "f", "inputs": []}]),)], "value string").coalesce(1).write.text(path)
    signature = abi.read_abi_events(spark, path, "Transfer").first()["signature"]
    logs = chain.logs(spark, d).where(F.col("topic0") == evm.event_topic(signature))
    dec = evm.decode_event(signature, F.col("topic1"), F.col("topic2"), F.col("topic3"), F.col("data"))
    return logs.select("block_num", "log_index", F.conv(F.hex(dec["to"]), 16, 10).cast("long").alias("to_id"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) - 500 FROM orders)")
def resolve_end_block(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    return partition.in_range(o, "o_orderkey", 0, partition.resolve_end(o, "o_orderkey", "-500") + 1)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def read_table(spark, d):
    """Columns of a table in several folders, the first of which lacks one."""
    path, o = scratch(spark, "table"), read(spark, d, "orders")
    o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus").write.parquet(f"{path}/half=0")
    o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", "o_custkey").write.parquet(f"{path}/half=1")
    return datasets.read_table(spark, path, ["o_orderkey", "o_orderstatus"])


@query("SELECT 'c_custkey' AS \"column\", 'bigint' AS type, count(c_custkey) AS filled FROM customer UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal) FROM customer UNION ALL SELECT 'c_name', 'string', count(c_name) FROM customer")
def jdbc_schema(spark, d):
    """Columns of an external table and how many rows have a value there."""
    url = f"jdbc:derby:memory:x{uuid.uuid4().hex}"
    table = jdbc.JdbcTable(spark, f"{url};create=true", "customer", jdbc.DERBY)
    table.write(read(spark, d, "customer").select("c_custkey", "c_acctbal", "c_name"), "overwrite")
    schema = datasets.jdbc_schema(spark, url, "customer", jdbc.DERBY)
    kinds = spark.createDataFrame([(f.name.lower(), f.dataType.simpleString()) for f in schema], "column string, type string")
    filled = table.read().agg(*[F.count(f.name).alias(f.name.lower()) for f in schema]).unpivot([], [f.name.lower() for f in schema], "column", "filled")
    return kinds.withColumn("type", F.regexp_replace("type", r"varchar.*", "string")).join(filled, "column")


@query(_BATCHES + " SELECT b.event_id, x.slot FROM blocks b JOIN batches x ON b.network = x.network AND b.block_num BETWEEN greatest(x.\"start\" - 5, 0) AND x.\"end\" WHERE x.slot % 7 = 3")
def block_contains(spark, d):
    """Events inside ranges that reach five blocks back: in the batch's slot or the one before."""
    wide = chain.batches(spark, d).where("slot % 7 = 3").select("network", F.col("slot").alias("of"), ranges.make_range("network", F.greatest(F.col("start") - 5, F.lit(0)), "end").alias("r"), F.explode(F.sequence(F.expr("greatest(start - 5, 0) div 10"), F.expr("end div 10"))).alias("slot"))
    met = chain.blocks(spark, d).join(wide, ["network", "slot"]).where(ranges.contains_block(F.col("r"), F.col("block_num")))
    return met.select("event_id", F.col("of").alias("slot"))


@query("SELECT count(*) AS \"rows\", 4 AS \"columns\", true AS success, 'l_linenumber,l_orderkey,l_quantity,l_shipdate' AS names FROM lineitem WHERE l_quantity < 0")
def empty_result(spark, d):
    """A load without rows keeps the columns: the table is there and can be read."""
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate").where("l_quantity < 0")
    table = lake.LakeTable(spark, scratch(spark, "lake"))
    audit = lake.load(rows, table, "overwrite", "lineitem").select("columns", "success")
    return table.read().agg(F.count("*").alias("rows")).join(audit).withColumn("names", F.lit(",".join(sorted(table.read().columns))))


@query(
    "WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) + 1 AS hi FROM lineitem), s AS (SELECT lo, (hi - lo + 7) // 8 AS step FROM b), p AS (SELECT (l_orderkey - lo) // step AS part, count(*) AS n FROM lineitem, s GROUP BY 1) "
    "SELECT CAST(coalesce(sum(n) FILTER (part % 3 <> 2), 0) AS BIGINT) AS \"rows\", CAST(sum((part + 1) * 0.5) AS DOUBLE) AS seconds, count(*) FILTER (part % 3 <> 2) AS completed, count(*) FILTER (part % 3 = 2) AS failed, "
    "round(avg(n / ((part + 1) * 0.5)) FILTER (part % 3 <> 2), 6) AS rows_per_second FROM p"
)
def partition_stats(spark, d):
    """Totals of an audit table of a load in eight ranges, of which every third one failed."""
    li = read(spark, d, "lineitem").select("l_orderkey")
    b = li.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    audit = partition.partitioned_load(li, "l_orderkey", "lineitem", b[0], b[1] + 1, workers=8)
    audit = audit.withColumn("seconds", (F.col("part") + 1) * F.lit(0.5)).withColumn("success", F.col("part") % 3 != 2)
    return partition.partition_totals(audit).withColumn("rows_per_second", F.round("rows_per_second", 6))


_NANOS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


@query(f"SELECT event_id, {_NANOS} AS ts_text FROM events")
def from_nanoseconds(spark, d):
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + F.col("event_id") % 1000
    return read(spark, d, "events").select("event_id", encoding.timestamp_text(encoding.from_nanoseconds(nanos)).alias("ts_text"))


@query("SELECT event_id, CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE '' END AS text FROM events")
def text_or_empty(spark, d):
    return read(spark, d, "events").select("event_id", encoding.text_or_empty(F.when(F.col("user_id") % 2 == 0, F.col("user_id"))).alias("text"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS at FROM events")
def parse_utc(spark, d):
    """Timestamps from text with and without the word UTC; text that is none gives null."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 5 == 0, "not a time").when(F.col("event_id") % 2 == 0, F.concat(text, F.lit(" UTC"))).otherwise(text)
    return read(spark, d, "events").select("event_id", F.date_format(encoding.parse_utc(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT c_custkey, lower(c_mktsegment) AS namespace, c_name AS name, '1.0.' || c_nationkey AS version, lower(c_mktsegment) || '/' || c_name || '@1.0.' || c_nationkey AS again FROM customer")
def references(spark, d):
    whole = F.concat(F.lower("c_mktsegment"), F.lit("/"), "c_name", F.lit("@1.0."), F.col("c_nationkey").cast("string"))
    parsed = read(spark, d, "customer").select("c_custkey", encoding.parse_reference(whole).alias("r")).select("c_custkey", "r.*")
    return parsed.withColumn("again", encoding.format_reference(F.col("namespace"), F.col("name"), F.col("version")))


@query("SELECT o_orderstatus, count(*) AS row_count, true AS small_files FROM orders GROUP BY 1")
def partitioned_write(spark, d):
    """A lake table in folders by status, with files of 100 rows at most."""
    table = lake.LakeTable(spark, scratch(spark, "orders"), partition_by=["o_orderstatus"], max_rows_per_file=100)
    table.write(read(spark, d, "orders").select("o_orderkey", "o_orderstatus"))
    files = table.read().groupBy("o_orderstatus", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return files.groupBy("o_orderstatus").agg(F.sum("n").alias("row_count"), (F.max("n") <= 100).alias("small_files"))


@query(_SLICES + " SELECT * FROM a UNION ALL SELECT * FROM b")
def append_rows(spark, d):
    first, second = _slices(spark, d)
    table = lake.LakeTable(spark, scratch(spark, "orders"))
    table.write(first)
    table.write(second, "append")
    return table.read()


@query(_SLICES + ", u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT count(*) AS \"rows\", CAST(sum(o_orderkey) AS BIGINT) AS \"keys\", 2 AS files FROM u")
def compact(spark, d):
    """Two appends, the first in one file, the second in six small ones: these are merged, the large one stays."""
    table = lake.LakeTable(spark, scratch(spark, "orders"))
    first, second = _slices(spark, d)
    table.write(first.coalesce(1))
    (large,) = table._listed(table.state())
    table.write(second.repartition(6))
    table.compact(target_bytes=1 << 30, small_bytes=large[1])
    table.remove_old(0)
    return table.read().agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"), F.lit(len(table._listed(table.state()))).alias("files"))


@query(_SLICES + " SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY k DESC) AS n FROM (SELECT *, 0 AS k FROM a UNION ALL SELECT *, 1 FROM b UNION ALL SELECT o_orderkey, o_custkey, 'Y', 2 FROM o WHERE o_orderkey % 100 = 0)) WHERE n = 1")
def upsert_by_place(spark, d):
    """A table in key buckets with a filter for each file: two upserts, the second of a hundredth of the keys; no file is rewritten."""
    first, second = _slices(spark, d)
    table = lake.LakeTable(spark, scratch(spark, "orders"), keys=["o_orderkey"], buckets=8)
    table.write(first)
    table.write(second, "upsert", order=["o_custkey"])
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey").where("o_orderkey % 100 = 0").withColumn("o_orderstatus", F.lit("Y"))
    table.write(o, "upsert", order=["o_custkey"])
    return table.read()


@query(_BATCHES + " SELECT b.event_id, b.network, b.block_num FROM blocks b ANTI JOIN (SELECT network, slot FROM batches WHERE network = 'click' AND \"end\" >= 205) x USING (network, slot)")
def delete_by_file_index(spark, d):
    """A reorganisation in a lake table: the index names the files that hold its batches, and rows go by their place."""
    table = lake.LakeTable(spark, scratch(spark, "events"), partition_by=["network"])
    table.write(_identified(spark, d))
    table.delete_batches(ledger.invalidate_from(reorg.range_ids(chain.batches(spark, d)), "click", 205)[1])
    return table.read().select("event_id", "network", "block_num")


#: A column of each Spark type, made of an order, and its type by target (postgresql, clickhouse, snowflake, iceberg).
_TYPED = [
    ("CAST(o_orderkey % 100 AS TINYINT)", "SMALLINT", "Int8", "TINYINT", "int"), ("CAST(o_orderkey % 100 AS SMALLINT)", "SMALLINT", "Int16", "SMALLINT", "int"), ("CAST(o_orderkey AS INT)", "INTEGER", "Int32", "INTEGER", "int"),
    ("o_orderkey", "BIGINT", "Int64", "BIGINT", "long"), ("CAST(o_totalprice AS FLOAT)", "REAL", "Float32", "FLOAT", "float"), ("o_totalprice", "DOUBLE PRECISION", "Float64", "FLOAT", "double"),
    ("o_orderkey % 2 = 0", "BOOLEAN", "Bool", "BOOLEAN", "boolean"), ("o_orderstatus", "TEXT", "String", "VARCHAR", "string"), ("CAST(o_orderstatus AS BINARY)", "BYTEA", "String", "BINARY", "binary"),
    ("CAST(o_totalprice AS DECIMAL(12,2))", "NUMERIC(12,2)", "Decimal(12,2)", "NUMBER(12,2)", "decimal(12,2)"), ("CAST(o_orderdate AS DATE)", "DATE", "Date", "DATE", "date"),
    ("CAST(o_orderdate AS TIMESTAMP_LTZ)", "TIMESTAMPTZ", "DateTime64(6, 'UTC')", "TIMESTAMP_TZ", "timestamptz"), ("CAST(o_orderdate AS TIMESTAMP_NTZ)", "TIMESTAMP", "DateTime64(6)", "TIMESTAMP_NTZ", "timestamp"),
    ("array(CAST(o_orderkey AS INT))", "TEXT", "Array(Int32)", "VARIANT", "list<int>"), ("struct(o_orderkey)", "TEXT", "String", "OBJECT", "struct"), ("map(o_orderstatus, o_totalprice)", "TEXT", "Map(String, Float64)", "OBJECT", "map<string,double>"),
]
_TARGETS = ("postgresql", "clickhouse", "snowflake", "iceberg")
_DDL = [(t, i, kinds[k]) for i, (_, *kinds) in enumerate(_TYPED) for k, t in enumerate(_TARGETS)]


@query("SELECT target, kind, count(o_orderkey) * n AS filled FROM orders, (SELECT target, kind, count(*) AS n FROM (VALUES " + ", ".join("('{}', {}, '{}')".format(t, i, k.replace("'", "''")) for t, i, k in _DDL) + ") v(target, i, kind) GROUP BY 1, 2) GROUP BY target, kind, n")
def ddl_types(spark, d):
    """How many values of orders go into each column type of a target: a column of every Spark type, typed by the definitions of their tables."""
    o = read(spark, d, "orders").selectExpr(*[f"{e} AS c{i}" for i, (e, *_) in enumerate(_TYPED)])
    kinds = spark.createDataFrame([(t, f.name, jdbc.ddl_type(t, f.dataType)) for t in jdbc.TYPES for f in o.schema], "target string, column string, kind string")
    filled = o.agg(*[F.count(c).alias(c) for c in o.columns]).unpivot([], o.columns, "column", "filled")
    return kinds.join(filled, "column").groupBy("target", "kind").agg(F.sum("filled").alias("filled"))


@query(_SLICES + " SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT * FROM b")
def transactional_load(spark, d):
    """A relational table that is loaded through staging tables: a first load, an upsert, and both again under their tokens, which changes nothing."""
    first, second = _slices(spark, d)
    table = jdbc.JdbcTable(spark, f"jdbc:derby:memory:x{uuid.uuid4().hex};create=true", "orders", jdbc.DERBY)
    for _ in range(2):
        table.load(first, "load-1")
        table.load(second, "load-2", keys=["o_orderkey"])
    return table.read().toDF(*first.columns)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS cents FROM orders")
def csv_export(spark, d):
    """Rows as CSV with a header, read back as text."""
    path = scratch(spark, "csv")
    lake.write_csv(read(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")), path)
    return spark.read.option("header", True).csv(path)


@query(_SLICES + " SELECT * FROM a UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)")
def warehouse_insert(spark, d):
    """A relational table that gets the rows it lacks: keys are looked up, what is new is appended."""
    first, second = _slices(spark, d)
    table = jdbc.JdbcTable(spark, f"jdbc:derby:memory:x{uuid.uuid4().hex};create=true", "orders", jdbc.DERBY)
    table.write(first, "overwrite")
    have = table.read().toDF(*first.columns)
    fresh = merge.insert_if_absent(have.limit(0), second.join(have, "o_orderkey", "left_anti"), ["o_orderkey"], ["o_custkey"])[0]
    kept = scratch(spark, "fresh")
    fresh.write.parquet(kept)  # the table is not read by the job that writes it
    table.write(spark.read.parquet(kept), "append")
    return table.read().toDF(*first.columns)


@query("SELECT event_id FROM events WHERE ts + INTERVAL 2 HOUR > (SELECT max(ts) FROM events)")
def expire_at(spark, d):
    e = read(spark, d, "events")
    now = F.lit(e.agg(F.max("ts")).first()[0]).cast(e.schema["ts"].dataType)
    return kv.unexpired(kv.with_expiry(e, 7200, F.col("ts")), now).select("event_id")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, o_custkey, o_orderstatus FROM (" + _SLICES + " SELECT * FROM a UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a))")
def kv_rows(spark, d):
    """Rows under keys; those whose key is there already do not replace it."""
    first, second = (kv.kv_rows(x, F.col("o_orderkey").cast("string")) for x in _slices(spark, d))
    both = merge.insert_if_absent(first, second, ["key"], ["value"])[0]
    return both.select("key", "value.o_custkey", "value.o_orderstatus")


@query("SELECT user_id AS key, string_agg('{\"event_id\":' || event_id || '}', '|' ORDER BY event_id) AS entries FROM events GROUP BY 1")
def kv_list(spark, d):
    e = read(spark, d, "events")
    return kv.kv_list(e, F.col("user_id"), F.col("event_id"), ["event_id"]).select("key", F.array_join("values", "|").alias("entries"))


@query(_BATCHES + " SELECT DISTINCT '[{\"network\":\"' || network || '\",\"start\":' || \"start\" || ',\"end\":' || \"end\" || ',\"hash\":\"' || hash || '\",\"prev_hash\":null}]' AS _block_ranges, true AS _is_current, CAST(NULL AS VARCHAR) AS _reorg_batch_id FROM batches")
def batch_columns(spark, d):
    """Ranges as JSON and the history columns beside the rows of every batch."""
    b = chain.batches(spark, d).select("network", "slot", F.array(ranges.make_range("network", "start", "end", "hash", "prev_hash")).alias("_ranges"))
    rows = reorg.add_batch_columns(chain.blocks(spark, d).join(b, ["network", "slot"]), with_json=True, with_history=True)
    return rows.select("_block_ranges", "_is_current", "_reorg_batch_id").distinct()


@query("SELECT o_orderkey, CAST(CAST(o_orderkey AS HUGEINT) * 10000000000000000 * 10000000000000000 + o_custkey AS VARCHAR) AS digits FROM orders")
def wide_numbers(spark, d):
    """Amounts of some 40 digits, as words of event data and as text: the number is beyond a decimal or not, its digits are there."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    # o_orderkey * 10^32 + o_custkey in limbs of 32 bits
    limbs = [(10**32 >> 32 * i) & 0xFFFFFFFF for i in range(4)]
    carry, parts = F.col("o_custkey"), []
    for x in limbs:  # least first; a product of 31 and 32 bits and a carry stay below 2^63
        total = F.col("o_orderkey") * F.lit(x) + carry
        parts.append(total.bitwiseAND(F.lit(0xFFFFFFFF)))
        carry = F.shiftrightunsigned(total, 32)
    word = F.concat(F.lit(bytearray(12)), *[F.unhex(F.lpad(F.hex(p), 8, "0")) for p in [carry, *reversed(parts)]])
    o = o.select("o_orderkey", word.alias("word"))  # a column of its own, as decoding refers to it many times
    dec = evm.decode_event("Amount(uint256 value)", F.lit(None), F.lit(None), F.lit(None), F.col("word"))
    return o.select("o_orderkey", F.coalesce(dec["value_text"], dec["value"].cast("string")).alias("digits"))


#: Queries that run a job of their own before they return, or Python in the tasks.
EAGER = {"reorg_notices", "canonical_snapshot", "stream_batches", "collect_table", "describe_tables", "columns_by_type", "abi_events", "table_files", "read_table", "jdbc_schema", "empty_result", "partitioned_write", "append_rows", "compact", "upsert_by_place", "keyword_search_indexed", "semantic_search_each", "block_position_stream", "table_progress", "table_stats", "transactional_load", "csv_export", "delete_by_file_index", "warehouse_insert"}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows after all reorganisations, joined with labels of their users, counted by label."""
    current = reorg.current_rows(_stream_rows(spark, sf_dir), _stream_batches(spark, sf_dir))
    sets = labels.as_labels(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    return analytics.top_labels(joins.label_join(current, sets, "c_custkey", "user_id"), ["network", "c_mktsegment"])


_FLAGSHIP = _BATCHES + _STREAM + _CURRENT + " SELECT network, c_mktsegment, count(*) AS row_count FROM current_rows JOIN customer ON user_id = c_custkey GROUP BY 1, 2 ORDER BY row_count DESC, network, c_mktsegment LIMIT 10"
QUERIES["canonical_top_labels"] = flagship
ORACLE["canonical_top_labels"] = _FLAGSHIP
