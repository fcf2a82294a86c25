"""Chain-like inputs from business tables: blocks, batches and logs for the registered queries.

``block_num = event_id DIV 10`` and ``network = event_type``; a batch is a network's blocks with one ``block_num DIV 10``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    block = F.call_function("div", F.col("event_id"), F.lit(10))
    return e.select("event_id", "user_id", "value", "ts", F.col("event_type").alias("network"), block.alias("block_num")).withColumn("slot", F.call_function("div", F.col("block_num"), F.lit(10)))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """network, slot, start, end, hash, prev_hash of every batch."""
    out = blocks(spark, sf_dir).groupBy("network", "slot").agg(F.min("block_num").alias("start"), F.max("block_num").alias("end"))
    return out.withColumn("hash", F.concat(F.lit("h"), "network", F.col("start").cast("string"))).withColumn("prev_hash", F.lit(None).cast("string"))


def stream(spark: SparkSession, sf_dir: str, copies: str = "reorg") -> DataFrame:
    """batches with ``_seq``. Those with slot mod 7 = 3 come again right after: from five blocks earlier with another
    hash (``reorg``), or as they are (``repeat``)."""
    own = batches(spark, sf_dir)
    again = own.where("slot % 7 = 3")
    if copies == "reorg":
        again = again.withColumn("start", F.greatest(F.col("start") - 5, F.lit(0))).withColumn("hash", F.concat(F.lit("r"), "network", F.col("start").cast("string")))
    both = own.withColumn("turn", F.lit(0)).unionByName(again.withColumn("turn", F.lit(1)))
    # batches of one network in order of slot; a batch's place is made of its slot, turn and network, so no rows need one order
    place = F.dense_rank().over(Window.orderBy("network"))
    rank = own.select("network").distinct().select("network", place.alias("n"))  # a row for each network
    return both.join(F.broadcast(rank), "network").withColumn("_seq", (F.col("slot") * 2 + F.col("turn")) * 1000 + F.col("n")).drop("n")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event logs made of order lines: who (topics 1 and 2) and how much (data)."""
    from rangeloom.functions.evm import event_topic

    word = lambda c: F.unhex(F.lpad(F.hex(c.cast("long")), 64, "0"))
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("block_num"), F.col("l_linenumber").alias("log_index"), event_topic(TRANSFER).alias("topic0"),
        word(F.col("l_partkey")).alias("topic1"), word(F.col("l_suppkey")).alias("topic2"), F.lit(None).cast("binary").alias("topic3"),
        word(F.col("l_quantity")).alias("data"),
    )


def _word(c) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("long")), 64, "0"))


def _joined(words: Column) -> Column:
    """An array of binary values as one."""
    return F.unhex(F.array_join(F.transform(words, F.hex), ""))


def batch_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log for each order: its lines' parts and quantities as two arrays. Every seventh one is cut short, every eleventh says that the
    second array is far beyond the data."""
    from rangeloom.functions.evm import event_topic

    li = read(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q")))).alias("x"))  # an order's lines
    digits = lambda c: F.lpad(F.hex(c.cast("long")), 64, "0")
    array = lambda f: F.concat(digits(F.size("x")), F.array_join(F.transform("x", lambda e: digits(e[f])), ""))
    second = F.when(F.col("l_orderkey") % 11 == 0, F.lit("F" * 64)).otherwise(digits(F.size("x") * 32 + 96))
    data = F.unhex(F.concat(digits(F.lit(64)), second, array("l_partkey"), array("q")))
    data = F.when(F.col("l_orderkey") % 7 == 0, F.substring(data, F.lit(1), F.octet_length(data) - 8)).otherwise(data)
    return lines.select(F.col("l_orderkey").alias("block_num"), event_topic(TRANSFER_BATCH).alias("topic0"), data.alias("data"))


def fill_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log for each order: its lines as tuples with a text of their own, and the line numbers by parity as nested arrays."""
    from rangeloom.functions.evm import event_topic

    li = read(spark, sf_dir, "lineitem")
    line = F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q"), F.col("l_returnflag").alias("flag"))
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("x"))
    n = F.size("x")
    # a tuple is its part, the distance of its text, minus its quantity, and the text: five words
    text = lambda e: F.concat(_word(F.octet_length(e["flag"])), F.rpad(e["flag"].cast("binary"), 32, F.lit(bytearray(1))))
    negative = lambda v: F.unhex(F.lpad(F.hex(-v), 64, "F"))
    bodies = F.transform("x", lambda e: F.concat(_word(e["l_partkey"]), _word(F.lit(96)), negative(e["q"]), text(e)))
    places = F.transform("x", lambda e, i: _word(n * 32 + i * 160))
    tuples = F.concat(_word(n), _joined(places), _joined(bodies))
    some = lambda k: F.filter("x", lambda e: e["l_linenumber"] % 2 == k)
    numbers = lambda k: F.concat(_word(F.size(some(k))), _joined(F.transform(some(k), lambda e: _word(e["l_linenumber"]))))
    nested = F.concat(_word(F.lit(2)), _word(F.lit(64)), _word(F.size(some(0)) * 32 + 96), numbers(0), numbers(1))
    return lines.select(F.col("l_orderkey").alias("block_num"), event_topic(FILLED).alias("topic0"), F.concat(_word(F.lit(64)), _word(n * 192 + 96), tuples, nested).alias("data"))


TRANSFER_BATCH = "TransferBatch(address indexed operator, address indexed from, address indexed to, uint256[] ids, uint256[] values)"
FILLED = "Filled((uint256 part, string flag, int64 quantity)[] legs, uint8[][] numbers)"
TRANSFER = "Transfer(address indexed from, address indexed to, uint256 value)"
