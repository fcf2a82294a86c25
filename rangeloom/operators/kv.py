"""Key-value layouts of rows: hashes, JSON, ordered entries, sets, ranked sets, indexes of ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.encoding import row_json
from rangeloom.functions.ranges import ids_of


def _text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return F.when(F.col(name), "1").when(~F.col(name), "0")
    return F.lower(F.hex(name)) if isinstance(kind, T.BinaryType) else F.col(name).cast("string")


def kv_hash(df: DataFrame, key: Column, fields: list[str]) -> DataFrame:
    """key and a map of field to text; null fields are left out."""
    pairs = F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*[_text(df, f) for f in fields]))
    return df.select(key.alias("key"), F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("fields"))


def kv_json(df: DataFrame, key: Column, order: Column, columns: list[str] | None = None) -> DataFrame:
    """key and the JSON of its last row in the order."""
    rows = df.select(key.alias("key"), order.alias("at"), row_json(df, columns).alias("value"))
    return rows.groupBy("key").agg(F.max_by("value", F.struct("at", "value")).alias("value"))


def kv_entries(df: DataFrame, position: Column, columns: list[str] | None = None) -> DataFrame:
    """pos and JSON of every row: the entries of a list or stream in order of pos."""
    return df.select(position.alias("pos"), row_json(df, columns).alias("value"))


def kv_list(df: DataFrame, key: Column, position: Column, columns: list[str] | None = None) -> DataFrame:
    """key and its entries as one array; only for keys whose rows fit in memory."""
    rows = df.select(key.alias("key"), F.struct(position.alias("pos"), row_json(df, columns).alias("value")).alias("x"))
    return rows.groupBy("key").agg(F.sort_array(F.collect_list("x"))["value"].alias("values"))


def kv_set(df: DataFrame, member: str | None = None) -> DataFrame:
    """Distinct members: a column's values, or whole rows as JSON."""
    value = _text(df, member) if member else row_json(df)
    return df.select(value.alias("member")).where("member is not null").distinct()


def kv_zset(df: DataFrame, member: str, score: Column, order: Column) -> DataFrame:
    """member and the score of its last row in the order."""
    rows = df.select(_text(df, member).alias("member"), score.cast("double").alias("score"), order.alias("at"))
    return rows.groupBy("member").agg(F.max_by("score", F.struct("at", "score")).alias("score"))


def zset_score_range(zset: DataFrame) -> DataFrame:
    return zset.agg(F.count("*").alias("size"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def kv_range_index(df: DataFrame, table: str, ident: Column, ranges: str = "_ranges") -> DataFrame:
    """block_index:<table>:<network>:<start>-<end> and the sorted ids of the rows of that range."""
    rows = df.select(ident.cast("string").alias("id"), F.explode(ranges).alias("r"))
    key = F.concat(F.lit(f"block_index:{table}:"), F.col("r.network"), F.lit(":"), F.col("r.start").cast("string"), F.lit("-"), F.col("r.end").cast("string"))
    return rows.select(key.alias("key"), "id").groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def with_expiry(df: DataFrame, seconds: int, now: Column | None = None) -> DataFrame:
    return df.withColumn("expire_at", (now if now is not None else F.current_timestamp()) + F.make_interval(secs=F.lit(seconds)))


def unexpired(df: DataFrame, now: Column | None = None) -> DataFrame:
    return df.where(F.col("expire_at") > (now if now is not None else F.current_timestamp()))


def kv_rows(df: DataFrame, key: Column) -> DataFrame:
    """key and the row as a struct; insert_if_absent and upsert decide what happens to keys that are there."""
    return df.select(key.alias("key"), F.struct(*df.columns).alias("value"))


def delete_kv_batches(entries: DataFrame, affected: DataFrame, ids: str = "_batch_id") -> DataFrame:
    """Entries without those whose id list has a member in ``affected``."""
    lists = entries.select(ids).distinct().select(ids, F.explode(ids_of(F.col(ids))).alias("batch_id"))
    hit = lists.join(affected.select("batch_id"), "batch_id", "left_semi").select(ids).distinct()
    return entries.join(hit, ids, "left_anti")
