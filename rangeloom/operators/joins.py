"""Joins with labels and between datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.encoding import from_hex

#: Largest label set, by Spark's own estimate, that is sent to every executor; a larger one is shuffled.
BROADCAST_BYTES = 64 << 20


def _sized(labels: DataFrame) -> DataFrame:
    """labels, to be broadcast if its estimated size allows it."""
    size = int(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(labels) if size <= BROADCAST_BYTES else labels


def align_key(data: T.DataType, label: T.DataType, key: Column) -> Column:
    """The data's key as the label's type: text to bytes if labels have bytes, bytes to hex digits if they have text."""
    if isinstance(label, T.BinaryType) and isinstance(data, T.StringType):
        return from_hex(key)
    if isinstance(label, T.StringType) and isinstance(data, T.BinaryType):
        return F.lower(F.hex(key))
    return key if data == label else key.cast(label)


def joined_schema(data: T.StructType, labels: T.StructType, label_key: str) -> T.StructType:
    """The data's fields, then the labels' but for the key and names that are there already."""
    have = {f.name for f in data}
    return T.StructType([*data.fields, *[f for f in labels if f.name != label_key and f.name not in have]])


def label_join(data: DataFrame, labels: DataFrame, label_key: str, data_key: str) -> DataFrame:
    """Inner join of data with labels: rows without a label drop, label columns follow, the label's key does not."""
    for name, df, what in ((label_key, labels, "labels"), (data_key, data, "data")):
        if name not in df.columns:
            raise ValueError(f"no column {name} in the {what}")
    more = [f.name for f in joined_schema(data.schema, labels.schema, label_key) if f.name not in data.columns]
    key = align_key(data.schema[data_key].dataType, labels.schema[label_key].dataType, F.col(f"d.`{data_key}`"))
    right = labels.select(F.col(f"`{label_key}`").alias("__key"), *[F.col(f"`{c}`") for c in more])
    joined = data.alias("d").join(_sized(right).alias("l"), key == F.col("l.__key"))
    return joined.select("d.*", *[F.col(f"l.`{c}`") for c in more])


def enrich_inner(a: DataFrame, b: DataFrame, on: Column | str | list[str]) -> DataFrame:
    return a.join(b, on, "inner")


def enrich_left_hourly(rows: DataFrame, hourly: DataFrame, ts: str, hour: str) -> DataFrame:
    """rows with the hourly columns of the hour they fall in, null where there is none."""
    return rows.join(hourly, F.date_trunc("hour", F.col(ts)) == F.col(hour), "left")
