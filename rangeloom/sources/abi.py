"""Event signatures from a contract's interface description (JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: How deep tuples may stand in tuples.
DEPTH = 6


def _part(depth: int) -> str:
    return "name:string,type:string,indexed:boolean" + (f",components:array<struct<{_part(depth - 1)}>>" if depth else "")


SCHEMA = f"type string, name string, anonymous boolean, inputs array<struct<{_part(DEPTH)}>>"


def _type(p: Column, depth: int, names: bool) -> Column:
    """The type of a parameter; a tuple's is made of its components', with or without their names."""
    if not depth:
        return p["type"]
    one = lambda c: F.concat_ws(" ", _type(c, depth - 1, names), c["name"]) if names else _type(c, depth - 1, names)
    inner = F.array_join(F.transform(p["components"], one), ", " if names else ",")
    return F.when(p["type"].startswith("tuple"), F.concat(F.lit("("), inner, F.lit(")"), F.substring(p["type"], 6, 1 << 20))).otherwise(p["type"])


def read_abi_events(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """name, signature (types, ``indexed`` and names) and canonical form (types) of the events, or of one event."""
    events = spark.read.schema(SCHEMA).option("multiLine", True).json(path).where("type = 'event'")
    if name is not None:
        events = events.where(F.col("name") == name)
    kind = lambda p: F.concat(_type(p, DEPTH, True), F.when(F.coalesce(p["indexed"], F.lit(False)), " indexed").otherwise(""))
    named = F.array_join(F.transform("inputs", lambda p: F.concat_ws(" ", kind(p), p["name"])), ", ")
    bare = F.array_join(F.transform("inputs", lambda p: _type(p, DEPTH, False)), ",")
    form = lambda body: F.concat(F.col("name"), F.lit("("), F.coalesce(body, F.lit("")), F.lit(")"))
    return events.select("name", form(named).alias("signature"), form(bare).alias("canonical"))
