"""Block ranges as columns: ids, JSON forms, tests.

A range is struct<network string, start bigint, end bigint, hash string, prev_hash string>; both ends belong to it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = T.StructType([T.StructField("network", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("hash", T.StringType()), T.StructField("prev_hash", T.StringType())])
RANGES = T.ArrayType(RANGE)
FIELDS = [f.name for f in RANGE]

_EITHER = "network string, start long, end long, numbers struct<start:long,end:long>, hash string, prev_hash string"


def make_range(network, start, end, hash=None, prev_hash=None) -> Column:  # noqa: A002
    """A range from columns or names; it is an error if it ends before it starts."""
    col = lambda c: F.lit(None).cast("string") if c is None else F.col(c) if isinstance(c, str) else c
    start, end = col(start).cast("long"), col(end).cast("long")
    checked = F.when(start <= end, end).otherwise(F.raise_error(F.lit("a range ends before it starts")))
    return F.struct(col(network).cast("string").alias("network"), start.alias("start"), checked.alias("end"), col(hash).cast("string").alias("hash"), col(prev_hash).cast("string").alias("prev_hash"))


def batch_id(r: Column) -> Column:
    """16 hex digits that name a range: a hash of its network, ends, end hash and parent hash."""
    bounds = F.concat_ws(":", r["network"], r["start"].cast("string"), r["end"].cast("string"))
    end_hash = F.coalesce(F.nullif(r["hash"], F.lit("")), F.sha2(bounds, 256))
    return F.substring(F.sha2(F.concat_ws(":", bounds, end_hash, F.coalesce(r["prev_hash"], F.lit(""))), 256), 1, 16)


def batch_id_list(ranges: Column) -> Column:
    """The ids of all ranges of a batch, in range order, joined by a bar."""
    return F.array_join(F.transform(ranges, batch_id), "|")


def ids_of(batch_ids: Column) -> Column:
    return F.split(batch_ids, r"\|")


def ranges_json(ranges: Column) -> Column:
    """All five fields of each range as a JSON list, nulls kept."""
    return F.to_json(ranges, {"ignoreNullFields": "false"})


def range_to_json(r: Column) -> Column:
    """One range as a JSON object; absent hashes are left out."""
    return F.to_json(r)


def _flat(x: Column) -> Column:
    return F.struct(x["network"].alias("network"), F.coalesce(x["numbers"]["start"], x["start"]).alias("start"), F.coalesce(x["numbers"]["end"], x["end"]).alias("end"), x["hash"].alias("hash"), x["prev_hash"].alias("prev_hash"))


def parse_range(text: Column) -> Column:
    """A range from JSON with its ends at the top or under ``numbers``."""
    return _flat(F.from_json(text, _EITHER))


def parse_metadata(text: Column) -> tuple[Column, Column]:
    """(ranges, ranges_complete) of a batch's metadata; text that is no metadata gives no ranges and completeness false."""
    found = F.from_json(text, f"ranges array<struct<{_nested()}>>, ranges_complete boolean")
    return F.coalesce(F.transform(found["ranges"], _flat), F.array().cast(RANGES)), F.coalesce(found["ranges_complete"], F.lit(False))


def _nested() -> str:
    return ", ".join(f"{n}:{t}" for n, t in (x.split(" ", 1) for x in _EITHER.split(", ")))


def contains_block(r: Column, block: Column) -> Column:
    return block.between(r["start"], r["end"])


def overlaps(a: Column, b: Column) -> Column:
    """Whether two ranges of one network share a block."""
    return (a["network"] == b["network"]) & (a["start"] <= b["end"]) & (b["start"] <= a["end"])
