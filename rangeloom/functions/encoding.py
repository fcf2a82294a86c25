"""Text and key forms of values: hex, timestamps, JSON, keys, names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_hex(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))


def from_hex(c: Column) -> Column:
    """Bytes of a hex text with or without 0x; null if it is not hex."""
    return F.try_to_binary(F.regexp_replace(c, "^0[xX]", ""), F.lit("hex"))


def hex_encode_binary(df: DataFrame) -> DataFrame:
    """Every binary column as 0x and lower-case hex digits."""
    return df.select([to_hex(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`") for f in df.schema])


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def from_nanoseconds(c: Column) -> Column:
    """A timestamp from nanoseconds since 1970; what is below a microsecond is cut off."""
    return F.timestamp_micros(F.call_function("div", c - F.pmod(c, F.lit(1000)), F.lit(1000)))


def parse_utc(c: Column) -> Column:
    """A timestamp from text that may end in the word UTC."""
    return F.try_to_timestamp(F.regexp_replace(c, r"\s*UTC$", "Z"))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def row_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A JSON object of the columns by name, nulls left out, bytes as hex digits."""
    kinds = {f.name: f.dataType for f in df.schema}
    names = sorted(columns or df.columns)
    return F.to_json(F.struct([(F.lower(F.hex(n)) if isinstance(kinds[n], T.BinaryType) else F.col(n)).alias(n) for n in names]))


def _key_part(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.BinaryType):
        return F.coalesce(F.substring(F.md5(name), 1, 8), F.lit("null"))
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def key_from_pattern(df: DataFrame, pattern: str, table: str, index: Column | None = None) -> Column:
    """A key from a template such as ``{table}:{id}``. Bytes enter as eight digits of their MD5, nulls as ``null``; a
    null ``id`` is an error. ``{index}`` is the row's number: ``index``, else one that is unique in the table. A template that
    names a column that is not there gives ``<table>:`` and the MD5 of all values."""
    if set(re.findall(r"\{(\w+)\}", pattern)) - {"table", "index", *df.columns}:
        return F.concat(F.lit(f"{table}:"), composite_key(df))
    parts = []
    for text, name in re.findall(r"([^{}]*)(?:\{(\w+)\})?", pattern):
        if text:
            parts.append(F.lit(text))
        if name == "table":
            parts.append(F.lit(table))
        elif name == "index" and "index" not in df.columns:
            parts.append((F.monotonically_increasing_id() if index is None else index).cast("string"))
        elif name:
            part = _key_part(df, name)
            if name == "id":
                part = F.when(F.col(name).isNotNull(), part).otherwise(F.raise_error(F.lit("a row has no id for its key")))
            parts.append(part)
    return F.concat(*parts)


def composite_key(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One column's value, several joined by a colon, or without columns the MD5 of all values."""
    if columns:
        return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    return F.md5(F.concat_ws(":", *[F.coalesce(F.hex(c) if isinstance(df.schema[c].dataType, T.BinaryType) else F.col(c).cast("string"), F.lit("null")) for c in df.columns]))


#: Fragments that mark an error as worth another try.
TRANSIENT = ["timeout", "429", "503", "504", "connection reset", "temporary failure", "service unavailable", "too many requests", "rate limit", "throttle", "connection error", "broken pipe", "connection refused", "timed out"]


def is_transient(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("|".join(map(re.escape, TRANSIENT))), F.lit(False))


def parse_reference(c: Column) -> Column:
    """namespace, name and version of ``namespace/name@version``."""
    part = lambda i: F.nullif(F.regexp_extract(c, r"^([^/@]+)/([^/@]+)@(.+)$", i), F.lit(""))
    return F.struct(part(1).alias("namespace"), part(2).alias("name"), part(3).alias("version"))


def format_reference(namespace: Column, name: Column, version: Column) -> Column:
    return F.concat(namespace, F.lit("/"), name, F.lit("@"), version)


def extract_fields(c: Column, schema: str) -> Column:
    """Fields of JSON text; null where a field or the object is missing."""
    return F.from_json(c, schema)


def indexer_rows(df: DataFrame, date: str, ident: str, value: str) -> DataFrame:
    """(date, id text, value double); what cannot be read as a date is null."""
    return df.select(F.col(date).try_cast("date").alias("date"), F.col(ident).cast("string").alias("id"), F.col(value).try_cast("double").alias("value"))
