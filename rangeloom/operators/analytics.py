"""Aggregates of block data, pages of results, and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tx_per_block(df: DataFrame, block: str) -> DataFrame:
    return df.groupBy(block).agg(F.count("*").alias("tx_count"))


def latest_by(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """The value of each key's last row in the order."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def owner_holdings(latest: DataFrame, token: str, owner: str) -> DataFrame:
    """Each owner's tokens, sorted, and their number."""
    return latest.groupBy(owner).agg(F.sort_array(F.collect_list(token)).alias("tokens"), F.count(token).alias("token_count"))


def top_labels(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The n most frequent combinations; ties by the columns."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), *columns).limit(n)


def rows_per_batch(df: DataFrame) -> DataFrame:
    return df.groupBy("_batch_id").agg(F.count("*").alias("row_count"))


def list_page(df: DataFrame, sort: str, page: int = 1, size: int = 50, descending: bool = False, ties: list[str] | None = None) -> DataFrame:
    """A page (from 1) in sorted order, with the total and whether another page follows."""
    order = [F.desc(sort) if descending else F.asc(sort), *map(F.asc, ties or [])]
    total = df.agg(F.count("*").alias("total"))
    rows = df.orderBy(*order).offset((page - 1) * size).limit(size)
    return rows.join(F.broadcast(total)).withColumn("has_next", F.col("total") > page * size)


def keyset_page(df: DataFrame, key: str, after=None, size: int = 50) -> DataFrame:
    """The next rows after a key."""
    return (df if after is None else df.where(F.col(key) > after)).orderBy(key).limit(size)


def keyword_search(df: DataFrame, ident: str, text: str, query: str, n: int = 50) -> DataFrame:
    """ident and score of the n best texts: sum over the query's words of count times ln(1 + texts / texts with the
    word). Words are runs of letters and digits, without regard to case. The scoring is this library's own. All texts are scanned; for
    many queries see rangeloom.operators.text_index."""
    words = sorted({w for w in query.lower().split() if w})
    # a text's other words are dropped before its words become rows
    hits = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w.isin(words))
    found = df.select(ident, F.explode(hits).alias("word"))
    tf = found.groupBy(ident, "word").agg(F.count("*").alias("tf"))
    n_texts = df.agg(F.count("*").alias("n_texts"))
    idf = tf.groupBy("word").agg(F.count("*").alias("df")).join(F.broadcast(n_texts)).select("word", F.log1p(F.col("n_texts") / F.col("df")).alias("idf"))  # a row for each word of the query
    scores = tf.join(F.broadcast(idf), "word").groupBy(ident).agg(F.sum(F.col("tf") * F.col("idf")).alias("score"))
    return scores.orderBy(F.desc("score"), ident).limit(n)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def semantic_search(df: DataFrame, ident: str, vector: str, query: Column, n: int = 50) -> DataFrame:
    """ident and cosine similarity of the n nearest vectors, by one scan; for many queries see rangeloom.operators.vectors."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    v, length = F.col(vector), df.sparkSession.range(1).select(F.sqrt(dot(query, query))).first()[0]  # the query's own, once
    return df.select(ident, (dot(v, query) / (F.sqrt(dot(v, v)) * F.lit(length))).alias("similarity")).orderBy(F.desc("similarity"), ident).limit(n)
