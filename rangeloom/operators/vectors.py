"""Exact nearest vectors by cosine for many queries: clusters that bounds rule out are not compared.

Vectors of length one lie at the Euclidean distance sqrt(2 - 2 cosine), for which the triangle inequality holds: a vector at
distance r from its cluster's centre is no nearer to a query than the difference of r and the query's distance from the centre. Clusters are stored in
blocks of at most BLOCK vectors, by distance from the centre, so that a block is a thin shell with two bounds. A query first meets the nearest
clusters that hold n vectors; the n-th of these tells which other clusters, and which blocks of them, could have a nearer one. Those are compared in
matrix products of a block and up to CHUNK queries. Centres come from a bounded sample; whatever they are, the result is that of comparing all.

Vectors that are null or zero, or hold a null or NaN, have no cosine and are left out, as queries and as results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK, CHUNK = 2048, 512
#: Rows that centres are fitted on, and the most clusters: both are held by the driver and every worker.
SAMPLE, MOST = 20_000, 1024
#: Parts that a cluster is dealt to while it is cut into blocks.
PARTS = 8
SLACK = 1e-9


def _lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, added up from the first to the last number."""
    return np.sqrt((x * x).cumsum(axis=1)[:, -1]) if x.shape[1] else np.zeros(len(x))


def _matrix(raw: pa.Scalar, dimensions: int) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, dimensions)


def usable(df: DataFrame, ident: str, vector: str) -> DataFrame:
    """id and v (doubles) of the vectors that have a cosine."""
    v = F.col(vector).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return df.where(fine).select(F.col(ident).alias("id"), v.alias("v"))


def centres(rows: DataFrame, clusters: int | None = None, sample: int = SAMPLE) -> np.ndarray:
    """Centres of clusters: some rounds of k-means on a sample that the ids' hashes choose."""
    got = rows.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(sample).select("v").toArrow().column(0)
    x = np.array(got.to_pylist(), np.float64)
    if not len(x):
        return np.zeros((0, 1))
    x /= _lengths(x)[:, None]
    k = min(MOST, len(x), clusters or max(1, math.isqrt(len(x))))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(8):
        near = np.argmax(x @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)
        for j in np.unique(near):
            c[j] = x[near == j].mean(axis=0)
    return c


def _distances(unit: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 1 + (c * c).sum(axis=1) - 2 * unit @ c.T))


class VectorIndex:
    """Blocks of clusters below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.blocks = spark, spark.read.parquet(f"{path}/blocks")
        found = spark.read.parquet(f"{path}/centres").orderBy("cluster").collect()  # MOST rows at most
        self.centres = np.array([r["v"] for r in found], np.float64).reshape(len(found), -1)

    @staticmethod
    def build(df: DataFrame, ident: str, vector: str, path: str, clusters: int | None = None, sample: int = SAMPLE, block: int = BLOCK) -> None:
        spark, rows = df.sparkSession, usable(df, ident, vector)
        c = centres(rows, clusters, sample)
        spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(c)], "cluster int, v array<double>").coalesce(1).write.parquet(f"{path}/centres")
        shared, dimensions = spark.sparkContext.broadcast(c), c.shape[1]
        kind = rows.schema["id"].dataType

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, -1)
                if x.shape[1] != dimensions:
                    raise ValueError(f"vectors of {x.shape[1]} and of {dimensions} numbers")
                d = _distances(x / _lengths(x)[:, None], shared.value)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], names=["id", "v", "cluster", "r"])

        schema = T.StructType([rows.schema["id"], rows.schema["v"], T.StructField("cluster", T.IntegerType()), T.StructField("r", T.DoubleType())])
        placed = rows.mapInArrow(assign, schema).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
        dealt = placed.repartition("cluster", "part").sortWithinPartitions("cluster", "part", "r").select("id", "v", "cluster", "r", "part")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, key = [], None

            def packed() -> pa.RecordBatch:
                x, r = np.array([h[1] for h in held], np.float64), [h[2] for h in held]
                return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([len(held)], pa.int32()), pa.array([min(r)]), pa.array([max(r)]), pa.array([[h[0] for h in held]]), pa.array([x.tobytes()])], names=["cluster", "n", "near", "far", "ids", "m"])

            for b in batches:
                for i, v, cluster, r, part in zip(*(x.to_pylist() for x in b.columns), strict=True):
                    if held and ((cluster, part) != key or len(held) == block):
                        yield packed()
                        held = []
                    key = (cluster, part)
                    held.append((i, v, r))
            if held:
                yield packed()

        out = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("near", T.DoubleType()), T.StructField("far", T.DoubleType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("m", T.BinaryType())])
        dealt.mapInArrow(cut, out).write.parquet(f"{path}/blocks")

    def _visits(self, queries: DataFrame, n: int, sizes: np.ndarray, far: np.ndarray, floors: bool) -> DataFrame:
        """(cluster, id, v, least) of the clusters that a query meets: the nearest ones that hold n vectors, or with ``least`` (the cosine of the n-th
        of these) all others that could have a nearer one."""
        shared = self.spark.sparkContext.broadcast((self.centres, sizes, far))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, count, radius = shared.value
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.array(b.column(1).to_pylist(), np.float64)
                d = _distances(x / _lengths(x)[:, None], c)
                order = np.argsort(d, axis=1, kind="stable")
                before = np.cumsum(count[order], axis=1) - count[order]
                first = np.zeros(d.shape, bool)
                np.put_along_axis(first, order, before < n, axis=1)
                if floors:
                    least = np.asarray(b.column(2))
                    reach = np.sqrt(np.maximum(0, 2 - 2 * least)) + SLACK
                    met = ~first & (d - radius <= reach[:, None])
                else:
                    least, met = np.full(len(x), -np.inf), first
                q, k = np.nonzero(met & (count > 0))
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), b.column(0).take(pa.array(q)), b.column(1).take(pa.array(q)), pa.array(least[q].astype(np.float64))], names=["cluster", "id", "v", "least"])

        kind = T.StructType([T.StructField("cluster", T.IntegerType()), queries.schema["id"], queries.schema["v"], T.StructField("least", T.DoubleType())])
        return queries.mapInArrow(run, kind)

    def _compared(self, visits: DataFrame, n: int) -> DataFrame:
        """query_id, id, similarity of each block's best for each query that meets it, and ``compared`` on a row of its own for each product."""
        c = self.spark.sparkContext.broadcast(self.centres)
        chunk = F.floor((F.row_number().over(Window.partitionBy("cluster", "salt").orderBy("id")) - 1) / CHUNK)
        salted = visits.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(PARTS))).withColumn("chunk", chunk)
        chunks = salted.groupBy("cluster", "salt", "chunk").agg(F.collect_list(F.struct("id", "v", "least")).alias("asked"))  # CHUNK queries at most
        met = self.blocks.join(chunks.select("cluster", "asked"), "cluster")
        query_kind, kind = visits.schema["id"].dataType, self.blocks.schema["ids"].dataType.elementType
        dimensions = self.centres.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    cluster, near, far = (b.column(k)[i].as_py() for k in (0, 2, 3))
                    m, asked = _matrix(b.column(5)[i], dimensions), b.column(6)[i].as_py()
                    q, least = np.array([a["v"] for a in asked], np.float64), np.array([a["least"] for a in asked])
                    lengths, own = _lengths(q), _lengths(m)
                    d = _distances(q / lengths[:, None], c.value[cluster : cluster + 1])[:, 0]
                    bound = np.maximum(d - far, near - d)
                    live = np.flatnonzero(bound <= np.sqrt(np.maximum(0, 2 - 2 * np.maximum(least, -1))) + SLACK)
                    ids, rows = b.column(4)[i].values, ([], [], [])
                    s = (q[live] / lengths[live, None]) @ (m / own[:, None]).T
                    k = min(n, len(m))
                    for row, j in zip(s, live.tolist(), strict=True):
                        floor = max(np.partition(row, len(row) - k)[len(row) - k], least[j]) - SLACK
                        at = np.flatnonzero(row >= floor)
                        # in the order in which SQL adds, so that equal vectors have equal cosines
                        exact = (m[at] * q[j]).cumsum(axis=1)[:, -1] / (own[at] * lengths[j])
                        rows[0].extend([asked[j]["id"]] * len(at))
                        rows[1].extend(at.tolist())
                        rows[2].extend(exact.tolist())
                    done = pa.array([None] * len(rows[0]) + [len(live) * len(m)], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([*rows[0], None], query_arrow), ids.take(pa.array([*rows[1], None], pa.int64())), pa.array([*rows[2], None], pa.float64()), done], names=["query_id", "id", "similarity", "compared"])

        out = T.StructType([T.StructField("query_id", query_kind), T.StructField("id", kind), T.StructField("similarity", T.DoubleType()), T.StructField("compared", T.LongType())])
        from pyspark.sql.pandas.types import to_arrow_type

        query_arrow = to_arrow_type(query_kind)
        return met.select("cluster", "n", "near", "far", "ids", "m", "asked").mapInArrow(run, out)

    def search_each(self, queries: DataFrame, ident: str, vector: str, path: str, n: int = 50, name: str | None = None) -> tuple[DataFrame, dict]:
        """(query_id, ``name``, rank and similarity of the n nearest vectors of each query; pairs compared, and of how many). What the two rounds
        compared is written below ``path``."""
        name = name or ident
        asked = usable(queries, ident, vector)
        stats = self.blocks.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("far").alias("far")).collect()  # MOST rows at most
        sizes, far = np.zeros(len(self.centres), np.int64), np.zeros(len(self.centres))
        for r in stats:
            sizes[r["cluster"]], far[r["cluster"]] = r["n"], r["far"]
        order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
        best = lambda df: df.where("compared IS NULL").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
        self._compared(self._visits(asked, n, sizes, far, False), n).write.parquet(f"{path}/first")
        first = self.spark.read.parquet(f"{path}/first")
        floors = best(first).groupBy("query_id").agg(F.min("similarity").alias("least"), F.count("*").alias("k"))
        known = asked.join(floors, F.col("id") == F.col("query_id")).select("id", "v", F.when(F.col("k") == n, F.col("least")).otherwise(-1.0).alias("least"))
        self._compared(self._visits(known, n, sizes, far, True), n).write.parquet(f"{path}/second")
        both = first.unionByName(self.spark.read.parquet(f"{path}/second"))
        done = both.agg(F.sum("compared")).first()[0] or 0
        return best(both).select("query_id", F.col("id").alias(name), "rank", "similarity"), {"compared": done, "of": asked.count() * int(sizes.sum())}
