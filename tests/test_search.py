"""Searches by index: equal to scoring every row, with less read."""

import numpy as np
from pyspark.sql import functions as F

from rangeloom.operators import analytics, text_index, vectors

FOLDER = "/root/testdata/sf0.01"


def test_keyword_index_equals_the_scan_and_stops_early(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(10_000, None), (10_001, ""), (10_002, "License LICENSE license!")], "doc_id long, text string"))
    text_index.build(docs, "doc_id", "text", f"file://{tmp_path}/i", slab=20)
    index, least = text_index.TextIndex(spark, f"file://{tmp_path}/i"), 1.0
    for query, n in (("the license stupid", 10), ("license", 5), ("the", 3), ("license nowhereatall", 2000), ("nowhereatall", 5), ("", 5)):
        got, read = index.search(query, "doc_id", n)
        want = analytics.keyword_search(docs, "doc_id", "text", query, n)
        rows = lambda df: [(r.doc_id, round(r.score, 9)) for r in df.orderBy(F.round("score", 9).desc(), "doc_id").collect()]
        assert rows(got) == rows(want), query
        assert read["postings"] <= read["of"]
        least = min(least, read["postings"] / max(1, read["of"]))
    assert least < 0.5
    plan = index.postings.where(F.col("word").isin(["license"])).select("n")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(word,license)" in plan or "In(word" in plan


def brute(x, ids, queries, n):
    out = set()
    for q in queries:
        c = [(-round(float(np.dot(x[i], x[q]) / np.linalg.norm(x[i]) / np.linalg.norm(x[q])), 9), ids[i]) for i in range(len(x))]
        out |= {(ids[q], k + 1, i, -s) for k, (s, i) in enumerate(sorted(c)[:n])}
    return out


def test_clustered_vectors_are_mostly_skipped(spark, tmp_path):
    r = np.random.default_rng(1)
    spots = r.standard_normal((25, 16)) * 4
    x = np.concatenate([s + 0.2 * r.standard_normal((60, 16)) for s in spots])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    extra = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [None] + [1.0] * 15)]
    df = spark.createDataFrame(rows + extra, "i long, e array<double>")
    vectors.VectorIndex.build(df, "i", "e", f"file://{tmp_path}/i", block=32)
    got, share = vectors.VectorIndex(spark, f"file://{tmp_path}/i").search_each(df.where("i % 100 = 0"), "i", "e", f"file://{tmp_path}/s", 10)
    assert {(g.query_id, g["rank"], g.i, round(g.similarity, 9)) for g in got.collect()} == brute(x, list(range(len(x))), range(0, 1500, 100), 10)
    assert share["of"] == 15 * 1500 and share["compared"] < 0.4 * share["of"]


def test_any_vectors_and_ties(spark, tmp_path):
    r = np.random.default_rng(2)
    x = np.concatenate([r.standard_normal((200, 5)), np.tile(r.standard_normal((1, 5)), (90, 1)), -np.ones((1, 5))])
    df = spark.createDataFrame([(f"k{i:04d}", v.tolist()) for i, v in enumerate(x)], "key string, e array<float>")
    x = x.astype(np.float32).astype(np.float64)
    for name, how in (("a", {"clusters": 7, "block": 16}), ("b", {"clusters": 1}), ("c", {"sample": 3})):
        vectors.VectorIndex.build(df, "key", "e", f"file://{tmp_path}/{name}", **how)
        found, _ = vectors.VectorIndex(spark, f"file://{tmp_path}/{name}").search_each(df.where("key IN ('k0000', 'k0210', 'k0290')"), "key", "e", f"file://{tmp_path}/{name}s", 40)
        want = brute(x, [f"k{i:04d}" for i in range(len(x))], (0, 210, 290), 40)
        assert {(g.query_id, g["rank"], g.key, round(g.similarity, 9)) for g in found.collect()} == want
    assert vectors.VectorIndex(spark, f"file://{tmp_path}/a").search_each(df.limit(0), "key", "e", f"file://{tmp_path}/none", 4)[0].count() == 0
