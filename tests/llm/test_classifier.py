import math
import re
import zlib
from collections import Counter

import numpy as np

from rangeloom.llm import classifier
from rangeloom.llm.tokens import span_hashes


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_edge_cases(spark, edge, nothing):
    labels = labels_of(spark, [(1, 0, 0), (3, 1, 0), (4, 1, 0), (4, 1, 0), (5, None, 0), (6, 0, 1), (8, 0, 0), (9, 0, 0), (None, 1, 0)])
    got = classifier.classify(edge, labels).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r.doc_id for r in edge.collect()), key=str)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert classifier.classify(nothing, labels).count() == 0
    assert {r.score for r in classifier.classify(edge, labels_of(spark, [])).collect()} == {0.5}
    assert {r.score for r in classifier.classify(edge, labels_of(spark, [(i, 1, 0) for i in range(10)])).collect()} == {1.0}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", (1 - labels.quality) * (classifier.remainder() == 1).cast("int") + labels.quality * (classifier.remainder() != 1).cast("int"))
    one = classifier.classify(sample, labels).orderBy("doc_id").collect()
    assert one == classifier.classify(sample.selectExpr("doc_id", "text", "'x' as lang", "'y' as source"), flipped).orderBy("doc_id").collect()


def test_votes_equal_brute_force():
    r = np.random.default_rng(1)
    v, known, y = classifier.unit(r.standard_normal((50, 8))), classifier.unit(r.standard_normal((40, 8))), r.integers(0, 2, 40).astype(float)
    want = []
    for x in v:
        s = sorted(((float(x @ k), lab) for k, lab in zip(known, y, strict=True)), reverse=True)[:7]
        w = [max(c, 0) ** 4 + 1e-6 for c, _ in s]
        want.append(sum(a * b for a, (_, b) in zip(w, s, strict=True)) / sum(w))
    assert np.allclose(classifier.vote(v, known, y, 7), want)


def brute_vector(text):
    """The counts of one text by plain loops: words by hash, triples of character classes, repetition."""
    raw = text.encode()
    c = [int(classifier._CLASS[x]) for x in raw]
    triples = Counter(c[i] * 64 + c[i + 1] * 8 + c[i + 2] for i in range(len(c) - 2))
    out = np.zeros(classifier.DIM)
    for k, n in triples.items():
        out[classifier.WORDS + k] = math.sqrt(n / sum(triples.values()))
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", raw) if w]
    for w in words:
        h = int(span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
        out[h >> (64 - classifier.WORD_BITS)] += 1
    n, threes = len(words), [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    shares = [len(set(words)) / max(1, n), len(set(threes)) / max(1, n - 2), min(1, math.log1p(n) / 10), min(1, sum(map(len, words)) / max(1, n) / 20)]
    if raw:
        for k, x in enumerate(shares):
            out[classifier.WORDS + classifier.TRIPLES + 2 * k : classifier.WORDS + classifier.TRIPLES + 2 * k + 2] = math.sqrt(x), math.sqrt(1 - x)
    return out


def test_scores_equal_brute_force(spark, sample):
    """From the texts to the scores without the operator: vectors, document frequencies, an exact decomposition, sorted cosines."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    rows = [(r.doc_id, r.text or "") for r in sample.collect()]
    raw = {d: brute_vector(t) for d, t in rows}
    df = sum((v[: classifier.WORDS] > 0).astype(int) for v in raw.values())
    idf = np.log((len(rows) + 1) / (df + 1)) + 1

    def weighted(v):
        w = np.log1p(v[: classifier.WORDS]) * idf
        return np.concatenate([0.5 * w / max(1e-9, np.linalg.norm(w)), v[classifier.WORDS :]])

    x = {d: weighted(v) for d, v in raw.items()}
    known = sorted(d for d in labels if d in x)
    _, _, space = np.linalg.svd(np.stack([x[d] for d in known]), full_matrices=False)
    latent = {d: (y := space[: classifier.DIMENSIONS] @ v) / max(1e-9, np.linalg.norm(y)) for d, v in x.items()}
    got = {r.doc_id: r.score for r in classifier.classify(sample, spark.read.parquet("/root/testdata/sf0.001/labels.parquet")).collect()}
    off = []
    for d, v in latent.items():
        near = sorted(((float(v @ latent[k]), labels[k]) for k in known), reverse=True)[: classifier.NEIGHBOURS]
        w = [max(c, 0) ** 4 + 1e-6 for c, _ in near]
        off.append(abs(got[d] - sum(a * q for a, (_, q) in zip(w, near, strict=True)) / sum(w)))
    assert len(known) > 30 and np.mean(np.array(off) < 0.02) > 0.97  # the operator's decomposition is iterative and its vectors are halves
