"""Importance resampling of documents towards a target: hashed n-gram features, gains by bucket, a Gumbel draw.

Separators of a text collapse to single spaces; an overlapped regular expression then emits at each word the spans of the
runs of one to three words that begin there, and their CRC gives the bucket. The bucket numbers of a text are written
once and read for the weights, so the expression runs once over a text.

Null text has no words. A row is a document, also a repeated one; a null id is drawn as the empty id and comes after all ids.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rangeloom.llm.common import in_larger_tasks, release, stored, sub_batches, texts

BUCKETS = 10_000
LONGEST = 3
SEED = 42
#: Bytes of words: digits, letters (lower-cased) and all of UTF-8 beyond ASCII; the rest separates.
_BYTES = bytes(c | 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
CODES = "doc_id long, n_words long, codes binary"
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def gram_pattern(longest: int = LONGEST) -> regex.Pattern:
    """At every word: it, and each further word up to ``longest``, as groups of one span that begins and ends at words' bounds."""
    more = b""
    for _ in range(longest - 1):
        more = rb"(?:( [^ ]++)" + more + rb")?+"
    return regex.compile(rb"(?<![^ ])([^ ]++)" + more + rb"(?![^ ])")


def normalised(text: bytes) -> bytes:
    return b" ".join(text.translate(_BYTES).split())


def _codes(pattern: regex.Pattern, text: bytes, groups: tuple[int, ...], buckets: int) -> Iterator[int]:
    """The bucket of every n-gram of a normalised text; a longer one goes on from the CRC of the shorter."""
    crc = zlib.crc32
    for m in pattern.finditer(text, overlapped=True):
        h = 0
        for part in m.group(*groups):
            if part is None:
                break
            h = crc(part, h)
            yield h % buckets


def features(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """doc_id, n_words and the bucket numbers of all features (16 bits each) of every row."""
    pattern, groups = gram_pattern(longest), tuple(range(1, longest + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in sub_batches(batch):
                words, codes = [], []
                for t in b.column(1).to_pylist():
                    t = normalised(t.encode())
                    words.append(t.count(b" ") + 1 if t else 0)
                    codes.append(np.fromiter(_codes(pattern, t, groups, buckets), np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(codes, pa.binary())], names=["doc_id", "n_words", "codes"])
            release()

    own = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if len(groups) < 2:  # one group is not a tuple
        raise ValueError("features need runs of two words or more")
    if buckets > 1 << 16:
        raise ValueError("bucket numbers have 16 bits")
    return texts(own).mapInArrow(run, CODES)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds, over all rows: a task gives one row for each bucket it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for codes in b.column(0):
                total += np.bincount(np.frombuffer(codes.as_buffer(), np.uint16), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    parts = in_larger_tasks(found.select("codes")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most a row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of a bucket's smoothed share in the target over that in the source."""
    k, s, t = len(source), int(source.sum()), int(target.sum())
    ratios = (((int(b) + 1) * (s + k)) / ((int(a) + 1) * (t + k)) for a, b in zip(source, target, strict=True))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """A Gumbel variate in thousandths that the id fixes."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(found: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of ``features``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [np.frombuffer(x.as_buffer(), np.uint16) for x in b.column(2)]
            n = np.array([len(x) for x in codes], np.int64)
            weight = np.array([gain[x].sum() for x in codes], np.int64)
            score = weight + np.array([noise(i, seed) for i in b.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(weight), pa.array(score)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return found.mapInArrow(run, SCORED)


def ranked(rows: DataFrame, able: Column, order: list[Column], share: tuple[int, int]) -> DataFrame:
    """rows with ``rank`` (from 1, in the order) of the first ``share`` of the able rows; null for all others.

    Rows are dealt by ranges of the order and written with their range's number; a row's rank is its place in its range after the
    rows of the ranges before it, so no task sees the whole order.
    """
    first = [F.col("able").desc(), *order]
    dealt = stored(rows.withColumn("able", able).repartitionByRange(*first).withColumn("part", F.spark_partition_id()))
    each = dealt.groupBy("part").agg(F.count("*").alias("n"), F.count_if("able").alias("n_able")).collect()  # a row for each range
    before, at = {}, 0
    for r in sorted(each, key=lambda r: r["part"]):
        before[r["part"]], at = at, at + r["n"]
    wanted = sum(r["n_able"] for r in each) * share[0] // share[1]
    base = rows.sparkSession.createDataFrame(list(before.items()), "part int, base long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*first)) + F.col("base")
    out = dealt.join(F.broadcast(base), "part").withColumn("rank", place.cast("long"))
    return out.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).drop("part", "base", "able")


def resample(docs: DataFrame, target: DataFrame, least_words: int = 20, share: tuple[int, int] = (5, 100), buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs; target: rows with ``text``."""
    found = stored(features(docs, buckets))
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(target.withColumn("doc_id", F.lit(0)), buckets), buckets))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features"), F.col("n_words")]
    return ranked(scored(found, gain, seed), F.col("n_words") >= least_words, order, share)
