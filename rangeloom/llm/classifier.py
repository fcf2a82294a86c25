"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes counts of hashed words, of triples of character classes, and of how much it repeats itself; word counts
are weighted by their inverse document frequency in the whole corpus. A truncated singular value decomposition of a
bounded sample of labelled texts gives the latent space. The labelled vectors (``SAMPLE`` of ``DIMENSIONS`` numbers at
most, whatever the corpus) go to every task; cosines of each document with all of them are exact products of blocks, and
the labels of the nearest vote with their similarity as weight.

Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1; nothing but the text enters a score.

Defined cases: null text is the empty text and gets a score; rows with repeated or null ids get a row each (a null id is
not held out, and no label is learned from it); without labels of both kinds every score is the share of label 1, or 0.5 without
labels; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import flat_bytes, in_small_batches, sub_batches, texts
from rangeloom.llm.tokens import span_hashes

#: Bounds of the labelled sample and of its latent space; neighbours that vote.
SAMPLE, DIMENSIONS, NEIGHBOURS = 4096, 64, 15
#: The sample takes rows of either label up to half of its size, least hash of the id first.
WORD_BITS = 11
WORDS = 1 << WORD_BITS
#: Character classes: lower, upper, digit, blank, line end and other controls, mark, symbol, beyond ASCII.
CLASSES = 8
TRIPLES = CLASSES**3
REPEATS = 8
DIM = WORDS + TRIPLES + REPEATS

_CLASS = np.full(256, 4, np.uint8)
for _chars, _c in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" ", 3), (".,;:'\"-()?/_", 5), ("!#*$%&|<>=+@[]{}~^`\\", 6)):
    _CLASS[[ord(x) for x in _chars]] = _c
_CLASS[128:] = 7
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of h in each document."""
    if not len(h):
        return np.zeros(n)
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.ones(len(x), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return np.bincount(d[new], minlength=n).astype(float)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """float32 [documents, DIM]: word counts, square roots of class triple shares, repetition."""
    n = len(offsets) - 1
    out = np.zeros((n, DIM), np.float32)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    if not len(data):
        return out
    c = _CLASS[data].astype(np.int64)
    code = c[:-2] * CLASSES * CLASSES + c[1:-1] * CLASSES + c[2:]
    same = owner[:-2] == owner[2:]
    triples = np.bincount(owner[:-2][same] * TRIPLES + code[same], minlength=n * TRIPLES).reshape(n, TRIPLES)
    out[:, WORDS : WORDS + TRIPLES] = np.sqrt(triples / np.maximum(1, triples.sum(axis=1, keepdims=True)))
    blank = _BLANK[data]
    edge = np.ones(len(data), bool)
    edge[1:] = blank[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(~blank & edge)
    stop = np.ones(len(data), bool)
    stop[:-1] = blank[1:] | (owner[1:] != owner[:-1])
    last = np.flatnonzero(~blank & stop) + 1
    h, doc = span_hashes(data, first, last), owner[first]
    out[:, :WORDS] = np.bincount(doc * WORDS + (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    total = np.bincount(doc, minlength=n).astype(float)
    share = [_distinct(doc, h, n) / np.maximum(1, total)]
    h3 = h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7)
    inside = doc[:-2] == doc[2:]
    share.append(_distinct(doc[:-2][inside], h3[inside], n) / np.maximum(1, total - 2))
    chars = np.bincount(doc, weights=last - first, minlength=n)
    sizes = [np.minimum(1, np.log1p(total) / 10), np.minimum(1, chars / np.maximum(1, total) / 20)]
    for k, x in enumerate([*share, *sizes]):
        out[:, WORDS + TRIPLES + 2 * k], out[:, WORDS + TRIPLES + 2 * k + 1] = np.sqrt(np.clip(x, 0, 1)), np.sqrt(1 - np.clip(x, 0, 1))
    return out


def weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Counts as vectors: words by tf-idf and unit length, at a fixed weight beside triples and repetition."""
    x = raw.copy()
    w = np.log1p(x[:, :WORDS]) * idf
    x[:, :WORDS] = 0.5 * w / np.maximum(1e-9, np.linalg.norm(w, axis=1, keepdims=True))
    return x


def latent_space(x: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    k = min(dimensions, *x.shape)
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(x.shape[1], k + 16))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :k]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))


def vote(vectors: np.ndarray, known: np.ndarray, labels: np.ndarray, neighbours: int) -> np.ndarray:
    """Share of label 1 among the nearest known vectors, weighted by the fourth power of their cosine."""
    k = min(neighbours, len(known))
    out = np.zeros(len(vectors))
    for i in range(0, len(vectors), 1024):
        s = vectors[i : i + 1024] @ known.T
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(s, near, axis=1), 0) ** 4 + 1e-6
        out[i : i + 1024] = (w * labels[near]).sum(axis=1) / w.sum(axis=1)
    return out


def remainder() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)), F.lit(0))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed word, over all rows, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(WORDS), 0
        for batch in batches:
            for b in _groups(batch):
                total += (counts(*flat_bytes(b.column(1)))[:, :WORDS] > 0).sum(axis=0)
                rows += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["n", "df"])

    parts = texts(docs).mapInArrow(run, "n long, df array<double>")
    summed = parts.select("n", F.posexplode("df").alias("i", "d")).groupBy("i").agg(F.sum("d").alias("d"), F.sum("n").alias("n")).collect()  # WORDS rows
    df = np.zeros(WORDS)
    for r in summed:
        df[r["i"]] = r["d"]
    return df, max((r["n"] for r in summed), default=0)


def _groups(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in sub_batches(batch):
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS):
    """(idf, latent space, known unit vectors, their labels) from at most ``sample`` labelled rows."""
    df, n = document_frequencies(docs)
    idf = (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)
    able = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (remainder() != 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id", F.lit(8))
    chosen = None
    for q in (0, 1):
        own = able.where(F.col("quality") == q).orderBy(order).limit(sample // 2)
        chosen = own if chosen is None else chosen.unionByName(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _groups(batch):
                x = weighted(counts(*flat_bytes(b.column(1))), idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in x])], names=["doc_id", "quality", "x"])

    rows = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("long").alias("quality"))
    got = rows.mapInArrow(run, "doc_id long, quality long, x binary")
    # one text for an id: repeated rows add nothing
    got = got.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    if not got:
        return idf, None, None, None
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32)
    y = np.array([r["quality"] for r in got], np.float64)
    space = latent_space(x, dimensions)
    return idf, space, unit(x @ space).astype(np.float32), y


def _scores(model, texts_: pa.Array) -> np.ndarray:
    idf, space, known, y = model
    if known is None or y.min() == y.max():
        return np.full(len(texts_), 0.5 if known is None else y[0])
    return vote(unit(weighted(counts(*flat_bytes(texts_)), idf) @ space), known, y, NEIGHBOURS)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample, dimensions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _groups(batch):
                score = _scores(model.value, b.column(1))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = texts(docs).withColumn("held_out", remainder() == 1)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> DataFrame:
    """The rows that classify predicts as 1, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample, dimensions))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                b = batch.slice(i, 512)
                yield b.filter(pa.array(_scores(model.value, b.column(at).fill_null("")) >= 0.5))

    return in_small_batches(docs).mapInArrow(run, docs.schema)
