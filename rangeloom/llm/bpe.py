"""Byte-level BPE encoding and decoding with overlapping chunks.

A long text is cut into chunks that overlap, and the chunks are pre-tokenised in parallel, each from its own first
character. The first boundary in an overlap that both neighbours have is where they resynchronise: the pattern has no
memory, so from a common boundary on both give the same pieces, and each piece belongs to one chunk. Boundaries near the
end of a chunk, where the pattern cannot see what follows, are not used. Pieces are then encoded by the ranks, every
distinct stretch between certain boundaries once (rangeloom.llm.tokens). Decoding concatenates the bytes of the ranks.
Neighbours without a common boundary (a piece longer than the overlap, say) get chunks and overlaps GROWTH times as long, until
they meet; a text that is one chunk is encoded as it is. Ids and bytes of a text's pieces reach one task in order and are digested as they pass.

Defined cases: null text is the empty text, no tokens; rows with repeated or null ids are encoded each; an empty table
gives an empty result; other columns are ignored; names of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import flat_bytes, shuffle_partitions, stored, sub_batches, table, texts
from rangeloom.llm.tokens import UnitEncoder, encoder_path

#: Characters of a chunk before its overlap, and of the overlap.
CHUNK, OVERLAP, GROWTH = 1 << 14, 1 << 10, 8
#: The longest fixed alternative of the pattern looks this far ahead.
AHEAD = 3

_CODERS: dict = {}


class Coder:
    """Encoder and decoder for a rank file; one for each worker process."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = public_tokenizers.PATTERN
        self.tiktoken = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        self.units = UnitEncoder(lambda units: [self.tiktoken.encode_ordinary(u) for u in units])
        self.first = np.zeros(max(ranks.values()) + 2, np.int64)
        for piece, i in ranks.items():
            self.first[i + 1] = len(piece)
        self.first = np.cumsum(self.first)
        self.bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The concatenated bytes of ids, and the offsets of the texts in them."""
        size = self.first[ids + 1] - self.first[ids]
        out = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[np.repeat(self.first[ids] - out[:-1], size) + np.arange(out[-1])], out[offsets]


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def boundaries(pattern, text: str) -> list[int]:
    """Ends of the pre-tokens of a text that starts at a boundary or at a chunk's first character."""
    return [m.end() for m in pattern.finditer(text)]


RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
SEGMENTS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
SEGMENTS_DDL = "uid long, doc_id long, k long, ids binary, decoded binary"
CHUNKS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int64()), ("text", pa.string())])
CHUNKS_DDL = "uid long, doc_id long, k long, text string"


def _whole(path: str):
    """Encodes and decodes uncut texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for b in sub_batches(batch):
                ids, at = c.units.encode(*flat_bytes(b.column(1)))
                back, end = c.decode(ids, at)
                raw, back = ids.astype("<u4").tobytes(), back.tobytes()
                sha = lambda buffer, o, w=1: [hashlib.sha256(buffer[a * w : z * w]).hexdigest() for a, z in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
                yield table(RESULT, doc_id=b.column(0), n_tokens=np.diff(at), ids_sha256=sha(raw, at, 4), decoded_sha256=sha(back, end))

    return run


def _chunks(chunk: int, overlap: int):
    """Rows (doc_id, text) in chunks; uid tells the rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                for at in range(0, len(text), chunk * 64):
                    parts = [text[a : a + chunk + overlap] for a in range(at, min(len(text), at + chunk * 64), chunk)]
                    n = len(parts)
                    yield table(CHUNKS, uid=[uid] * n, doc_id=[doc] * n, k=np.arange(n) + at // chunk, text=parts)
                uid += 1

    return run


def _overlaps(chunk: int, overlap: int, pattern: str):
    """Adds the boundaries in a chunk's first overlap and in its last, as positions after the overlap's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled = regex.compile(pattern)
        for b in batches:
            head, tail = [], []
            for text in b.column(3).to_pylist():
                found = boundaries(compiled, text)
                head.append([0, *(x for x in found if x < overlap)])
                sure = len(text) - AHEAD
                tail.append([x - chunk for x in found[:-1] if chunk <= x <= sure])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], names=[*b.schema.names, "head", "tail"])

    return run


def _segments(path: str, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for b in sub_batches(batch):
                own = [t[a:] if z is None else t[a : chunk + z] for t, a, z in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)), strict=True)]
                ids, at = c.units.encode(*flat_bytes(pa.array(own, pa.string())))
                back, end = c.decode(ids, at)
                raw, back = ids.astype("<u4").tobytes(), back.tobytes()
                part = lambda buffer, o, w=1: [buffer[x * w : y * w] for x, y in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
                yield table(SEGMENTS, uid=b.column(0), doc_id=b.column(1), k=b.column(2), ids=part(raw, at, 4), decoded=part(back, end))

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text from its segments, which come in order of uid and k."""
    uid, doc, n, ids, back = None, None, 0, None, None
    for b in batches:
        rows = []
        for own, own_doc, x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), b.column(4), strict=True):
            if own != uid:
                if uid is not None:
                    rows.append((doc, n, ids.hexdigest(), back.hexdigest()))
                uid, doc, n, ids, back = own, own_doc, 0, hashlib.sha256(), hashlib.sha256()
            ids.update(x.as_buffer())
            back.update(y.as_buffer())
            n += x.as_buffer().size // 4
        if rows:
            yield table(RESULT, **dict(zip(RESULT.names, zip(*rows, strict=True), strict=True)))
    if uid is not None:
        yield table(RESULT, doc_id=[doc], n_tokens=[n], ids_sha256=[ids.hexdigest()], decoded_sha256=[back.hexdigest()])


def encode_and_decode(docs: DataFrame, ranks: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    import public_tokenizers

    if not 4 * AHEAD < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk and longer than the pattern looks ahead")
    path = ranks or encoder_path("byte_bpe_multi_50k.tiktoken")
    docs, out, left = texts(docs), None, True
    n = shuffle_partitions(docs.sparkSession)
    key = ["uid", "k"]
    while left:
        size = F.length("text")
        short = docs.where(size <= chunk).mapInArrow(_whole(path), RESULT_DDL)
        out = short if out is None else out.unionByName(short)
        cuts = docs.where(size > chunk).mapInArrow(_chunks(chunk, overlap), CHUNKS_DDL).repartition(n, *key)
        cuts = stored(cuts.mapInArrow(_overlaps(chunk, overlap, public_tokenizers.PATTERN), CHUNKS_DDL + ", head array<int>, tail array<int>"))
        # neighbours meet by a join on (text, chunk): no window needs a text's chunks in one task
        tails = cuts.select("uid", (F.col("k") + 1).alias("k"), F.col("tail").alias("before"))
        meet = stored(cuts.select(*key, "head").join(tails, key).select(*key, F.array_min(F.array_intersect("head", "before")).alias("at")))
        lost = meet.where("at is null").select("uid").distinct()
        left = not lost.isEmpty()
        own = cuts.join(lost, "uid", "left_anti") if left else cuts
        bounds = meet.select(*key, F.col("at").alias("first"), F.lit(None).cast("int").alias("last")).unionByName(meet.select("uid", (F.col("k") - 1).alias("k"), F.lit(None).cast("int").alias("first"), F.col("at").alias("last")))
        bounds = bounds.groupBy(*key).agg(F.max("first").alias("first"), F.max("last").alias("last"))
        own = own.join(bounds, key, "left").select("uid", "doc_id", "k", "text", F.coalesce("first", F.lit(0)).alias("first"), "last")
        parts = own.mapInArrow(_segments(path, chunk), SEGMENTS_DDL)
        out = out.unionByName(parts.repartition(n, "uid").sortWithinPartitions("uid", "k").mapInArrow(_digested, RESULT_DDL))
        if left:  # those texts again, from their chunks' own parts, in longer ones
            whole = cuts.join(lost, "uid", "left_semi").groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("k", F.substring("text", 1, chunk).alias("part")))).alias("x"))
            docs = stored(whole.select("doc_id", F.array_join("x.part", "").alias("text")))
            chunk, overlap = chunk * GROWTH, overlap * GROWTH
    return out
