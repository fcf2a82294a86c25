"""Token counts by scanning flat token files for separators.

A token file is a run of little-endian unsigned ids with nothing else: an end-of-document id after every document and no
index. The scan cuts files into blocks of bytes without regard to documents, finds separators in each block with one
vector comparison, and stitches: a prefix scan over the blocks of a file gives the number of documents before a block
and the place of the last separator before it, so the document that runs into a block gets its full length.

Defined cases: null text is the empty text, 0 tokens; rows with repeated or null ids are counted each; an empty table gives an
empty result; other columns are ignored; the name of a special token in a text is ordinary text, so no text can hold a
separator. Ids after the last separator of a file are an unfinished document and are not counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeloom.llm.common import cut, flat_bytes, new_folder, shuffle_partitions, sub_batches, table, texts
from rangeloom.llm.files import make_folder, opened, size_of, written_whole
from rangeloom.llm.tokens import encode_column, encoder_path, hub_encoder

END_ID = 50256
BLOCK_BYTES = 8 << 20


def write_flat(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, width: int = 2) -> DataFrame:
    """Writes a token file for each partition; returns file, ordinal, doc_id of every document, in file order."""
    path = tokenizer or encoder_path("byte_bpe_50k.json")
    schema = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"{folder}/{TaskContext.get().partitionId():06d}.bin"
        encoder, ordinal = hub_encoder(path, special_is_text=True), 0
        known = encoder.tokenizer
        if max(end_id, known.get_vocab_size() - 1) >= 1 << 8 * width:
            raise ValueError(f"ids of this vocabulary need more than {width} bytes")
        if end_id < known.get_vocab_size() and end_id not in known.get_added_tokens_decoder():
            raise ValueError(f"id {end_id} is no separator: texts can hold it")
        with written_whole(name) as out:
            for batch in batches:
                for b in sub_batches(batch):
                    ids, offsets = encode_column(encoder, *flat_bytes(b.column(1)))
                    flat = np.insert(ids.astype(f"<u{width}"), offsets[1:], end_id)
                    out.write(flat.tobytes())
                    n = b.num_rows
                    yield table(schema, file=[name] * n, ordinal=np.arange(ordinal, ordinal + n), doc_id=b.column(0))
                    ordinal += n

    make_folder(folder)
    return cut(texts(docs).mapInArrow(run, "file string, ordinal long, doc_id long"))


def scan(spark, files: DataFrame, end_id: int = END_ID, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, ordinal, n_tokens of every document of the flat token files named in files.file."""
    step = block_bytes // width * width
    sizes = files.select("file").distinct().mapInArrow(_sizes, "file string, bytes long")
    blocks = sizes.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(step))).alias("at"))
    blocks = blocks.repartition(shuffle_partitions(spark), "file", "at")
    schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("found", pa.int64()), ("last", pa.int64()), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with opened(r["file"]) as f:
                    f.seek(r["at"])
                    ids = np.frombuffer(f.read(min(step, r["bytes"] - r["at"])), f"<u{width}")
                ends = np.flatnonzero(ids == end_id) + r["at"] // width
                yield table(schema, file=[r["file"]], at=[r["at"]], found=[len(ends)], last=[int(ends[-1]) if len(ends) else None], counts=[np.diff(ends, prepend=-1) - 1])

    found = cut(blocks.mapInArrow(run, "file string, at long, found long, last long, counts array<long>"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    base = found.select("file", "at", F.coalesce(F.sum("found").over(before), F.lit(0)).alias("base"), F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("prior"))
    rows = found.join(base, ["file", "at"]).select("file", "base", "prior", F.posexplode("counts").alias("k", "n"))
    carried = F.when(F.col("k") == 0, F.col("prior") + 1).otherwise(0)  # the first count of a block is from the file's start
    return rows.select("file", (F.col("base") + F.col("k")).alias("ordinal"), (F.col("n") - carried).alias("n_tokens"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([size_of(x) for x in names], pa.int64())], names=["file", "bytes"])


def count_tokens(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    """doc_id and n_tokens (without the end id) of every row, counted from flat token files written for it."""
    spark = docs.sparkSession
    own = write_flat(docs, folder or new_folder(spark, "tokens"), tokenizer)
    return own.join(scan(spark, own), ["file", "ordinal"]).select("doc_id", "n_tokens")
