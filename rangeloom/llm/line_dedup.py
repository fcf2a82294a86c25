"""Lines that many documents share: dropped from all of them but the last.

Normalised lines are exploded and hashed, the documents of each hash are counted, the lines of frequent hashes are found
again by a join on the hash, and a text is reassembled from the positions that are left. Only hashes, ids and positions go
through the shuffles of lines; a text is shuffled once, to meet its positions.

A row is a document, also a repeated one. Null text is one empty line. Rows without an id come before all others: they keep a
frequent line only if no row with an id holds it. Rows that share the greatest id all keep it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import stored, sub_batches, texts

WHITE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUT = "doc_id long, n_lines long, n_dropped long, kept string"


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _digest(key: Column) -> Column:
    """128 bits of a key, as two hashes of different seeds."""
    return F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(13), key).alias("g"))


def frequent_lines(rows: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """h, g and the greatest doc_id of the keys that at least ``least_docs`` rows hold."""
    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), line_key), lambda k: F.char_length(k) >= least_chars))
    each = rows.select("doc_id", F.explode(keys).alias("key")).select("doc_id", _digest(F.col("key")).alias("d")).select("doc_id", "d.h", "d.g")
    return each.groupBy("h", "g").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= least_docs).drop("docs")


def drop_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is kept, of every row."""
    rows = texts(docs)
    # as files, so that Spark knows its size: it is broadcast below the session's threshold, else joined by a shuffle
    frequent = stored(frequent_lines(rows, least_chars, least_docs))
    own = rows.withColumn("row", F.xxhash64("text"))
    lines = own.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    lines = lines.select("doc_id", "row", "position", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    met = lines.select("doc_id", "row", "position", _digest(F.col("key")).alias("d")).select("doc_id", "row", "position", "d.h", "d.g")
    gone = met.join(frequent, ["h", "g"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    gone = gone.groupBy("doc_id", "row").agg(F.collect_set("position").alias("gone")).withColumnsRenamed({"doc_id": "gone_id", "row": "gone_row"})
    both = own.join(gone, (F.col("row") == F.col("gone_row")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in sub_batches(batch):
                n, dropped, kept = [], [], []
                for text, out in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    n.append(text.count("\n") + 1)
                    dropped.append(len(out or ()))
                    if out:
                        out = set(out)
                        text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in out)
                    kept.append(text)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])

    return both.mapInArrow(run, OUT)
