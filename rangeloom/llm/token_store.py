"""Content-addressed store of token ids.

A rolling hash over the last ids of a stream cuts it into chunks, so equal passages give equal chunks wherever they
stand. A chunk's address is a digest of its ids. Unique chunks are written once, compressed, to pack files; a document is
a recipe, the list of its chunks' addresses, and recipes are written in ascending doc_id order. Merkle nodes are hashes of
at most FAN children: a document's of its chunks' addresses (all of them), those above of documents and of nodes, up to one root of the
whole; the manifest has every node. Reading back fetches each pack's ranges, checks every address, rebuilds the checksum of
each document from those of its chunks, and builds the manifest again from the recipes to compare it.

Pack file: chunks one after the other, each a zstd frame of one byte, the width of an id (2,
or 4 if the vocabulary needs it), and little-endian unsigned ids of that width. Recipe files: Parquet rows doc_id, start,
n_tokens, place (rank in the order of the files), chunks (address, ids, ids after it). Manifest: level, node, root, children.

Defined cases: null text is the empty text, so the end id alone; rows with repeated or null ids are stored each, null
first; an empty table gives empty files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rangeloom.llm.common import cut, flat_bytes, mix, new_folder, shuffle_partitions, sub_batches, table, texts
from rangeloom.llm.files import make_folder, opened, remove_folder, written_whole
from rangeloom.llm.tokens import encode_column, encoder_path, hub_encoder

#: A cut falls where the rolling hash of WINDOW ids has CUT_BITS zero bits, at least LEAST and at most MOST ids apart.
WINDOW, CUT_BITS, LEAST, MOST = 16, 9, 64, 4096
#: Children of a Merkle node above the documents.
FAN = 1024

CHUNK = [("after", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]
PLACE = [("digest", pa.binary()), ("offset", pa.int64()), ("size", pa.int64())]
FOUND_DDL = "doc_id long, row long, n_tokens long, chunks array<struct<after:long,n:long,digest:binary>>, part int, new array<struct<digest:binary,offset:long,size:long>>"


def chunk_ends(ids: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each id stream; streams stand one after the other in ids. A cut is at least LEAST ids after its
    stream's start, so the WINDOW ids that decide it are the stream's own."""
    h = np.zeros(len(ids), np.uint64)
    gear = mix(ids.astype(np.uint64) + np.uint64(1))
    for k in range(WINDOW):
        h[k:] += gear[: len(ids) - k] << np.uint64(k)
    marks = np.flatnonzero(h >> np.uint64(WINDOW) & np.uint64((1 << CUT_BITS) - 1) == 0) + 1
    bounds = np.searchsorted(marks, offsets).tolist()
    marks, offsets, found = marks.tolist(), offsets.tolist(), []
    for i, (last, stop) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        own = []
        for p in marks[bounds[i] : bounds[i + 1]] if stop - last > LEAST else ():
            while p - last > MOST:
                last += MOST
                own.append(last)
            if p - last >= LEAST and p < stop:
                own.append(p)
                last = p
        while stop - last > MOST:
            last += MOST
            own.append(last)
        found.append([*own, stop] if stop > offsets[i] else own)
    return found


def _structs(fields: list, columns: list, offsets: np.ndarray) -> pa.Array:
    """A list column of structs from their flat columns."""
    flat = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def chunks(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """A row for each document with its chunks in order. Each partition writes its distinct chunks to a draft pack as it goes:
    ``new`` has the places of those that a document is the first to hold there."""
    path = tokenizer or encoder_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        encoder = hub_encoder(path)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        first, pack, address = bytes([width]), zstandard.ZstdCompressor(level=1), hashlib.blake2b
        seen: set[bytes] = set()
        part = TaskContext.get().partitionId()
        row, at = part << 40, 0
        with written_whole(_draft(folder, part)) as out:
            for batch in batches:
                for b in sub_batches(batch):
                    ids, offsets = encode_column(encoder, *flat_bytes(b.column(1)))
                    ids, offsets = np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))
                    ends = chunk_ends(ids, offsets)
                    raw, n = memoryview(ids.astype(f"<u{width}").tobytes()), b.num_rows
                    digests, places, fresh, a = [], [], [0], 0
                    for own in ends:
                        for z in own:
                            data = first + raw[a * width : z * width]
                            digest = address(data, digest_size=20).digest()
                            digests.append(digest)
                            if digest not in seen:
                                if len(seen) > 1 << 20:
                                    seen.clear()  # a chunk may stand twice in a draft; one place is chosen
                                seen.add(digest)
                                data = pack.compress(data)
                                out.write(data)
                                places.append((digest, at, len(data)))
                                at += len(data)
                            a = z
                        fresh.append(len(places))
                    counts = np.array([0, *map(len, ends)])
                    flat = np.array([z for own in ends for z in own], np.int64)
                    after = np.repeat(offsets[1:], counts[1:]) - flat
                    recipe = _structs(CHUNK, [after, np.diff(flat, prepend=0), digests], np.cumsum(counts))
                    new = _structs(PLACE, list(zip(*places, strict=True)) or [[], [], []], np.array(fresh))
                    cols = [b.column(0).cast(pa.int64()), pa.array(np.arange(row, row + n)), pa.array(np.diff(offsets)), recipe, pa.array(np.full(n, part, np.int32)), new]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "n_tokens", "chunks", "part", "new"])
                    row += n

    make_folder(f"{folder}/drafts")
    return texts(docs).mapInArrow(run, FOUND_DDL)


def _draft(folder: str, part: int) -> str:
    return f"{folder}/drafts/{part:06d}.pack"


def write_packs(found: DataFrame, folder: str) -> DataFrame:
    """digest, pack, offset, size of every unique chunk, after its bytes were copied from the draft chosen for it."""
    schema = pa.schema([("digest", pa.binary()), ("pack", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by draft and offset; a task copies the ranges of one draft after the other
        part, out, source, at = None, None, None, 0
        try:
            for b in batches:
                rows = []
                for digest, own, offset, size in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                    if own != part:
                        for x in (out, source):
                            if x is not None:
                                x.__exit__(None, None, None)
                        part, at, name = own, 0, f"{folder}/packs/{own:06d}.pack"
                        source, out = opened(_draft(folder, own)), written_whole(name)
                        f, to = source.__enter__(), out.__enter__()
                    to.write(f.read_at(size, offset))
                    rows.append((digest, name, at, size))
                    at += size
                yield table(schema, **dict(zip(schema.names, list(zip(*rows, strict=True)) or [[]] * 4, strict=True)))
        except BaseException as e:
            if out is not None:
                out.__exit__(type(e), e, e.__traceback__)  # a draft of a file that is not complete keeps no name
                out = None
            raise
        finally:
            for x in (out, source):
                if x is not None:
                    x.__exit__(None, None, None)

    make_folder(f"{folder}/packs")
    new = found.select("part", F.explode("new").alias("x")).select("part", "x.*")
    one = new.groupBy("digest").agg(F.min(F.struct("part", "offset", "size")).alias("x")).select("digest", "x.*")
    one = one.repartition(shuffle_partitions(found.sparkSession), "part").sortWithinPartitions("part", "offset")
    index = cut(one.mapInArrow(run, "digest binary, pack string, offset long, size long"))
    remove_folder(f"{folder}/drafts")
    return index


def hashed_children(kind: str, children: Column) -> Column:
    """A Merkle node over its children in order: SHA-256 of the kind of node and the children's hexadecimal hashes."""
    return F.sha2(F.concat(F.lit(kind), F.array_join(children, "")), 256)


def manifest(recipes: DataFrame) -> DataFrame:
    """level, node, root, children of every Merkle node over recipes.place: level 1 over FAN documents each, each level
    over FAN nodes of the one below, the last one over all."""
    root = hashed_children("0", F.transform("chunks.digest", F.hex))
    below = recipes.select(F.col("place").alias("node"), root.alias("root"))
    out, level, nodes = None, 0, None
    while nodes is None or nodes > 1:
        level += 1
        own = below.groupBy(F.floor(F.col("node") / FAN).alias("parent")).agg(F.sort_array(F.collect_list(F.struct("node", "root"))).alias("x"))  # FAN children at most
        own = cut(own.select(F.lit(level).alias("level"), F.col("parent").alias("node"), hashed_children("1", F.col("x.root")).alias("root"), F.size("x").alias("children")))
        out, below, nodes = own if out is None else out.unionByName(own), own, own.count()
    return out


def write_recipes(found: DataFrame, folder: str) -> None:
    """Recipe files in ascending doc_id order and the manifest of their Merkle nodes."""
    spark = found.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tokens, rows = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            n = np.asarray(b.column(1))
            total = tokens + np.cumsum(n)
            cols = [*b.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(total - n), pa.array(rows + np.arange(len(n)))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "row", "chunks", "part", "own", "nth"])
            tokens, rows = int(total[-1]) if len(n) else tokens, rows + len(n)

    # documents in order, counted by their tasks as they stand; a row for each partition then gives the places in the whole
    ordered = found.select("doc_id", "n_tokens", "row", "chunks").repartitionByRange(shuffle_partitions(spark), "doc_id", "row").sortWithinPartitions("doc_id", "row")
    ordered = cut(ordered.mapInArrow(run, "doc_id long, n_tokens long, row long, chunks array<struct<after:long,n:long,digest:binary>>, part int, own long, nth long"))
    totals = ordered.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("above"))
    out = ordered.join(F.broadcast(base), "part")  # a row for each partition
    out.select("doc_id", "row", (F.col("base") + F.col("own")).alias("start"), "n_tokens", (F.col("above") + F.col("nth")).alias("place"), "chunks").write.parquet(f"{folder}/recipes")
    manifest(spark.read.parquet(f"{folder}/recipes")).write.parquet(f"{folder}/manifest")


# --- reading back -----------------------------------------------------------------------------------------------


def _byte_steps() -> list[np.ndarray]:
    """Tables [k][4, 256] that advance a CRC-32 register over 2^k zero bytes."""
    poly = 0xEDB88320
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(poly), one >> 1).astype(np.uint32)
    values = (np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]).astype(np.uint32)
    steps = [one[values & 255] ^ (values >> np.uint32(8))]
    for _ in range(40):
        steps.append(_step(steps[-1], steps[-1]))
    return steps


def _step(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    return t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]


def crc_moved(crc: np.ndarray, zeros: np.ndarray, _steps: list = []) -> np.ndarray:  # noqa: B006
    """The share of a part's CRC-32 in that of the whole, with so many bytes after the part; shares combine by xor."""
    if not _steps:
        _steps += _byte_steps()
    out = crc.astype(np.uint32)
    for k in range(int(zeros.max(initial=0)).bit_length()):
        out = np.where(zeros >> k & 1 == 1, _step(_steps[k], out), out)
    return out


def read_packs(index: DataFrame) -> DataFrame:
    """digest, crc, ids of every stored chunk, from its bytes; a chunk that does not match its address is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows = b.to_pylist()
            i, crcs = 0, []
            while i < len(rows):
                with opened(rows[i]["pack"]) as f:
                    name = rows[i]["pack"]
                    while i < len(rows) and rows[i]["pack"] == name:
                        j, first = i, rows[i]["offset"]
                        while j < len(rows) and rows[j]["pack"] == name and rows[j]["offset"] + rows[j]["size"] - first <= 8 << 20:
                            j += 1
                        j = max(j, i + 1)
                        f.seek(first)
                        block = f.read(rows[j - 1]["offset"] + rows[j - 1]["size"] - first)
                        for r in rows[i:j]:
                            raw = unpack.decompress(block[r["offset"] - first : r["offset"] - first + r["size"]])
                            if hashlib.blake2b(raw, digest_size=20).digest() != r["digest"]:
                                raise ValueError(f"chunk at {r['offset']} of {name} does not match its address")
                            ids = np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype("<u4")
                            crcs.append((r["digest"], zlib.crc32(ids), len(ids)))
                        i = j
            yield table(schema, **dict(zip(schema.names, zip(*crcs, strict=True), strict=True)))

    schema = pa.schema([("digest", pa.binary()), ("crc", pa.int64()), ("ids", pa.int64())])
    return index.mapInArrow(run, "digest binary, crc long, ids long")


def read_documents(spark, folder: str, index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, rebuilt from recipes and packs."""

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            share = crc_moved(np.asarray(b.column(3)).astype(np.uint32), 4 * np.asarray(b.column(4)))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(share.astype(np.int64)), b.column(5)], names=["row", "doc_id", "start", "share", "ids"])

    recipes = spark.read.parquet(f"{folder}/recipes")
    key = ["level", "node", "root", "children"]
    noted, again = spark.read.parquet(f"{folder}/manifest").select(*key), manifest(recipes).select(*key)
    if not noted.exceptAll(again).unionByName(again.exceptAll(noted)).isEmpty():
        raise ValueError("recipes do not match the manifest")
    each = recipes.select("row", "doc_id", "start", F.explode("chunks").alias("c")).select("row", "doc_id", "start", "c.digest", "c.after", F.col("c.n").alias("noted"))
    got = each.join(read_packs(index), "digest", "left")
    got = got.withColumn("ids", F.when(F.col("ids") == F.col("noted"), F.col("ids")).otherwise(F.raise_error(F.lit("a chunk of a recipe is missing"))))
    got = got.select("row", "doc_id", "start", "crc", "after", "ids").mapInArrow(shares, "row long, doc_id long, start long, share long, ids long")
    return got.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.sum("ids").alias("n_tokens"), F.bit_xor("share").alias("ids_crc32")).drop("row")


def store(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Writes the store for ``docs`` and reads every document back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-store")
    found = cut(chunks(docs, folder, tokenizer, end_id))
    index = write_packs(found, folder)
    write_recipes(found, folder)
    return read_documents(spark, folder, index)
