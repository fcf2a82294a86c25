"""Media columns: content-addressed payloads in tar shards.

A payload is stored losslessly as an 8-bit grey PNG image of 64 samples a row, once in the whole store, named by its digest. A
first pass over the rows gives their digests and places (partition and number in it); the least place of a digest owns it. In the
second pass each task reads which rows of its partition are owners and writes their images to its tar shard, so digests are
shuffled and payloads are not. Rows must come in the same partitions both times, as they do from files or a checkpoint; a row
that does not have the digest it should is an error. The catalogue maps a digest to its place: rows carry the digest, the shard, and
offset and length of the image in it. Metadata columns come from range reads of an image's first bytes alone; whole images are
read only for the columns that need samples.

Defined cases: null text is the empty text, padded to 64 zero bytes; rows with repeated or null ids give a row each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import cut, new_folder, release, shuffle_partitions, stored, table, texts
from rangeloom.llm.files import _split, make_folder, opened, written_whole

WIDTH = 64
#: PNG signature, and the image header chunk up to its interlace byte.
SIGNATURE, HEADER_BYTES = b"\x89PNG\r\n\x1a\n", 29

PLACES = pa.schema([("digest", pa.binary()), ("shard", pa.int32()), ("offset", pa.int64()), ("length", pa.int32())])
PLACES_DDL = "digest binary, shard int, offset long, length int"


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/{shard:06d}.tar"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_image(payload: bytes) -> bytes:
    """A grey 8-bit PNG whose rows are the payload's blocks of 64 bytes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each line starts with filter type 0
    lines[:, 1:] = rows
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def image_header(first: bytes) -> tuple[int, int, int]:
    """Width, height and bits a sample from an image's first HEADER_BYTES bytes."""
    if len(first) < HEADER_BYTES or not first.startswith(SIGNATURE) or first[12:16] != b"IHDR":
        raise ValueError("not an image of this store")
    return struct.unpack(">IIB", first[16:25])


def from_image(image: bytes) -> bytes:
    """The payload of an image that to_image made."""
    width, height, bits = image_header(image)
    at, data = 8, b""
    while at < len(image):
        n = struct.unpack(">I", image[at : at + 4])[0]
        kind, body = image[at + 4 : at + 8], image[at + 8 : at + 8 + n]
        if struct.unpack(">I", image[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError("an image chunk is damaged")
        data += body if kind == b"IDAT" else b""
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, width + 1)
    if bits != 8 or lines[:, 0].any():
        raise ValueError("an image has samples or filters that this store does not write")
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Row count, mean in thousandths, number of distinct samples and share of samples in four bands of a payload."""
    x = np.frombuffer(payload, np.uint8)
    counts = np.bincount(x, minlength=256)
    bands = counts.reshape(4, 64).sum(axis=1) * 1000 // len(x)
    return f"rows={len(x) // WIDTH};mean={int(counts @ np.arange(256)) * 1000 // len(x)};distinct={np.count_nonzero(counts)};bands={'/'.join(map(str, bands))}"


def payloads(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload and digest (SHA-256) of every row."""
    raw = texts(docs).select("doc_id", F.col("text").cast("binary").alias("raw")).withColumn("n_bytes", F.octet_length("raw").cast("long"))
    padded = F.expr(f"rpad(raw, cast(greatest({WIDTH}, ceil(n_bytes / {WIDTH}) * {WIDTH}) as int), X'00')")
    return raw.select("doc_id", "n_bytes", padded.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))


def addressed(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, digest, part and nth (the row's place) of the rows of payloads()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(nth, nth + n))], names=[*b.schema.names, "part", "nth"])
            nth += n

    return stored(rows.select("doc_id", "n_bytes", "digest").mapInArrow(run, "doc_id long, n_bytes long, digest binary, part int, nth long"))


def _owned(folder: str, part: int) -> dict[int, bytes]:
    """Digest by number of the rows of a partition that own theirs."""
    where, path = _split(f"{folder}/owners")
    at = f"{path}/part={part}"
    if where.get_file_info(at).type == fs.FileType.NotFound:
        return {}
    t = pads.dataset(at, filesystem=where, format="parquet").to_table(columns=["nth", "digest"])
    return dict(zip(t["nth"].to_pylist(), t["digest"].to_pylist(), strict=True))


def write_shards(rows: DataFrame, known: DataFrame, folder: str) -> DataFrame:
    """Stores rows.payload under rows.digest, known being addressed(rows); the catalogue: digest, shard, offset, length."""
    owners = known.groupBy("digest").agg(F.min(F.struct("part", "nth")).alias("x")).select("digest", "x.*")
    owners.repartition(shuffle_partitions(rows.sparkSession), "part").write.partitionBy("part").parquet(f"{folder}/owners")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        owned, nth, at = _owned(folder, shard), -1, 0
        with written_whole(shard_name(folder, shard)) as out:
            for b in batches:
                found = []
                for digest, payload in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    nth += 1
                    if (own := owned.pop(nth, None)) is None:
                        continue
                    if own != digest:
                        raise ValueError("the rows came in another order than at first; store them as a table before")
                    image = to_image(payload.as_py())
                    info = tarfile.TarInfo(f"{digest.hex()}.png")
                    info.size = len(image)
                    head = info.tobuf(tarfile.GNU_FORMAT)
                    out.write(head + image + bytes(-len(image) % tarfile.BLOCKSIZE))
                    found.append((digest, shard, at + len(head), len(image)))
                    at += len(head) + len(image) + -len(image) % tarfile.BLOCKSIZE
                if found:
                    yield table(PLACES, **dict(zip(PLACES.names, zip(*found, strict=True), strict=True)))
                release()
            if owned:
                raise ValueError("rows are missing that were there at first; store them as a table before")
            out.write(bytes(2 * tarfile.BLOCKSIZE))

    make_folder(folder)
    placed = cut(rows.select("digest", "payload").mapInArrow(run, PLACES_DDL))
    return cut(placed.repartitionByRange(shuffle_partitions(rows.sparkSession), "shard", "offset").sortWithinPartitions("shard", "offset"))


def _ranges(folder: str, places: pa.RecordBatch, gap: int = 1 << 16, most: int = 8 << 20, first: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(row, bytes) of each place, rows in order of shard and offset; neighbours share a read. first: no more bytes."""
    shard, offset, length = (places.column(i).to_pylist() for i in (1, 2, 3))
    n, i = len(shard), 0
    while i < n:
        with opened(shard_name(folder, shard[i])) as f:
            name = shard[i]
            while i < n and shard[i] == name:
                if first is not None:
                    yield i, f.read_at(min(first, length[i]), offset[i])
                    i += 1
                    continue
                j, end = i + 1, offset[i] + length[i]
                while j < n and shard[j] == name and offset[j] - end <= gap and offset[j] + length[j] - offset[i] <= most:
                    end = offset[j] + length[j]
                    j += 1
                block = f.read_at(end - offset[i], offset[i])
                for k in range(i, j):
                    yield k, block[offset[k] - offset[i] : offset[k] - offset[i] + length[k]]
                i = j


def read_headers(places: DataFrame, folder: str) -> DataFrame:
    """digest, width, height, bits of every place, from its first bytes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, h, bits = zip(*(image_header(x) for _, x in _ranges(folder, b, first=HEADER_BYTES)), strict=True) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (w, h, bits))], names=["digest", "width", "height", "bits"])

    return places.mapInArrow(run, "digest binary, width long, height long, bits long")


FEATURES = pa.schema([("digest", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
FEATURES_DDL = "digest binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_features(places: DataFrame, folder: str) -> DataFrame:
    """Digests, checksums and a feature of every place from the stored bytes; a payload that is not its digest's is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, rows = b.column(0).to_pylist(), []
            for i, image in _ranges(folder, b):
                payload = from_image(image)
                sha = hashlib.sha256(payload)
                if sha.digest() != digests[i]:
                    raise ValueError(f"the image of {digests[i].hex()} holds another payload")
                rows.append((digests[i], len(payload), sha.hexdigest(), zlib.crc32(payload[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), feature(payload)))
            if rows:
                yield table(FEATURES, **dict(zip(FEATURES.names, zip(*rows, strict=True), strict=True)))
            release()

    return places.mapInArrow(run, FEATURES_DDL)


def media_columns(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Stores every text and reads it back: see FEATURES, with doc_id, n_bytes, place and header columns of every row."""
    folder = folder or new_folder(docs.sparkSession, "media")
    rows = payloads(docs)
    known = addressed(rows)
    places = write_shards(rows, known, folder)
    images = places.join(read_headers(places, folder), "digest").join(read_features(places, folder), "digest")
    return known.drop("part", "nth").join(images, "digest", "left").drop("digest").withColumn("folder", F.lit(folder))
