import hashlib
import tarfile
import zlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rangeloom.llm import media
from rangeloom.llm.common import new_folder


def padded(text):
    raw = (text or "").encode()
    return raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


def pixels(image):
    """The samples of a grey PNG, read by the format's definition."""
    assert image[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, body, head = 8, b"", None
    while at < len(image):
        n, kind = int.from_bytes(image[at : at + 4], "big"), image[at + 4 : at + 8]
        data = image[at + 8 : at + 8 + n]
        assert int.from_bytes(image[at + 8 + n : at + 12 + n], "big") == zlib.crc32(kind + data)
        head, body, at = data if kind == b"IHDR" else head, body + data * (kind == b"IDAT"), at + 12 + n
    w, h = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    assert kind == b"IEND" and head[8:] == bytes([8, 0, 0, 0, 0])
    lines = zlib.decompress(body)
    assert len(lines) == h * (w + 1) and not any(lines[:: w + 1])
    return w, b"".join(lines[i * (w + 1) + 1 : (i + 1) * (w + 1)] for i in range(h))


def described(p):
    bands = [sum(64 * i <= x < 64 * (i + 1) for x in p) * 1000 // len(p) for i in range(4)]
    return f"rows={len(p) // 64};mean={sum(p) * 1000 // len(p)};distinct={len(set(p))};bands={'/'.join(map(str, bands))}"


def check(df):
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        p = padded(r.text)
        image = media.to_image(p)
        assert pixels(image) == (64, p)
        want[r.doc_id, len((r.text or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(image), hashlib.sha256(image).hexdigest(), described(p), len(p) // 64] += 1
    got = media.media_columns(df).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "height").collect()
    assert Counter(map(tuple, got)) == want


def test_edge_cases(edge, nothing):
    check(edge)
    check(nothing)


def test_whole_table(sample):
    check(sample)


@given(st.binary(max_size=500))
def test_images_are_lossless(data):
    p = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
    assert media.from_image(media.to_image(p)) == p


def test_shards_are_tar_files_and_damage_is_found(spark, sample):
    folder = new_folder(spark, "m")
    sample = sample.unionByName(sample.where("doc_id < 30"))  # copies in other partitions are stored once
    payloads = media.payloads(sample)
    places = media.write_shards(payloads, media.addressed(payloads), folder)
    assert places.count() == payloads.select("digest").distinct().count() < payloads.count()
    rows = places.collect()
    name = media.shard_name(folder, rows[0]["shard"]).removeprefix("file://")
    with tarfile.open(name) as t:
        members = {m.name.removesuffix(".png"): (m.offset_data, m.size) for m in t}
    assert members == {r["digest"].hex(): (r["offset"], r["length"]) for r in rows if r["shard"] == rows[0]["shard"]}
    with open(name, "r+b") as f:
        f.seek(rows[0]["offset"] + 45)
        f.write(b"\xff\x00\xff")
    with pytest.raises(Exception):  # noqa: B017
        media.read_features(places, folder).collect()
