import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rangeloom.llm import token_store
from rangeloom.llm.common import cut, new_folder


def check(df):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(((r.doc_id, np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0]))
    want, at = [], 0
    for doc, ids in rows:
        want.append((doc, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    got = Counter(tuple(r) for r in token_store.store(df).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == Counter(want)


def test_edge_cases(edge, nothing):
    check(edge)
    check(nothing)


def test_whole_table(sample):
    check(sample)


def test_cuts_follow_content_and_copies_are_stored_once(spark):
    r = np.random.default_rng(1)
    a, b = r.integers(0, 50000, 20000).astype(np.int32), r.integers(0, 50000, 777).astype(np.int32)
    (x,), (y,) = (token_store.chunk_ends(i, np.array([0, len(i)])) for i in (a, np.concatenate([b, a])))
    both = token_store.chunk_ends(np.concatenate([b, a, a]), np.array([0, 777, 20777, 40777]))
    assert both[1] == [e + 777 for e in x] and both[2] == [e + 20777 for e in x]
    assert len(set(x) & {e - 777 for e in y}) > 0.9 * len(x)
    assert max(np.diff([0, *x])) <= token_store.MOST and min(np.diff([0, *x[:-1]])) >= token_store.LEAST
    text = " ".join(f"word{i}" for i in range(4000))
    df = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string").repartition(4)
    folder = new_folder(spark, "t")
    found = cut(token_store.chunks(df, folder))
    index = token_store.write_packs(found, folder)
    all_chunks = found.select(F.explode("chunks.digest").alias("digest"))
    assert index.count() == all_chunks.distinct().count() < all_chunks.count() / 10


def test_manifest_is_a_merkle_tree_of_bounded_nodes(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FAN", 3)
    text = [None, "", *(f"some text {i} " * (i * 9 % 40) for i in range(20))]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string").repartition(3)
    folder = new_folder(spark, "t")
    found = cut(token_store.chunks(docs, folder))
    token_store.write_packs(found, folder)
    token_store.write_recipes(found, folder)
    rows = sorted(spark.read.parquet(f"{folder}/recipes").collect(), key=lambda r: r.doc_id)
    assert [r.place for r in rows] == list(range(22))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    level, want, below = 0, {}, [sha("0" + "".join(c.digest.hex().upper() for c in r.chunks)) for r in rows]
    while level == 0 or len(below) > 1:
        level += 1
        groups = [below[i : i + 3] for i in range(0, len(below), 3)]
        below = [sha("1" + "".join(g)) for g in groups]
        want |= {(level, i): (x, len(g)) for i, (x, g) in enumerate(zip(below, groups, strict=True))}
    got = {(r.level, r.node): (r.root, r.children) for r in spark.read.parquet(f"{folder}/manifest").collect()}
    assert got == want and max(level for level, _ in got) == 3


def test_damage_is_found(spark, sample):
    folder = new_folder(spark, "t")
    found = cut(token_store.chunks(sample.limit(20), folder))
    index = token_store.write_packs(found, folder)
    token_store.write_recipes(found, folder)
    name = index.where("size > 20").first()["pack"].removeprefix("file://")
    with open(name, "r+b") as f:
        f.seek(15)
        c = f.read(1)
        f.seek(15)
        f.write(bytes([c[0] ^ 1]))
    with pytest.raises(Exception):  # noqa: B017
        token_store.read_documents(spark, folder, index).collect()


def test_crc_shares():
    r = np.random.default_rng(2)
    for _ in range(20):
        parts = [r.bytes(int(n)) for n in r.integers(0, 500, 5)]
        after = np.array([sum(map(len, parts[i + 1 :])) for i in range(5)])
        share = token_store.crc_moved(np.array([zlib.crc32(p) for p in parts]), after)
        assert int(np.bitwise_xor.reduce(share)) == zlib.crc32(b"".join(parts))
