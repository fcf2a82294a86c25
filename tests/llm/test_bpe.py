import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from rangeloom.llm import bpe

with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
ENC = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def check(df, **how):
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        t = r.text or ""
        ids = np.array(ENC.encode_ordinary(t), "<u4")
        want[r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    got = bpe.encode_and_decode(df, **how).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(tuple, got)) == want


def test_edge_cases(edge, nothing):
    check(edge)
    check(edge, chunk=64, overlap=30)
    check(nothing)


def test_whole_table(sample):
    check(sample)


@pytest.mark.parametrize("chunk,overlap", [(20, 13), (50, 40), (300, 60)])
def test_cuts_anywhere(spark, chunk, overlap):
    r = random.Random(chunk)
    odd = ["a", "B", "é", " ", "    ", "\n", "\n\n", "\t", "'", "'s", "'re", "'ll", ",", "%", "1", " ", "　", "中", "😀", "word", " the", "\r\n"]
    rows = [(i, "".join(r.choice(odd) for _ in range(r.randint(0, 200)))) for i in range(120)]
    rows += [(500, "x" * 400), (501, " " * 300 + "y"), (502, "a b" * 300), (502, "a b" * 300), (None, "a'll " * 100), (503, "\n" * 90)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), chunk=chunk, overlap=overlap)
