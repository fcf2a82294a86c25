import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rangeloom.llm import entries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, ratio=10, divisor=31, least_chars=7, least_n=2):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % divisor == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_chars and k >= least_n}
    beside = {}
    for w in n:
        for i in range(len(w)):
            beside.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        beside.setdefault(w, set()).add(w)
    forms, counts = {}, {}
    for w in n:
        found = {x for i in range(len(w)) for x in beside[w[:i] + w[i + 1 :]]} | beside[w]
        found = {x for x in found if x != w and near(w, x)}
        counts[w] = len(found)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n[w], counts[w], n.get(forms[w])))
    return out


def check(df, most=spelling.MOST, **how):
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], **how)
    got = spelling.group_spellings(df, most=most, **how).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_edge_cases(edge, nothing):
    check(edge)
    check(edge, least_chars=1, least_n=1, ratio=2)
    check(nothing)


def test_bit_sliced_index_against_every_pair():
    r = random.Random(5)
    for _ in range(100):
        words = list({bytes(r.choice(b"abc") for _ in range(r.randint(0, 7))) for _ in range(r.randint(1, 200))})
        buckets = np.array([r.randint(0, 2) for _ in words])
        q, w = spelling.one_edit(words, buckets)
        want = sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(words) if buckets[i] == buckets[j] and a != b and near(a, b))
        assert sorted(zip(q.tolist(), w.tolist(), strict=True)) == want


@pytest.mark.parametrize("most", [2, 5, 40, spelling.MOST])
def test_crowded_surroundings_are_dealt_again(spark, most):
    r = random.Random(most)
    words = ["".join(r.choice("abÀÿ") for _ in range(r.randint(6, 9))) for _ in range(300)] + ["a" * k for k in range(5, 14)]
    rows = [(i, " ".join(r.choices(words, weights=[1 + k % 50 for k in range(len(words))], k=200))) for i in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), most=most, least_chars=2, ratio=2)


def test_very_long_words_and_chains(spark):
    long = "abcdefghij" * 400
    rows = [(1, " ".join([long, long, long[:1000] + "x" + long[1000:], long[:1000] + "x" + long[1000:], long[:-1], long[:-1]]))]
    chain = {"preface": 1, "prefaces": 10, "prefacesa": 100, "prefacesab": 1000}
    rows += [(None, " ".join(w for w, k in chain.items() for _ in range(2 * k)))] * 2
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_query(spark):
    d = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()])
    got = entries.queries()["op12_spelling_variants"](spark, d).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and any(r.form for r in got)
