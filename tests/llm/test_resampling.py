import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from rangeloom.llm import entries, resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target, least=20, share=(5, 100)):
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(buckets(x))
    for x in target:
        t.update(buckets(x))
    a, b = sum(s.values()), sum(t.values())
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (a + 10000) / ((s[k] + 1) * (b + 10000)))) for k in s}
    out = []
    for i, x in rows:
        own = buckets(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in own)
        out.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x))))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1], r[4]))
    drawn = len(able) * share[0] // share[1]
    ranks = Counter()
    for k, r in enumerate(able[:drawn]):
        ranks[(*r[:4], k + 1)] += 1
    for r in able[drawn:] + [r for r in out if r[4] < least]:
        ranks[(*r[:4], None)] += 1
    return ranks


def check(spark, df, target, **how):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = resampling.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), **({"least_words": how["least"], "share": how["share"]} if how else {}))
    assert Counter(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect())) == brute(rows, target, **how)


def test_edge_cases(spark, edge, nothing):
    check(spark, edge, ["alpha beta", None, "", "Über niño x"], least=1, share=(1, 2))
    check(spark, edge, [])
    check(spark, nothing, ["a b c"])


def test_ties_and_repeated_rows(spark):
    rows = [(i // 2, "one two three four") for i in range(40)] + [(None, "one two")] * 3 + [(7, "a b c d e")] * 2
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), ["three four"], least=2, share=(3, 4))


def test_spans_overlap_and_begin_and_end_at_words():
    p = resampling.gram_pattern()
    assert resampling.normalised("  It's ÉCOLE-9\x00x\n".encode()) == "it s École".replace("É", "É").encode() + b" 9 x"
    assert [m.group(1, 2, 3) for m in p.finditer(b"a bc d", overlapped=True)] == [(b"a", b" bc", b" d"), (b"bc", b" d", None), (b"d", None, None)]
    assert list(p.finditer(b"", overlapped=True)) == []


def test_whole_table(spark, sample):
    target = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    check(spark, sample, target)
    got = entries.queries()["op11_importance_resampling"](spark, "/root/testdata/sf0.001")
    able = sum(len(words(r.text)) >= 20 for r in sample.collect())
    assert got.where("rank IS NOT NULL").count() == able * 5 // 100 == got.agg(F.max("rank")).first()[0]
