import random

import numpy as np
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rangeloom.llm import simhash
from rangeloom.llm.common import mix


def brute_fp(text, k):
    w = [x for x in "".join(c.lower() if c.isascii() else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
    s = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_words(text):
    w = {x for x in "".join(c.lower() if c.isascii() else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x}
    h = [xxh64_intdigest(x.encode(), 42) for x in w]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, linked):
    """The least member of each one's component."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(n)]


def named(rows, group):
    """The least id of each row's component."""
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [least.get(g) for g in group]


def brute(rows, k=4, d=4):
    fp = [brute_fp(t, k) for _, t in rows]
    ids = named(rows, groups(len(rows), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= d))
    return sorted(((doc, f"{fp[i]:016x}", ids[i]) for i, (doc, _) in enumerate(rows)), key=str)


def brute_sketch(text, k=5):
    """512 bits as one number: majorities of the mixed hashes of the shingles."""
    w = [x for x in "".join(c.lower() if c.isascii() else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
    h = [xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    out = 0
    for j in range(simhash.SKETCH):
        own = [int(x) for x in mix(np.array(h, np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))] if h else []
        out |= sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own)) << 64 * j
    return out


def brute_kept(rows):
    """Ids of the rows that one_of_each keeps."""
    a, b, c = [brute_words(t) for _, t in rows], [brute_fp(t, 5) for _, t in rows], [brute_sketch(t) for _, t in rows]
    near = lambda i, j: (a[i] ^ a[j]).bit_count() <= simhash.WORD_BITS and (b[i] ^ b[j]).bit_count() <= simhash.SHINGLE_BITS and (c[i] ^ c[j]).bit_count() <= simhash.SKETCH_BITS
    return set(named(rows, groups(len(rows), near)))


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_edge_cases(edge, nothing):
    check(edge)
    assert simhash.near_duplicates(nothing).count() == 0


def test_whole_table(sample):
    check(sample)


def test_links_connect_what_all_links_connect(spark, monkeypatch):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = {x ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))) for x in base for _ in range(12)} | {0, (1 << 64) - 1, 1 << 63}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for d, few in ((4, 16), (4, 1), (0, 16), (1, 16), (2, 16), (7, 2)):
        monkeypatch.setattr(simhash, "FEW", few)
        near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= d  # noqa: B023, E731
        got = [tuple(x) for x in simhash.links(df, d).collect()]
        assert all(a < b and near(a, b) for a, b in got) and len(set(got)) == len(got)
        pairs, at = set(got), {x: i for i, x in enumerate(signed)}
        linked = {(at[b], at[a]) for a, b in pairs}
        assert groups(len(signed), lambda i, j: (i, j) in linked) == groups(len(signed), lambda i, j: near(signed[i], signed[j]))  # noqa: B023


def test_checked_links_connect_what_all_links_connect(spark, monkeypatch):
    r = random.Random(8)
    flipped = lambda x, bits, most: x ^ sum(1 << b for b in r.sample(range(bits), r.randint(0, most)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = {}
    for _ in range(12):  # groups that are near by fingerprints, each of several families of sketches
        fp, wide, families = r.getrandbits(64), r.getrandbits(64), [r.getrandbits(512) for _ in range(3)]
        for _ in range(40):
            rows[signed(flipped(fp, 64, 4)), signed(flipped(wide, 64, 8))] = flipped(r.choice(families), 512, 60)
    nodes = sorted(rows)
    df = spark.createDataFrame([(a, b, rows[a, b].to_bytes(64, "little")) for a, b in nodes], "fp long, wide long, sketch binary").selectExpr("*", "struct(fp, wide) AS node")
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    near = lambda i, j: bits(nodes[i][0], nodes[j][0]) <= 7 and bits(nodes[i][1], nodes[j][1]) <= 14 and (rows[nodes[i]] ^ rows[nodes[j]]).bit_count() <= 86
    want, at = groups(len(nodes), near), {x: i for i, x in enumerate(nodes)}
    for few in (16, 1, 1000):
        monkeypatch.setattr(simhash, "FEW", few)
        pairs = {(at[tuple(x.a)], at[tuple(x.b)]) for x in simhash.checked_links(df, 7, 14, 86).collect()}
        assert all(near(i, j) for i, j in pairs)
        assert groups(len(nodes), lambda i, j: (i, j) in pairs or (j, i) in pairs) == want  # noqa: B023
    assert simhash.checked_links(df.where("false"), 7, 14, 86).count() == 0


def test_a_dense_group_gives_few_links(spark):
    fps = [0, *(1 << i | 1 << j for i in range(64) for j in range(i))]
    n = simhash.links(spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")).count()
    assert len(fps) - 1 <= n < 100 * len(fps)


def test_members_of_a_dense_group_are_sent_to_few_crowds(spark):
    r = random.Random(6)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    flips = lambda most: sum(1 << b for b in r.sample(range(64), r.randint(0, most)))
    nodes = sorted({(signed(flips(3)), signed(flips(6))) for _ in range(600)})
    met = simhash._met(spark.createDataFrame(nodes, "fp long, wide long"), 7, 14, True).where("crowd IS NOT NULL")
    assert met.select("a").distinct().count() == len(nodes)
    assert met.select("crowd", "a").distinct().count() < 30 * len(nodes)


def test_long_texts_are_cut_into_blocks(monkeypatch):
    text = "".join(random.Random(1).choice(["one two", " three\n", "four ", "\tfive six ", "seven", "É "]) for _ in range(600))
    want = [simhash.fingerprint(text, k) for k in (1, 4, 5)], simhash.word_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 37)
    assert ([simhash.fingerprint(text, k) for k in (1, 4, 5)], simhash.word_fingerprint(text)) == want
    assert want[0][1] & (2**64 - 1) == brute_fp(text, 4) and want[1] & (2**64 - 1) == brute_words(text)


def test_one_of_each_equals_brute_force(edge, sample):
    for df in (edge, sample):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert sorted((r.doc_id for r in simhash.one_of_each(df).collect()), key=str) == sorted(brute_kept(rows), key=str)


def test_near_copies_share_a_component(spark):
    """Of the pairs of different texts with a Jaccard similarity of 0.8 or more of their five-word shingles, at least 0.9 are in one component."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    shingles, holders = {}, {}
    for doc, text in rows:
        w = text.lower().split()
        shingles[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        for x in shingles[doc]:
            holders.setdefault(x, []).append(doc)
    shared = {}
    for own in holders.values():
        for i, a in enumerate(own if len(own) < 300 else ()):
            for b in own[:i]:
                shared[b, a] = shared.get((b, a), 0) + 1
    text = dict(rows)
    near = [(a, b) for (a, b), n in shared.items() if text[a] != text[b] and n / (len(shingles[a]) + len(shingles[b]) - n) >= 0.8]
    r = random.Random(3)
    edited = []
    for doc, t in rows[:150]:  # light edits of every text, at a similarity of 0.8 to 1
        w = t.split(" ")
        if len(w) >= 60:
            for i in r.sample(range(len(w)), max(1, len(w) // 60)):
                w[i] = r.choice(["alpha", "beta", "gamma", "delta"]) + str(i)
            edited.append((1_000_000 + doc, " ".join(w)))
            near.append((doc, 1_000_000 + doc))
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(edited, "doc_id long, text string"))
    own = simhash.cut(simhash.fingerprints(both, 5, True)).withColumn("node", F.struct("fp", "wide"))
    links = simhash.cut(simhash.checked_links(own, simhash.WORD_BITS, simhash.SHINGLE_BITS, simhash.SKETCH_BITS))
    root = {r.node: r.root for r in simhash.connected(links).collect()}
    node_of = {r.doc_id: r.node for r in own.collect()}
    roots = {doc: root.get(node, node) for doc, node in node_of.items()}
    assert sum(roots[a] == roots[b] for a, b in near) >= 0.9 * len(near) and len(near) > 60
    # of the links between different texts, hardly any is below a similarity of 0.65
    for doc, t in edited:
        w = t.lower().split()
        shingles[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    doc_of, found = {node: doc for doc, node in node_of.items()}, links.collect()
    alike = [len(shingles[x] & shingles[y]) / len(shingles[x] | shingles[y]) for x, y in ((doc_of[r.a], doc_of[r.b]) for r in found)]
    assert len(alike) > 60 and np.mean(np.array(alike) >= 0.65) > 0.97
