import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rangeloom.llm import quality_rules as q
from rangeloom.llm.common import flat_bytes


def base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "\n\n", "\t", "\r", "#", "|", "a b c d e f g h ", "\x1c", "😀", " "]), max_size=40).map("".join), max_size=5))
def test_base_counts(found):
    got = q.base_counts(*flat_bytes(pa.array(found, pa.string())))
    assert list(zip(*(x.tolist() for x in got.values()), strict=True)) == [base(t) for t in found]


def brute_model(texts, order):
    """Modified Kneser-Ney by the textbook, over bytes with blanks as one symbol."""
    grams = Counter()
    for t in texts:
        b = re.sub(rb"[\x09-\x0d]", b" ", t.encode())
        grams.update(b[i : i + order] for i in range(len(b) - order + 1))
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    stats = {}
    for k, c in counts.items():
        n = Counter(c.values())
        y = n[1] / max(1.0, n[1] + 2 * n[2])
        d = {i: min(float(i), max(0.1, i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i)) for i in (1, 2, 3)}
        total, mass = defaultdict(int), defaultdict(float)
        for g, x in c.items():
            total[g[:-1]] += x
            mass[g[:-1]] += min(d[min(x, 3)], x)
        stats[k] = c, d, total, mass

    def p(g):
        if not g:
            return 1 / 256
        c, d, total, mass = stats[len(g)]
        h = g[:-1]
        if h not in total:
            return p(g[1:])
        x = c[g]
        return (x - (min(d[min(x, 3)], x) if x else 0)) / total[h] + mass[h] / total[h] * p(g[1:])

    p.stats = stats
    return p


def discounts(counts):
    n = Counter(counts.values())
    y = n[1] / max(1.0, n[1] + 2 * n[2])
    return {i: min(float(i), max(0.1, i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i)) for i in (1, 2, 3)}


def test_probabilities_equal_brute_force(spark):
    found = ["the cat sat on the mat " * 3, "a cat and\ta hat sat", "éa über the cat", "zzzzzz"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(found)], "doc_id long, text string, lang string")
    p = brute_model(found, q.ORDER)
    parts = q.model(q.counted_ngrams(df))
    for k, (probs, _) in parts.items():
        for r in probs.collect():
            assert math.isclose(r.p, p(r.key.to_bytes(k, "big")), rel_tol=1e-9)
    h = b"the "
    assert math.isclose(sum(p(h + bytes([c])) for c in range(256)), 1, rel_tol=1e-9)
    from rangeloom.llm.common import new_folder

    folder = new_folder(spark, "m")
    q.write_model(parts, folder)
    import hashlib

    a = q.arrays(folder, hashlib.sha256(b"=en").hexdigest())
    other = "the dog sat on the über mat qqq"
    at, keys = q.ngrams(*flat_bytes(pa.array([other])))
    got = a.log_p(keys)
    want = [math.log(p(int(x).to_bytes(q.ORDER, "big"))) for x in keys]
    assert np.allclose(got, want, rtol=1e-4)


def test_edge_cases(edge, nothing):
    got = q.judge(edge).collect()
    want = Counter((r.doc_id, *base(r.text)) for r in edge.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert q.judge(nothing).count() == 0


def test_gibberish_goes_and_clean_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = spark.createDataFrame([(-1, " ".join("qxzjkvw"[i % 7 : 5 + i % 3] + "wqk" for i in range(300)), "en"), (-2, "xq zk vj wq jx kz qv " * 2 + " ".join(chr(97 + i * 7 % 26) * 3 + chr(97 + i * 11 % 26) for i in range(200)), "en")], "doc_id long, text string, lang string")
    got = q.judge(docs.unionByName(odd)).join(labels, "doc_id", "left").collect()
    assert not any(r.kept for r in got if r.doc_id < 0)
    kept = lambda quality: np.mean([r.kept for r in got if r.quality == quality and not r.base_failed])
    assert kept(1) > 0.995 and kept(0) < 0.5


def lettered(b):
    """(start, end) of the words of bytes that have a letter."""
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)]
    return [(x, z) for x, z in found if re.search(rb"[0-9A-Za-z\xc2-\xff]", b[x:z])]


def brute_scores(texts):
    """(words, log perplexity) of each text of a language, judged by the others."""
    p, raw = brute_model(texts, q.ORDER), [t.encode() for t in texts]
    grams, _, total, mass = p.stats[q.ORDER]
    counts = Counter(b[x:z] for b in raw for x, z in lettered(b))
    all_words, d = sum(counts.values()), discounts(counts)
    off = lambda c: min(d[min(c, 3)], c) if c else 0
    share_off = sum(off(c) for c in counts.values()) / max(1, all_words)
    out = []
    for b in raw:
        flat = re.sub(rb"[\x09-\x0d]", b" ", b)
        own = Counter(flat[i : i + q.ORDER] for i in range(len(flat) - q.ORDER + 1))
        spelled = [0.0] * len(b)
        for i in range(len(flat) - q.ORDER + 1):
            g = flat[i : i + q.ORDER]
            if grams[g] > own[g]:
                spelled[i + q.ORDER - 1] = math.log(p(g))
            else:
                spelled[i + q.ORDER - 1] = math.log(mass[g[:-1]] / total[g[:-1]] * p(g[1:]))
        at = lettered(b)
        mine, score = Counter(b[x:z] for x, z in at), 0.0
        for x, z in at:
            c = counts[b[x:z]] - mine[b[x:z]]
            share = max(0, c - off(c)) / max(1, all_words - len(at))
            score -= math.log(share + share_off * math.exp(sum(spelled[x : z + 1])))
        out.append((len(at), score / len(at) if at else None))
    return out


def test_verdicts_equal_brute_force(spark):
    """Counts, model, perplexity of words and bands by the textbook, over the texts of the sample."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500").select("doc_id", "text", "lang")
    r = random.Random(1)
    odd = [(-1, " | ".join("".join(r.choices("qxzjkvw", k=r.randint(2, 9))) for _ in range(97)), "en"), (-2, "12 34 " * 9, "en"), (-3, "12 34 " * 9, "en"), (-4, "... --- " * 30, "en"), (-5, "a", "xx"), (-6, "", "yy"), (-7, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = docs.collect()
    middle = lambda v: sorted(v)[math.ceil(len(v) / 2) - 1]
    want, values = {}, {}
    for lang in {r.lang for r in rows}:
        own = [r for r in rows if r.lang == lang]
        scored = {}
        for r, (n, value) in zip(own, brute_scores([r.text or "" for r in own]), strict=True):
            n_words, *_, repeated = base(r.text)
            scored[r.doc_id] = (n_words < 20 or 100 * repeated > 30 * n_words, value, math.sqrt(1 + q.SHORT / max(1, n)))
        usual = {(round(x, 9), w) for failed, x, w in scored.values() if not failed and x is not None}
        m = middle([x for x, _ in usual]) if usual else 0
        away = [(x - m) / w for x, w in usual]
        under, over = (max(q.LEAST_SPREAD, 1.4826 * middle(v) if v else 0) for v in ([-a for a in away if a <= 0], [a for a in away if a >= 0]))
        for doc, (failed, x, w) in scored.items():
            values[doc] = x
            want[doc] = (failed, not failed and (x is None or m - q.BELOW * under * w <= x <= m + q.ABOVE * over * w))
    found = q.judge(docs).collect()
    for r in found:
        assert (r.perplexity is None) == (values[r.doc_id] is None)
        assert r.perplexity is None or math.isclose(math.log(r.perplexity), values[r.doc_id], rel_tol=1e-4, abs_tol=1e-6)
    got = {r.doc_id: (r.base_failed, r.kept) for r in found}
    assert got == want
    assert got[-1] == (False, False) and got[-2][0]


def test_the_model_decides_and_not_lengths_or_marks(spark):
    """Words that no other text has are rejected at the lengths and marks of usual ones; usual long words and marks are kept."""
    r = random.Random(5)
    syllables = ["ka", "lo", "mi", "ter", "na", "su", "ber", "on", "di", "pra"]
    word = lambda k: "".join(r.choices(syllables, k=k))
    common = [word(r.randint(1, 3)) for _ in range(60)]
    long = [word(5) for _ in range(25)]
    text = lambda pool, n: " ".join(r.choices(pool, k=n))
    rows = [(i, text(common, 80), "en") for i in range(150)]
    rows += [(1000 + i, text(common, 60) + " " + text(long, 20), "en") for i in range(50)]
    odd = "".join(chr(c) for c in range(97, 123))
    strange = [(2000 + i, " ".join("".join(r.choices(odd, k=len(w))) for w in r.choices(common, k=80)), "en") for i in range(5)]  # lengths of usual words
    stretched = [(3000 + i, text(long, 70) + " " + text(common, 10), "en") for i in range(5)]  # twice as many bytes a word
    got = {x.doc_id: x for x in q.judge(spark.createDataFrame(rows + strange + stretched, "doc_id long, text string, lang string")).collect()}
    assert not any(got[d].kept for d, *_ in strange)
    assert np.mean([got[d].kept for d, *_ in rows]) > 0.99
    # a ratio of bytes to words would put all of these beyond all strange ones
    assert min(len(t) for _, t, _ in stretched) > max(len(t) for _, t, _ in strange) * 1.5
    assert all(got[d].perplexity < min(got[e].perplexity for e, *_ in strange) for d, *_ in stretched)


def test_a_text_is_not_judged_by_itself(spark):
    """A text that says a strange thing a hundred times teaches the model nothing about itself."""
    texts = ["the cat sat on the mat and the dog ran to the hat in the sun " * 2] * 30
    strange = " ".join(f"qzx{i % 11}vj kwq{i % 7}zz" for i in range(60))
    found = brute_scores([*texts, strange])
    got = {r.doc_id: r for r in q.judge(spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, strange])], "doc_id long, text string, lang string")).collect()}
    assert math.isclose(math.log(got[30].perplexity), found[30][1], rel_tol=1e-4) and found[30][1] > 4 * found[0][1]


def test_each_ngram_has_its_own_entry_in_any_number_of_shards(spark, monkeypatch):
    """Keys that share 22 bits of their hash with seen ones stay unseen, and small shards give the same values."""
    import hashlib

    from rangeloom.llm.common import mix, new_folder

    found = ["".join(chr(97 + (i * i + 7 * i * j) % 26) for j in range(400)) for i in range(40)]
    parts = q.model(q.counted_ngrams(spark.createDataFrame([(i, t, "en") for i, t in enumerate(found)], "doc_id long, text string, lang string")))
    seen = np.array(sorted(r.key for r in parts[q.ORDER][0].collect()), np.uint64)
    others = np.setdiff1d(np.random.default_rng(1).integers(0, 1 << 8 * q.ORDER, 1 << 21, dtype=np.uint64), seen)
    bits = lambda keys: mix(keys + np.uint64(1)) >> np.uint64(42)
    twins = others[np.isin(bits(others), bits(seen))]
    assert len(twins) > 100
    values = []
    for most, held in ((1 << 20, 1 << 20), (64, 1 << 10)):
        monkeypatch.setattr(q, "SHARD", most, raising=False)
        monkeypatch.setattr(q, "HELD", held, raising=False)
        folder = new_folder(spark, "m")
        q.write_model(parts, folder)
        a = q.arrays(folder, hashlib.sha256(b"=en").hexdigest())
        assert np.isnan(a.find(f"p{q.ORDER}", twins)).all()
        values.append(a.find(f"p{q.ORDER}", seen)[:, 0])
    assert not np.isnan(values[0]).any() and np.array_equal(*values)


def test_both_ends_of_the_band_reject(spark):
    """A spread of 0.1 around a median of 2: the band has a lower end above perplexity 1 that templated text falls below."""
    r = np.random.default_rng(3)
    usual = [(i, float(x)) for i, x in enumerate(r.normal(2.0, 0.1, 1000))]
    rows = [(i, "=en", 100, 0, 0, 0, 0, 20000, x, False) for i, x in [*usual, (-1, 0.5), (-2, 3.0)]]
    found = spark.createDataFrame(rows, q.SCORES_DDL + ", base_failed boolean")
    got = {x.doc_id: x for x in q.banded(found).collect()}
    assert not got[-1].kept and not got[-2].kept
    assert np.mean([got[i].kept for i, _ in usual]) == 1
    assert got[-1].lower > math.exp(0.5) and got[-1].upper < math.exp(3)


def test_lines_that_polynomials_modulo_powers_of_two_cannot_tell_apart_are_different():
    a = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    got = q.base_counts(*flat_bytes(pa.array([a + "\n" + a.translate(str.maketrans("ab", "ba")), a + "\n" + a])))
    assert got["n_dup_lines"].tolist() == [0, 1]


def test_a_batch_hashes_its_bytes_once_and_asks_for_each_ngram_once(monkeypatch):
    data = np.frombuffer(b"one two three one two three\n" * 20, np.uint8)
    offsets, asked, summed = np.array([0, 280, 560]), [], []
    monkeypatch.setattr(q, "running_sums", lambda d, f=q.running_sums: summed.append(1) or f(d))

    class Nothing(q.Arrays):
        def __init__(self):
            pass

        def find(self, kind, keys):
            asked.append((kind, len(keys), len(set(keys.tolist()))))
            return np.full((len(keys), 2), np.nan) if kind == f"p{q.ORDER}" else np.full(len(keys), np.nan)

    sums = q.running_sums(data)
    plain = q.base_counts(data, offsets, sums), q.log_perplexity(data, offsets, Nothing(), (10, 0.5, 1.0, 1.5, 0.3), sums)
    assert len(summed) == 1 and all(n == m for kind, n, m in asked if kind == f"p{q.ORDER}")
    again = q.base_counts(data, offsets), q.log_perplexity(data, offsets, Nothing(), (10, 0.5, 1.0, 1.5, 0.3))
    assert all((plain[0][k] == again[0][k]).all() for k in again[0]) and all((x == y).all() for x, y in zip(plain[1], again[1], strict=True))


def test_a_shard_is_loaded_once_for_many_batches(spark, monkeypatch):
    """Shards beyond what a worker holds are not loaded again for every batch; entries that are there once are not needed for a score."""
    from rangeloom.llm.common import new_folder

    texts = [" ".join(f"w{(i * 37 + j * j * (i % 5 + 1)) % 3001}x{j % 7}" for j in range(300)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    grams, each = q.counted_ngrams(docs).cache(), q.counted_words(docs).cache()
    layer, whole, small = q.word_layer(each), new_folder(spark, "m"), new_folder(spark, "m")
    q.write_model(q.model(grams), whole, each)
    want = {r.doc_id: r.log_ppl for r in q.scores(docs, whole, layer).collect()}
    monkeypatch.setattr(q, "SHARD", 256)
    monkeypatch.setattr(q, "HELD", 0)
    assert each.where("c = 1").count() > 100
    q.write_model(q.model(grams), small, each, **({"least": 2} if "least" in q.write_model.__code__.co_varnames else {}))
    loads = Counter()
    monkeypatch.setattr(q, "Shard", lambda where, at, counted, f=q.Shard: loads.update([at]) or f(where, at, counted))
    monkeypatch.setattr(q, "_rows", lambda _: type("Rows", (), {"mapInArrow": lambda self, run, ddl: run})())
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t], "lang": ["=en"]}) for i, t in enumerate(texts)]
    got = {i: x for b in q.scores(None, small, layer)(iter(batches)) for i, x in zip(b["doc_id"].to_pylist(), b["log_ppl"].to_pylist(), strict=True)}
    assert len(loads) > 20 and max(loads.values()) == 1
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-12) for i in got)
