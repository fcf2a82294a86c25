from collections import Counter

import corpus_pipeline as cp
from rangeloom.llm import classifier, packing, pii
from test_simhash import brute_kept

FOLDER = "/root/testdata/sf0.001"


def cut(raw, all_raw, length=200):
    count = Counter(b[i : i + length] for b in all_raw for i in range(len(b) - length + 1))
    gone = bytearray(len(raw))
    for i in range(len(raw) - length + 1):
        if count[raw[i : i + length]] > 1:
            gone[i : i + length] = b"\1" * length
    return bytes(c for c, g in zip(raw, gone, strict=True) if not g)


def brute(spark, rows):
    """Texts by doc_id before packing."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = {r.doc_id for r in classifier.classify(docs, labels).collect() if r.predicted}
    rows = [r for r in rows if r[0] in good]
    kept = brute_kept([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if r[0] in kept]
    raw = [(r[1] or "").encode() for r in rows]
    out = {}
    for r, b in zip(rows, raw, strict=True):
        text = cut(b, raw)
        try:
            text = text.decode()
        except UnicodeDecodeError:
            text = text.decode(errors="replace").replace("�", "")
        out[r[0]] = pii.rewritten(pii.session_key(spark), text, pii.entities(text))
    return out


def test_stages_equal_brute_force(spark, sample):
    rows = [tuple(r) for r in sample.select(*cp.COLUMNS).collect()]
    want = brute(spark, rows)
    got = cp.run(spark, FOLDER).collect()
    pieces = packing.pieces(spark.createDataFrame(list(want.items()), "doc_id long, text string")).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(tuple(r) for r in pieces)
    assert 0 < len(want) < len(rows)


def test_each_stage_keeps_the_columns(spark, edge, nothing):
    labels_for = FOLDER
    for docs in (edge, nothing):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, labels_for)
            assert out.columns == cp.COLUMNS, name
            assert out.count() <= docs.count()
        assert cp.packed(spark, docs, labels_for).count() >= 0


def test_one_row_of_each_component(spark, edge):
    got = cp.near_dedup(spark, edge, FOLDER).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert sorted((r.doc_id for r in got), key=str) == sorted(brute_kept(rows), key=str)
