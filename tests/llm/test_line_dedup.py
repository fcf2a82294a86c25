import hashlib
from collections import Counter, defaultdict

import pytest

from rangeloom.llm import entries, line_dedup

WHITE = "\t\n\x0b\x0c\r "
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_chars, least_docs):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(list)
    for i, lines in split:
        for k in {x.strip(WHITE).translate(LOWER) for x in lines}:
            if len(k) >= least_chars:
                holders[k].append(i)
    last = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= least_docs}
    out = []
    for i, lines in split:
        keys = [x.strip(WHITE).translate(LOWER) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if k not in last or last[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def check(df, **how):
    how = {"least_chars": 40, "least_docs": 5} | how
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], **how)
    got = line_dedup.drop_lines(df, **how).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, got)) == want


def test_edge_cases(edge, nothing):
    check(edge)
    check(edge, least_chars=1, least_docs=2)
    check(nothing)


def test_shared_lines(spark):
    line = "  The SAME line of É and é, forty code points or more\x0b\r"
    near = "the same line of É and É, forty code points or more"
    rows = [(i, f"own {i}\n{line}\n\n{line.strip().lower()}" if i % 2 else line) for i in range(9)] + [(9, near), (10, near), (10, None), (None, line), (None, "\n")]
    rows += [(3, rows[3][1])] * 2 + [(8, "x\n" + line + "\n")]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    check(spark.createDataFrame([(None, line)] * 7, "doc_id long, text string"))
    check(spark.createDataFrame([(i, "ä" * 39 + "\n" + "ä" * 40 + "\n" + "\x1c" + "b" * 39) for i in range(6)], "doc_id long, text string"))


def test_long_text_and_hot_line(spark):
    hot = "z" * 60
    rows = [(0, "\n".join([hot] * 20000 + ["end"]))] + [(i, f"{hot}\n{i}") for i in range(1, 300)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("name", ["op13_line_dedup"])
def test_query(spark, name):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    want = Counter((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for (i, n, g, t), k in brute(rows, 40, 5).items() for _ in range(k))
    assert Counter(map(tuple, entries.queries()[name](spark, d).collect())) == want
