from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rangeloom.llm import token_count
from rangeloom.llm.common import new_folder
from rangeloom.llm.files import make_folder, written_whole


def check(df):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = Counter((r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in df.select("doc_id", "text").collect())
    assert Counter(tuple(r) for r in token_count.count_tokens(df).select("doc_id", "n_tokens").collect()) == want


def test_edge_cases(edge, nothing):
    check(edge)
    check(nothing)


def test_whole_table(sample):
    check(sample)


def test_a_separators_name_in_a_text_is_text(spark):
    check(spark.createDataFrame([(1, "a<|endoftext|>b"), (2, "<|endoftext|>"), (3, None)], "doc_id long, text string"))


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_blocks_that_cut_documents_anywhere(spark, block):
    folder, r = new_folder(spark, "flat"), np.random.default_rng(3)
    make_folder(folder)
    want = []
    for k in range(3):
        lengths = r.integers(0, 40, 30).tolist() if k else [200, 0, 0, 150]
        name = f"{folder}/{k}.bin"
        with written_whole(name) as out:
            for n in lengths:
                out.write(np.append(r.integers(0, 50000, n), 50256).astype("<u2").tobytes())
        want += [(name, i, n) for i, n in enumerate(lengths)]
    files = spark.createDataFrame([(f"{folder}/{k}.bin",) for k in range(3)], "file string")
    got = token_count.scan(spark, files, block_bytes=block).select("file", "ordinal", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_an_ordinary_id_or_a_narrow_file_is_refused(spark, sample):
    for how in ({"end_id": 100}, {"width": 1}):
        with pytest.raises(Exception, match="no separator|more than 1 bytes"):
            token_count.write_flat(sample.limit(3), new_folder(spark, "flat"), **how).count()
