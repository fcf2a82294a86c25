import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rangeloom.llm import packing


def check(df, slack=1.01):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(r.doc_id, i, a, z - a, zlib.crc32(ids[a:z])) for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]
    got = packing.pack(df).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    least = packing.lower_bound(Counter(w[3] for w in want), 1024) if want else 0
    assert least <= len(bins) <= least * slack + 1


def test_edge_cases(edge, nothing):
    check(edge)
    check(nothing)


def test_whole_table(sample):
    check(sample)


def valid(counts, cap, plan):
    total = Counter()
    for pattern, uses in plan:
        assert sum(x * k for x, k in pattern) <= cap
        for x, k in pattern:
            total[x] += k * uses
    assert total == Counter(counts)
    return sum(n for _, n in plan)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15), st.integers(40, 60))
def test_never_worse_than_best_fit(counts, cap):
    fit = valid(counts, cap, packing.best_fit(counts, cap))
    found = valid(counts, cap, packing.complete_bins(counts, cap))
    assert packing.lower_bound(counts, cap) <= found <= fit


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=4), st.lists(st.integers(1, 20), min_size=1, max_size=4))
def test_a_dominated_filling_fits_into_the_other(small, large):
    pattern = lambda v: tuple(sorted(Counter(v).items(), reverse=True))

    def brute(items, room):
        return not items or any(r >= items[0] and brute(items[1:], [*room[:i], r - items[0], *room[i + 1 :]]) for i, r in enumerate(room))

    if packing.fits_into(pattern(small), pattern(large)):
        assert brute(small, large)
    assert packing.fits_into(pattern(small), pattern(small))


def test_uneven_lengths_come_near_the_bound():
    for seed in range(3):
        r = random.Random(seed)
        counts = Counter(r.randint(260, 699) for _ in range(3000))
        fit, found = packing.best_fit(counts, 1024), packing.complete_bins(counts, 1024)
        assert valid(counts, 1024, found) <= valid(counts, 1024, fit)
        assert 0 <= packing.gap(found, counts) <= 0.003 * packing.lower_bound(counts, 1024)


def test_finds_the_optimum_that_best_fit_misses():
    assert valid({5: 1, 4: 1, 3: 2, 2: 2, 1: 1}, 10, packing.complete_bins({5: 1, 4: 1, 3: 2, 2: 2, 1: 1}, 10)) == 2
    r = random.Random(1)
    for _ in range(30):  # bins that were cut exactly: the optimum is known
        counts, n = Counter(), r.randint(2, 8)
        for _ in range(n):
            cuts = sorted({0, 100, *r.sample(range(1, 100), 3)})
            counts.update(z - a for a, z in zip(cuts, cuts[1:], strict=False))
        assert valid(counts, 100, packing.complete_bins(counts, 100)) == n
