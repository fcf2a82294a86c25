"""SimHash near-duplicate detection with pigeonring filtering.

A fingerprint of 64 bits is cut into a ring of segments, one more than the allowed distance. If two fingerprints differ
in at most t bits, some chain of consecutive segments keeps every cumulative difference within its proportional share
of t: none in the first segment, one in the first two, two in the first three, and so on. The bucket key holds the first three
segments of a chain; each fingerprint is filed under its own key and those with one bit of the second or third segment
flipped, so two that differ in two of these bits meet. What meets in a bucket is tested on the chain's further lengths, then on
the whole distance.

A bucket gives a spanning forest of its links, not all pairs: whoever is linked to a member is tested against those that are
not linked yet. Every link is a link of some bucket, so the forests together have the components of all links, and a dense group
gives as many rows as it has members. Equal fingerprints are one node. Links are made transitive by star contraction.

``near_duplicates`` is by the fingerprint of word shingles alone. ``one_of_each`` asks for a similarity of 0.8 or more on five-word
shingles: an edited word changes five shingles but one word, so candidates come from the fingerprints of the distinct words
(WORD_BITS apart at most) and are checked by those of the shingles (SHINGLE_BITS), and the links that come out by a sketch, SKETCH
more fingerprints of the shingles with other bits of their hashes. The similarity is estimated from their distance: of 512 bits, pairs at a
similarity of 0.8 are 77 apart in the mean with a deviation of 8, at 0.7 they are 98; SKETCH_BITS of 86 stand for 0.76. No forest is made before
that check: of a bucket's components by fingerprints, small ones give all their links, and large ones are searched again with their sketches. Large
components of all buckets that have the same least member (by a hash) are searched together, each of their members once and by whole distances.

Defined cases: null text is the empty text; a text without words has fingerprint 0; repeated rows and repeated ids give
a row each; a component in which every id is null has a null component_id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import connected, cut, flat_bytes, mix, release, shuffle_partitions, texts

SEED = 42
#: Segments of a key, bytes of a text that are cut into words at a time, and members of a bucket that are tested pair by pair.
KEYED, BLOCK, FEW = 3, 1 << 20, 16
WORD_BITS, SHINGLE_BITS = 7, 14
SKETCH, SKETCH_BITS = 8, 86

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: str) -> Iterator[list[bytes]]:
    """The words of a text with ASCII letters in lower case, by blocks of some BLOCK bytes."""
    raw, at = text.encode(), 0
    while at < len(raw):
        end = _BLANK.search(raw, at + BLOCK) if at + BLOCK < len(raw) else None
        end = end.start() if end else len(raw)
        yield raw[at:end].lower().split()
        at = end


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return ones


def _majority(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text, by blocks; a text of fewer words is one shingle, one without words has none."""
    from xxhash import xxh64_intdigest as h

    found, before = False, []
    for block in word_blocks(text):
        parts = before + block
        if len(parts) < words:
            before = parts
            continue
        line = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
        yield np.array([h(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], dtype=np.uint64)
        found, before = True, parts[len(parts) - words + 1 :]
    if before and not found:
        yield np.array([h(b" ".join(before), SEED)], dtype=np.uint64)


def fingerprint(text: str, words: int) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    return sketched(text, words, 0)[0]


def sketched(text: str, words: int, more: int = SKETCH) -> tuple[int, bytes]:
    """The fingerprint of the shingles, and so many more of other bits of their hashes, one after the other."""
    ones, n = np.zeros((1 + more, 64), np.int64), 0
    for hashes in shingle_hashes(text, words):
        n += len(hashes)
        ones[0] += _ones(hashes)
        for k in range(more):
            ones[1 + k] += _ones(mix(hashes + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
    return (_majority(ones[0], n) if n else 0), np.packbits(2 * ones[1:] > n, bitorder="little").tobytes()


def word_fingerprint(text: str) -> int:
    """As fingerprint, of the distinct words."""
    from xxhash import xxh64_intdigest as h

    found = np.zeros(0, np.uint64)
    for block in word_blocks(text):
        found = np.union1d(found, np.array([h(w, SEED) for w in set(block)], dtype=np.uint64))
    return _majority(_ones(found), len(found)) if len(found) else 0


def fingerprints(docs: DataFrame, words: int = 4, by_word: bool = False) -> DataFrame:
    """doc_id, k2 (hash of the text) and fp (signed long) of every row; by_word: fp of the distinct words, wide and sketch of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column(1).to_pylist()
            if by_word:
                wide, sketch = zip(*(sketched(t, words) for t in found), strict=True) if found else ((), ())
                cols = [pa.array([word_fingerprint(t) for t in found], pa.int64()), pa.array(wide, pa.int64()), pa.array(sketch, pa.binary())]
            else:
                cols = [pa.array([fingerprint(t, words) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), *cols], names=["doc_id", "k2", "fp", "wide", "sketch"][: 2 + len(cols)])
            release()

    return texts(docs, F.xxhash64(F.coalesce("text", F.lit(""))).alias("k2")).mapInArrow(run, "doc_id long, k2 long, fp long" + ", wide long, sketch binary" * by_word)


def _ring(distance: int) -> list[tuple[int, int]]:
    """(offset, size) of distance + 1 segments that share 64 bits."""
    n = distance + 1
    sizes = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def _keys(distance: int) -> list[F.Column]:
    """The keys of a fingerprint: for every chain its first segments, plain and with one bit flipped after the first."""
    ring, out = _ring(distance), []
    n = len(ring)
    for i in range(n):
        own, key, flips, width = [ring[(i + k) % n] for k in range(min(KEYED, n - 1))], None, [0], 0
        for k, (off, size) in enumerate(own):
            part = F.shiftrightunsigned("fp", off).bitwiseAND(F.lit((1 << size) - 1))
            key = part if key is None else F.shiftleft(key, size).bitwiseOR(part)
            width += size if k else 0
        flips += [1 << b for b in range(width)]
        out += [key.bitwiseXOR(F.lit(i << 58 | f)) for f in flips]
    return out


class Chains:
    """The test of two fingerprints that meet under a key of chain i: each further length, the whole distance, then ``wide``."""

    def __init__(self, distance: int, wide_distance: int | None):
        ring = _ring(distance)
        n = len(ring)
        self.distance, self.wide_distance = distance, wide_distance
        self.masks = [[sum(((1 << s) - 1) << o for o, s in (ring[(i + k) % n] for k in range(length))) for length in range(1, n)] for i in range(n)]
        self.budgets = [length * distance // n for length in range(1, n)]

    def linked(self, i: np.ndarray, diff: np.ndarray, wide: np.ndarray | None) -> np.ndarray:
        """Positions of the pairs with difference diff that are links; i is the chain of each, in rising order."""
        out = []
        for chain in np.unique(i):
            at = np.arange(np.searchsorted(i, chain), np.searchsorted(i, chain, side="right"))
            for mask, most in zip(self.masks[chain], self.budgets, strict=True):
                at = at[np.bitwise_count(diff[at] & np.uint64(mask)) <= most]
            out.append(at[self.near(diff[at], None if wide is None else wide[at])])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def near(self, diff: np.ndarray, wide: np.ndarray | None) -> np.ndarray:
        """As linked, for pairs of any chain."""
        at = np.flatnonzero(np.bitwise_count(diff) <= self.distance)
        return at if wide is None else at[np.bitwise_count(wide[at]) <= self.wide_distance]

    def trees(self, chain: int | None, fp: np.ndarray, wide: np.ndarray | None, sketch: np.ndarray | None = None, most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each component of the links among fp that has any: links (two arrays of positions) that connect it. chain: None for links of any chain. With sketch, rows of
        longs, a link's sketches differ in ``most`` bits at most too."""
        left = np.arange(len(fp))
        while len(left):
            a, b, queue, left = [], [], [left[0]], left[1:]
            while queue and len(left):
                one = queue.pop()
                diff, apart = fp[left] ^ fp[one], None if wide is None else wide[left] ^ wide[one]
                at = self.near(diff, apart) if chain is None else self.linked(np.full(len(left), chain), diff, apart)
                if sketch is not None and len(at):
                    at = at[np.bitwise_count(sketch[left[at]] ^ sketch[one]).sum(axis=1, dtype=np.int64) <= most]
                if len(at):
                    queue += left[at].tolist()
                    a.append(np.full(len(at), one))
                    b.append(left[at])
                    left = np.delete(left, at)
            if a:
                yield np.concatenate(a), np.concatenate(b)

    def all_among(self, chain: int, members: np.ndarray, fp: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every link among a few members."""
        i, j = np.triu_indices(len(members), 1)
        a, b = members[i], members[j]
        at = self.linked(np.full(len(a), chain), fp[a] ^ fp[b], wide[a] ^ wide[b])
        return a[at], b[at]


def _longs(column: pa.Array) -> np.ndarray:
    """A column of longs, or of sketches as rows of longs, unsigned."""
    if pa.types.is_binary(column.type):
        return np.ascontiguousarray(flat_bytes(column)[0]).reshape(len(column), 8 * SKETCH).view(np.uint64)
    return np.asarray(column).view(np.uint64)


def _by_bucket(batches: Iterator[pa.RecordBatch], found) -> Iterator[pa.RecordBatch]:
    """What found makes of the columns of rows that are sorted by the first one, the key; no bucket is cut in two."""
    held = None
    for b in batches:
        cols = [_longs(c) for c in b.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        # the last bucket may go on in the next batch
        end = int(np.searchsorted(cols[0].view(np.int64), cols[0].view(np.int64)[-1])) if len(cols[0]) else 0
        held = [c[end:] for c in cols]
        yield found([c[:end] for c in cols])
    if held is not None:
        yield found(held)


def _sizes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of the buckets of sorted keys."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return first, np.diff(first, append=len(key))


def _pairs(a: list, b: list, cols: list[np.ndarray], names: list[str], **more: pa.Array) -> pa.RecordBatch:
    a, b = (np.concatenate([np.zeros(0, np.int64), *v]) for v in (a, b))
    found = [pa.array(c[v].view(np.int64)) for v in (a, b) for c in cols]
    return pa.RecordBatch.from_arrays([*found, *more.values()], names=[*(f"{s}_{n}" for s in "ab" for n in names), *more])


def _sides(found: DataFrame, names: list[str], *more: str) -> DataFrame:
    side = lambda x: F.col(f"{x}_fp").alias(x) if names == ["fp"] else F.struct(*[F.col(f"{x}_{n}").alias(n) for n in names]).alias(x)
    return found.select(side("a"), side("b"), *more)


def _ordered(found: DataFrame) -> DataFrame:
    return found.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _met(nodes: DataFrame, distance: int, wide_distance: int | None, every: bool) -> DataFrame:
    """a, b and crowd: the links among nodes that meet in a bucket. A bucket of more than FEW members gives, unless ``every`` one is asked
    for, enough of them to connect what they connect; else its components of more than FEW members give those (a and b) with a crowd: the least
    hash of a member. The buckets of a dense group have many members in common, so few crowds have all of them."""
    names = ["fp"] if wide_distance is None else ["fp", "wide"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Chains(distance, wide_distance)
        yield from _by_bucket(batches, lambda cols: found(test, cols))

    def found(test: Chains, cols: list[np.ndarray]) -> pa.RecordBatch:
        key, fp, wide = cols[0], cols[1], cols[2] if len(cols) > 2 else None
        first, size = _sizes(key)
        a, b, crowds, names_of = [], [], [], []
        for gap in range(1, min(FEW, int(size.max(initial=0)))):
            one = np.concatenate([np.zeros(0, np.int64), *(first[(size <= FEW) & (size > gap + k)] + k for k in range(FEW - gap))])
            one = one[np.argsort(key[one] >> np.uint64(58), kind="stable")]
            at = one[test.linked((key[one] >> np.uint64(58)).astype(np.int64), fp[one] ^ fp[one + gap], None if wide is None else wide[one] ^ wide[one + gap])]
            a.append(at)
            b.append(at + gap)
        for start, n in zip(first[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
            own, chain = slice(start, start + n), int(key[start]) >> 58
            for x, y in test.trees(chain, fp[own], None if wide is None else wide[own]):
                members = np.append(x[0], y)
                if every and len(members) > FEW:
                    crowds.append(start + members)
                    names_of.append(np.full(len(members), mix(fp[crowds[-1]] + mix(wide[crowds[-1]])).min()))
                    continue
                if every:
                    x, y = test.all_among(chain, members, fp[own], wide[own])
                a.append(start + x)
                b.append(start + y)
        links = sum(map(len, a))
        crowd = np.concatenate([np.zeros(0, np.int64), *crowds])
        of = pa.concat_arrays([pa.nulls(links, pa.int64()), pa.array(np.concatenate([np.zeros(0, np.uint64), *names_of]).view(np.int64))])
        return _pairs([*a, crowd], [*b, crowd], cols[1:], names, crowd=of)

    n = shuffle_partitions(nodes.sparkSession)
    # few bytes that become many: each task files its share
    filed = nodes.repartition(n, *names).select(F.explode(F.array(*_keys(max(1, distance)))).alias("key"), *names)
    # by key alone, so that no bucket ends within a task
    filed = filed.repartition(n, "key").sortWithinPartitions("key")
    schema = ", ".join(f"{side}_{n} long" for side in "ab" for n in names)
    return _sides(filed.mapInArrow(run, f"{schema}, crowd long"), names, "crowd")


def links(nodes: DataFrame, distance: int = 4, wide_distance: int | None = None) -> DataFrame:
    """Pairs (a, b) of distinct values of nodes.fp that differ in 1 to ``distance`` bits: enough of them to connect what all of
    them connect. With wide_distance nodes are (fp, wide), a and b structs of both, and wide differs in so many bits at most too."""
    if distance == 0 and wide_distance is None:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    return _ordered(_met(nodes, distance, wide_distance, every=False))


def checked_links(own: DataFrame, distance: int, wide_distance: int, most: int) -> DataFrame:
    """Links of the nodes of own (fp, wide, node, sketch) whose sketches differ in ``most`` bits at most too: enough of them to connect what
    all of them connect. The few links of a small component are checked one by one; large components get the sketches and are searched again."""
    names = ["fp", "wide"]
    each = own.groupBy("node").agg(F.min("sketch").alias("sketch"))  # equal fingerprints: nearly always one text
    met = cut(_met(own.select(*names).distinct(), distance, wide_distance, every=True))
    few = similar(_ordered(met.where("crowd IS NULL")), each, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Chains(distance, wide_distance)
        yield from _by_bucket(batches, lambda cols: found(test, cols))

    def found(test: Chains, cols: list[np.ndarray]) -> pa.RecordBatch:
        key, fp, wide, sketch = cols
        a, b = [], []
        for start, n in zip(*(x.tolist() for x in _sizes(key)), strict=True):
            own = slice(start, start + n)
            for x, y in test.trees(None, fp[own], wide[own], sketch[own], most):
                a.append(start + x)
                b.append(start + y)
        return _pairs(a, b, [fp, wide], names)

    # whatever buckets a crowd comes from, each of its members is sent to it once
    crowds = met.where("crowd IS NOT NULL").select("crowd", F.col("a").alias("node")).distinct().join(each, "node").select("crowd", "node.fp", "node.wide", "sketch")
    crowds = crowds.repartition(shuffle_partitions(own.sparkSession), "crowd").sortWithinPartitions("crowd")
    many = _sides(crowds.mapInArrow(run, "a_fp long, a_wide long, b_fp long, b_wide long"), names)
    return few.unionByName(_ordered(many))


def bits_apart(a: F.Column, b: F.Column, longs: int) -> F.Column:
    """How many bits of two binary columns of so many longs differ."""
    part = lambda c, k: F.conv(F.hex(F.substring(c, 1 + 4 * k, 4)), 16, 10).cast("long")
    return reduce(add, [F.bit_count(part(a, k).bitwiseXOR(part(b, k))) for k in range(2 * longs)])


def similar(found: DataFrame, each: DataFrame, most: int) -> DataFrame:
    """The links (a, b) whose nodes' sketches (node, sketch) differ in ``most`` bits at most."""
    side = lambda x: each.select(F.col("node").alias(x), F.col("sketch").alias(f"{x}_sketch"))
    both = found.join(side("a"), "a").join(side("b"), "b")
    return both.where(bits_apart(F.col("a_sketch"), F.col("b_sketch"), SKETCH) <= most).select("a", "b")


def grouped(docs: DataFrame, words: int = 4, distance: int = 4, wide_distance: int | None = None, sketch_distance: int | None = None) -> DataFrame:
    """doc_id, k2, fp and root (a node that names the component) of every row. wide_distance: as for links, fp of the distinct
    words; sketch_distance: what the links are checked by then."""
    own = cut(fingerprints(docs, words, wide_distance is not None))
    names = ["fp"] if wide_distance is None else ["fp", "wide"]
    own = own.withColumn("node", F.col("fp") if wide_distance is None else F.struct(*names))
    found = links(own.select(*names).distinct(), distance, wide_distance) if sketch_distance is None else checked_links(own, distance, wide_distance, sketch_distance)
    roots = connected(found)
    return own.join(roots, "node", "left").select("doc_id", "k2", "fp", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id that links reach) of every row."""
    own = grouped(docs, words, distance)
    least = own.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return own.join(least, "root").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 5, distance: int = WORD_BITS, wide_distance: int | None = SHINGLE_BITS, sketch_distance: int | None = SKETCH_BITS) -> DataFrame:
    """One row of each component with all its columns: the least doc_id (a row without id only if no other has one)."""
    own = grouped(docs, words, distance, wide_distance, sketch_distance)
    least = own.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(-1)).alias("k1"), "k2")).alias("x"))
    kept = least.select("x.nameless", "x.k1", "x.k2")
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(-1)).alias("k1"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k2"))
    return keyed.join(kept, ["nameless", "k1", "k2"]).dropDuplicates(["nameless", "k1", "k2"]).select("row.*")
