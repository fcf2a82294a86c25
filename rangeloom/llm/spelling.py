"""Grouping spelling variants: words one edit apart, found by bit-sliced indexes of positions.

Two words one edit apart (an inserted, deleted or replaced letter) agree outside a window of the shorter word that holds the
edit. Words meet by what surrounds a window: first the front and the back half, and where more than ``MOST`` words share the
surroundings, again by the halves of the window, down to windows of one letter, which at most ``MOST`` words can share. Windows
follow each other without overlap, and a pair counts in the window of the leftmost place its edit can be said to have, so once.

Within a block of buckets an index has a bitset over the block's words for each (position, letter). All words of the block
are queries at the same time: word-parallel recurrences over the letters of a query carry the set of words without an error, and
those with a replaced, a missing and an additional letter (the index shifted by no, one or minus one position).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import cut, in_small_batches, release, stored
from rangeloom.llm.line_dedup import ascii_lower

RUN = "[A-Za-zÀ-ÿ]+"
#: Letters that a word may have: 26 and the 64 of U+00C0 to U+00FF. One letter's window: 90 words of the shorter length and 90 * 90 of the longer.
LETTERS = 26 + 64
MOST = 8192
if MOST < LETTERS + LETTERS * LETTERS:
    raise ValueError("a window of one letter must fit a bucket")
#: Words of a block (unless one bucket has more), and cells of its letter matrix.
BLOCK, CELLS = 2048, 1 << 23
NEAR = "word string, n_near long, best struct<less:long,word:string>"


def misspelt(doc_id: Column, run: Column, divisor: int) -> Column:
    """The run without one letter if its checksum in the document says so: noise that stands for typing errors."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % divisor == 0, short).otherwise(run)


def vocabulary(docs: DataFrame, divisor: int = 31, least_chars: int = 7, least_n: int = 2) -> DataFrame:
    """word and n of the words of all texts (null: none); a null id counts as the empty id."""
    runs = in_small_batches(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", ascii_lower(F.col("run")).alias("run"))
    words = runs.select(misspelt(F.col("doc_id"), F.col("run"), divisor).alias("word")).where(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def _filed(rows: DataFrame) -> DataFrame:
    """rows (word, n, m, i, j) with the key of their bucket: length m of the shorter word, and the word without its window [i, j)."""
    tail = F.col("m") - F.col("j")
    around = F.struct("m", "i", "j", F.substring("word", F.lit(1), F.col("i")).alias("a"), F.substring(F.col("word"), F.char_length("word") - tail + 1, tail).alias("z"))
    return rows.withColumn("key", F.xxhash64(around))


def _windows(*bounds: tuple) -> Column:
    return F.explode(F.array(*[F.struct(m.alias("m"), i.alias("i"), j.alias("j")) for m, i, j in bounds])).alias("x")


def filed_by_halves(words: DataFrame) -> DataFrame:
    """Every word as the shorter and as the longer of a pair, by its front and its back half."""
    size, zero = F.char_length("word"), F.lit(0)
    both = [(m, a, z) for m in (size, size - 1) for a, z in ((zero, F.floor(m / 2).cast("int")), (F.floor(m / 2).cast("int"), m))]
    return _filed(words.select("word", "n", _windows(*both)).select("word", "n", "x.*").where("m > 0"))


def filed_again(rows: DataFrame) -> DataFrame:
    """The rows by the halves of their windows."""
    middle = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
    halves = _windows((F.col("m"), F.col("i"), middle), (F.col("m"), middle, F.col("j")))
    return _filed(rows.where("j - i > 1").select("word", "n", halves).select("word", "n", "x.*"))


def one_edit(windows: list[bytes], buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, found): numbers of windows (a byte for each letter) of one bucket, one edit apart."""
    n = len(windows)
    size = np.fromiter(map(len, windows), np.int64, n)
    order = np.argsort(-size, kind="stable")  # queries that end leave from the end
    size, buckets, longest = size[order], np.asarray(buckets)[order], int(size.max())
    letters = np.zeros((n, longest + 2), np.uint8)
    for r, k in enumerate(order.tolist()):
        letters[r, : size[r]] = np.frombuffer(windows[k], np.uint8)
    wide = -(-n // 64) * 64
    alphabet = np.unique(letters)
    place = np.zeros(256, np.int64)
    place[alphabet] = np.arange(len(alphabet))

    def bits(marks: np.ndarray) -> np.ndarray:
        """Rows of marks as bitsets."""
        out = np.zeros((len(marks), wide // 8), np.uint8)
        packed = np.packbits(marks, axis=1, bitorder="little")
        out[:, : packed.shape[1]] = packed
        return out.view(np.uint64)

    def index(p: int) -> np.ndarray:
        """The bitset of each letter at a position; none for the sign that fills short words."""
        if not 0 <= p < longest:
            return np.zeros((len(alphabet), wide // 64), np.uint64)
        out = bits(alphabet[:, None] == letters[:, p])
        out[alphabet == 0] = 0
        return out

    longer = [bits((size > p)[None])[0] for p in range(longest + 2)]
    exact = [bits((size == p)[None])[0] for p in range(longest + 2)]
    none = np.zeros(wide // 64, np.uint64)
    parts = []
    for a in range(0, n, 1024):
        own, ends = letters[a : a + 1024], size[a : a + 1024]
        zero = bits(buckets[a : a + 1024, None] == buckets)
        less, more, other = np.zeros_like(zero), zero & longer[0], np.zeros_like(zero)
        before, here = index(-1), index(0)
        for k in range(longest + 1):
            live = int(np.searchsorted(-ends, -k, side="right"))  # queries of k letters or more
            done = int(np.searchsorted(-ends, -k, side="left"))
            if done < live:
                found = other[done:live] & exact[k] | less[done:live] & (exact[k - 1] if k else none) | more[done:live] & exact[k + 1]
                q, w = np.nonzero(found)
                if len(q):
                    b, bit = np.nonzero(np.unpackbits(found[q, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                    parts.append((q[b] + a + done, w[b] * 64 + bit))
            if not done:
                break
            zero, less, more, other = zero[:done], less[:done], more[:done], other[:done]
            after, c = index(k + 1), place[own[:done, k]]
            same = here[c]
            less = less & before[c] | zero
            other = other & same | zero & ~same & longer[k]
            zero = zero & same
            more = more & after[c] | zero & longer[k + 1]
            before, here = here, after
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    q, w = (np.concatenate(x) for x in zip(*parts, strict=True))
    return order[q], order[w]


def _counted_once(q: np.ndarray, w: np.ndarray, windows: list[bytes], first: np.ndarray) -> np.ndarray:
    """Marks the pairs whose leftmost edit is in this window: not those where it could as well stand right before the window."""
    keep = np.ones(len(q), bool)
    for x in np.flatnonzero(~first[q]).tolist():
        a, b = windows[q[x]], windows[w[x]]
        if len(a) != len(b) and (a[1:] == b if len(a) > len(b) else b[1:] == a):
            keep[x] = False
    return keep


class _Block:
    """Whole buckets that go through one index."""

    def __init__(self) -> None:
        self.words, self.n, self.windows, self.buckets, self.first, self.longer, self.longest = [], [], [], [], [], [], 0

    def fits(self, rows: list[tuple]) -> bool:
        longest = max(self.longest, max(len(r[0]) - r[2] for r in rows))
        return not self.words or len(self.words) + len(rows) <= BLOCK and (len(self.words) + len(rows)) * longest <= CELLS

    def add(self, rows: list[tuple]) -> None:
        known: dict = {}
        for word, n, m, i, j in rows:
            z = len(word) - (m - j)
            # keys are hashes: a bucket is told by what surrounds its window
            self.buckets.append(known.setdefault((m, i, j, word[:i], word[z:]), len(self.words) + len(known)))
            self.windows.append(word[i:z].encode("latin-1"))
            self.longest = max(self.longest, z - i)
            self.first.append(i == 0)
            self.longer.append(len(word) > m)
        self.words += [r[0] for r in rows]
        self.n += [r[1] for r in rows]

    def result(self) -> pa.RecordBatch | None:
        buckets = np.array(self.buckets)
        _, buckets = np.unique(buckets, return_inverse=True)
        q, w = one_edit(self.windows, buckets)
        longer = np.array(self.longer)
        one = ~(longer[q] & longer[w])  # two longer words meet as shorter ones elsewhere
        q, w = q[one], w[one]
        keep = _counted_once(q, w, self.windows, np.array(self.first))
        q, w = q[keep], w[keep]
        if not len(q):
            return None
        order = sorted(range(len(self.words)), key=lambda x: (-self.n[x], self.words[x]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        s = np.argsort(q, kind="stable")
        who, at, count = np.unique(q[s], return_index=True, return_counts=True)
        best = [order[x] for x in np.minimum.reduceat(rank[w[s]], at).tolist()]
        best = pa.StructArray.from_arrays([pa.array([-self.n[x] for x in best], pa.int64()), pa.array([self.words[x] for x in best])], ["less", "word"])
        return pa.RecordBatch.from_arrays([pa.array([self.words[x] for x in who.tolist()]), pa.array(count.astype(np.int64)), best], names=["word", "n_near", "best"])


def _near_in_blocks(filed: DataFrame) -> DataFrame:
    """For each word of each bucket how many are near it there, and the best of them; buckets come whole and in order to a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, key = _Block(), [], None

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal block
            if len(rows) > 1:  # a word alone has nothing near
                if not block.fits(rows):
                    if (out := block.result()) is not None:
                        yield out
                    block = _Block()
                block.add(rows)
            rows.clear()

        for b in batches:
            for k, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key:
                    yield from close()
                    key = k
                rows.append(tuple(row))
        yield from close()
        if block.words and (out := block.result()) is not None:
            yield out
        release()

    return filed.select("key", "word", "n", "m", "i", "j").repartition("key").sortWithinPartitions("key").mapInArrow(run, NEAR)


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """n_near and best (less: minus its n, word) of words that have near ones, in parts to be added up."""
    out, filed = None, filed_by_halves(words)
    while True:
        crowded = stored(filed.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > most).select("key"))
        some = not crowded.isEmpty()
        wide = F.col("j") - F.col("i") > 1
        # buckets of one letter's windows are bounded by the alphabet, but for keys that two of them share
        left = filed.join(crowded, "key", "left_anti").unionByName(filed.where(~wide).join(crowded, "key", "left_semi")) if some else filed
        found = _near_in_blocks(left)
        out = found if out is None else out.unionByName(found)
        if not some:
            return out
        filed = cut(filed_again(filed.where(wide).join(crowded, "key", "left_semi")))


def group_spellings(docs: DataFrame, ratio: int = 10, divisor: int = 31, least_chars: int = 7, least_n: int = 2, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that occurs often enough.

    form: the near word that occurs most (the first in code-point order among equals) if it occurs ``ratio`` times as often; root:
    the last of the word's forms, each of which occurs so much more often that there are few.
    """
    if ratio < 2 or least_n < 1:
        raise ValueError("ratio must be at least 2 and least_n at least 1")
    words = stored(vocabulary(docs, divisor, least_chars, least_n))
    none = F.lit(None).cast("struct<less:bigint,word:string>")
    parts = near_words(words, most).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best")
    parts = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best")).unionByName(parts)
    each = parts.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    takes = -F.col("best.less") >= F.col("n") * ratio
    each = stored(each.select("word", F.when(takes, F.col("best.word")).alias("form"), "n", "n_near", F.when(takes, -F.col("best.less")).alias("form_n")))
    most_n = each.agg(F.max("n")).first()[0] or 1
    steps = math.floor(math.log(max(1, most_n / least_n), ratio) + 1e-9)  # forms that can follow each other
    roots = each.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = cut(roots.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
    return each.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
