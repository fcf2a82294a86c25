"""Quality rules: counts of words, symbols and repetition, and bands of n-gram perplexity by language.

The language model gives words their probability. Spark counts the words and the byte n-grams of the whole corpus by language. Byte
n-grams make a modified Kneser-Ney model: continuation counts, discounts and interpolated probabilities are aggregations and joins. Words have the
same discounts above it: a word's discounted share, and for what is left its spelling, byte by byte. Counts and probabilities are written to files
by hash prefix (shards), every entry under its whole key (by its hash, which is one to one), so the model grows with the corpus; the number of
shards follows from the counted entries. Tasks gather texts of a language into lots and look up the different n-grams and words of a lot at once,
so that a shard is loaded once for a lot, however many there are; they hold HELD bytes of shards at a time.

A text is judged by the others: its own words are taken out of the counts, and byte n-grams that no other text has count as unseen. Its
perplexity is that of its words (those with a letter, digit or character beyond ASCII): the inverse of their probability, to the power one by their
number. Its logarithm is compared with the median of the texts of its language that pass the base rules (equal texts count once
there); a text is rejected outside a band of so many robust deviations of either side, the wider the fewer words it has.

Defined cases: null text has no words and fails the base rules; a null language is a language of its own; rows with repeated
or null ids give a row each; a text without such words has no perplexity and is judged by the base rules alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import cut, flat_bytes, in_larger_tasks, in_small_batches, mix, new_folder, release, stored, sub_batches, table
from rangeloom.llm.files import _split
from rangeloom.llm.tokens import hashes_of, running_sums

ORDER = 5  # bytes, at most 7 as keys are positive longs
#: Entries of a shard, and bytes of shards that a worker holds at a time.
SHARD, HELD = 1 << 20, 96_000_000
#: Bytes of a language's texts that are scored together, and of all texts that wait in a task.
LOT, WAITING = 8_000_000, 20_000_000
#: Reach of the band below and above the median in robust deviations of that side, and the number of words at which its
#: variance doubles.
BELOW, ABOVE, SHORT = 12.0, 6.0, 20.0
#: Least deviation of log perplexity, so that a corpus of near equal texts rejects none for nothing.
LEAST_SPREAD = 0.02
WINDOW_WORDS = 8

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_codes = np.arange(256)
#: First bytes of letters, digits and characters beyond ASCII.
_LETTER = ((_codes | 32) >= 97) & ((_codes | 32) <= 122) & (_codes < 128) | (_codes >= 48) & (_codes <= 57) | (_codes >= 0xC2)


def _rows(docs: DataFrame) -> DataFrame:
    return in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("lang"))


# --- base rules ---------------------------------------------------------------------------------------------------


def _groups_of_equal(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element: whether an equal one of its document comes before it, and whether there is another at all."""
    key = mix(h ^ doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    earlier, twice = np.zeros(len(k), bool), np.zeros(len(k), bool)
    earlier[order] = same
    same[:-1] |= same[1:]
    twice[order] = same
    return earlier, twice


def base_counts(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text. sums: the running sums of data, if they are known."""
    n = len(offsets) - 1
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    if not len(data):
        return {x: np.zeros(n, np.int64) for x in names}
    sums = running_sums(data) if sums is None else sums
    owner = np.repeat(np.arange(n), np.diff(offsets))
    total = lambda mark: np.bincount(owner[mark], minlength=n)
    blank = _BLANK[data]
    edge = np.ones(len(data), bool)
    edge[1:] = owner[1:] != owner[:-1]
    close = np.append(edge[1:], True)
    before, after = edge.copy(), close.copy()
    before[1:] |= blank[:-1]
    after[:-1] |= blank[1:]
    first, last = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    word_doc = owner[first]
    # lines: ends are line feeds and text ends
    ends = np.flatnonzero((data == 10) | close)
    stops = np.where(data[ends] == 10, ends, ends + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])
    words_before = np.concatenate([[0], np.cumsum(~blank)])
    real = words_before[stops] > words_before[starts]
    line_doc = owner[ends][real]
    earlier, _ = _groups_of_equal(line_doc, hashes_of(sums, starts[real], stops[real]))
    h = hashes_of(sums, first, last)
    m = len(h) - WINDOW_WORDS + 1
    covered = np.zeros(len(h) + 1, np.int64)
    if m > 0:
        w = np.zeros(m, np.uint64)
        for k in range(WINDOW_WORDS):
            w = w * np.uint64(0xD6E8FEB86659FD93) + h[k : k + m]
        inside = np.flatnonzero(word_doc[:m] == word_doc[WINDOW_WORDS - 1 :])
        _, twice = _groups_of_equal(word_doc[inside], w[inside])
        at = inside[twice]
        covered += np.bincount(at, minlength=len(h) + 1) - np.bincount(at + WINDOW_WORDS, minlength=len(h) + 1)
    repeated = np.cumsum(covered)[:-1] > 0
    return {
        "n_words": np.bincount(word_doc, minlength=n),
        "word_chars": total(~blank & ((data & 0xC0) != 0x80)),
        "n_symbols": total(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_doc[earlier], minlength=n),
        "n_repeat_words": np.bincount(word_doc[repeated], minlength=n),
    }


# --- counting and the model ---------------------------------------------------------------------------------------


def ngrams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of every n-gram inside a text; blanks are one symbol. The last byte is the key's lowest."""
    if len(data) < order:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    symbols = np.where(_BLANK[data], np.uint8(32), data).astype(np.uint64)
    key = np.zeros(len(data) - order + 1, np.uint64)
    for k in range(order):
        key = key << np.uint64(8) | symbols[k : k + len(key)]
    inside = np.zeros(len(data) + 1, np.int64)
    for a in offsets[1:-1]:  # n-grams that cross a text's end
        inside[max(0, a - order + 1)] += 1
        inside[a] -= 1
    keep = np.flatnonzero(np.cumsum(inside)[: len(key)] == 0)
    return keep, key[keep]


def words(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text, key) of every word with a letter."""
    if not len(data):
        return (*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    solid, edge = ~_BLANK[data], np.ones(len(data), bool)
    edge[1:] = owner[1:] != owner[:-1]
    before = edge.copy()
    before[1:] |= ~solid[:-1]
    after = np.append(edge[1:], True)
    after[:-1] |= ~solid[1:]
    first, last = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    real = letters[last] > letters[first]
    first, last = first[real], last[real]
    return first, last, owner[first], hashes_of(running_sums(data) if sums is None else sums, first, last)


def counted_words(docs: DataFrame) -> DataFrame:
    """lang, key, c of every word of the corpus."""
    return counted(docs, lambda data, offsets: words(data, offsets)[3])


def counted_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, key, c of every n-gram of the corpus."""
    return counted(docs, lambda data, offsets: ngrams(data, offsets, order)[1])


def counted(docs: DataFrame, found) -> DataFrame:
    """lang, key, c of the keys that ``found`` gives for texts: tasks merge what they read, then Spark adds up."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("c", pa.int64())])
    most = 1 << 21

    def merged(parts: list[tuple]) -> tuple:
        keys = np.concatenate([k for k, _ in parts])
        order_ = np.argsort(keys, kind="stable")
        keys, n = keys[order_], np.concatenate([n for _, n in parts])[order_]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(n, first) if len(first) else n

    def size(parts: list[tuple]) -> int:
        return sum(len(k) for k, _ in parts)

    def emitted(lang: str, held: tuple) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(held[0]), 1 << 16):
            keys = held[0][i : i + (1 << 16)].astype(np.int64)
            yield table(schema, lang=[lang] * len(keys), key=keys, c=held[1][i : i + (1 << 16)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        for batch in batches:
            for b in sub_batches(batch):
                langs = np.array(b.column(2).to_pylist())
                for lang in np.unique(langs).tolist():
                    own = b.filter(pa.array(langs == lang))
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(found(*flat_bytes(own.column(1))), return_counts=True))
                    if size(parts[1:]) > len(parts[0][0]):  # so an entry is not moved for every batch
                        held[lang] = [merged(parts)]
                    while sum(map(size, held.values())) > most:  # bounded memory; sums go on after the shuffle
                        large = max(held, key=lambda x: size(held[x]))
                        if len(held[large]) > 1:
                            held[large] = [merged(held[large])]
                        else:
                            yield from emitted(large, held.pop(large)[0])
        for lang, parts in held.items():
            yield from emitted(lang, merged(parts))

    return in_larger_tasks(_rows(docs)).mapInArrow(run, "lang string, key long, c long").groupBy("lang", "key").agg(F.sum("c").alias("c"))


def _with_discount(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """rows (lang, c) with d1, d2, d3 of their language's counts and ``off``, what is taken off each count."""
    n = [F.count_if(F.col("c") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / F.greatest(F.lit(1.0), F.col("n1") + 2 * F.col("n2"))
    # a corpus too small for an estimate gets the usual start values
    d = [F.least(F.lit(float(i)), F.greatest(F.lit(0.1), F.when(F.col(f"n{i}") > 0, i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")).otherwise(0.5 * i))).alias(f"d{i}") for i in (1, 2, 3)]
    rows = rows.join(F.broadcast(counts.groupBy("lang").agg(*n).select("lang", *d)), "lang")  # a row for each language
    off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    return rows.withColumn("off", F.least(off, F.col("c").cast("double")))


def word_layer(counts: DataFrame) -> dict[str, tuple[float, ...]]:
    """By language: words in all, the discounts of counts 1, 2 and more, and the share that they take off."""
    t = _with_discount(counts, counts).groupBy("lang").agg(F.sum("c").alias("total"), F.first("d1").alias("d1"), F.first("d2").alias("d2"), F.first("d3").alias("d3"), F.sum("off").alias("mass"))
    return {r["lang"]: (r["total"], r["d1"], r["d2"], r["d3"], r["mass"] / r["total"]) for r in t.collect()}  # a row for each language


def model(counts: DataFrame, order: int = ORDER) -> dict[int, tuple[DataFrame, DataFrame]]:
    """By order: (lang, key, p) interpolated probabilities, with the counts c at the highest order, and (lang, key, g) backoff weights of contexts.

    The highest order has counts, each lower one the number of distinct symbols before an n-gram.
    """
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = stored(tables[k + 1].groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("key")).agg(F.count("*").alias("c")))
    out: dict[int, tuple[DataFrame, DataFrame]] = {}
    lower = None
    for k in range(1, order + 1):
        t = tables[k].withColumn("context", F.shiftright("key", 8))
        t = _with_discount(t, tables[k])
        contexts = t.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("off").alias("mass"))
        weights = contexts.select("lang", F.col("context").alias("key"), (F.col("mass") / F.col("total")).alias("g"))
        own = t.join(contexts, ["lang", "context"])
        kept = ["lang", "key", *(["c"] if k == order else [])]
        p = (F.col("c") - F.col("off")) / F.col("total")
        g = F.col("mass") / F.col("total")
        if lower is None:
            probs = own.select(*kept, (p + g / 256).alias("p"))
        else:
            short = lower.select("lang", F.col("key").alias("short"), F.col("p").alias("q"))
            probs = own.withColumn("short", F.col("key").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(short, ["lang", "short"]).select(*kept, (p + g * F.col("q")).alias("p"))
        lower = probs = stored(probs)
        out[k] = probs, weights
    return out


def hashed(keys: np.ndarray) -> np.ndarray:
    """Spread 64-bit values of keys: the highest bits name the shard, the lowest ones the slot in it."""
    return mix(keys.astype(np.uint64) + np.uint64(1))


#: The highest bit, turned: signed numbers in the order of unsigned ones.
_TURNED = np.uint64(1 << 63)


def write_model(parts: dict[int, tuple[DataFrame, DataFrame]], folder: str, words: DataFrame | None = None, least: int = 1) -> None:
    """Shards: folder/bits=<b>/language=<hash>/kind=<p or g and order, or w of words>/shard=<highest b bits of the key's hash>/part with key (the key's hash, its
    highest bit turned, in order), value (natural logarithms of p and g, counts of words) and count (of the highest order). b follows from the number of entries, so
    that a shard has about SHARD of them at most. Words and n-grams of the highest order with a count below least are left out."""
    top = parts[max(parts)][0].where(F.col("c") >= least)
    words = words if words is None else words.where(F.col("c") >= least)
    sizes = [t.groupBy("lang").agg(F.count("*").alias("n")) for t in (top, words) if t is not None]
    most = max(x.agg(F.max("n")).first()[0] or 0 for x in sizes)
    bits = max(0, -(-most // SHARD) - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = hashed(np.asarray(b.column(2)))
            s = (h >> np.uint64(64 - bits) if bits else h * np.uint64(0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array((h ^ _TURNED).view(np.int64)), *b.columns[3:], pa.array(s)], names=["language", "kind", "key", "value", "count", "shard"])

    rows = None
    for k, (probs, weights) in parts.items():
        for kind, t in ((f"p{k}", (top if k == max(parts) else probs).withColumnRenamed("p", "x")), (f"g{k}", weights.withColumnRenamed("g", "x"))):
            own = t.select(F.sha2("lang", 256).alias("language"), F.lit(kind).alias("kind"), "key", F.log("x").cast("float").alias("value"), (F.col("c") if kind == f"p{max(parts)}" else F.lit(None)).cast("float").alias("count"))
            rows = own if rows is None else rows.unionByName(own)
    if words is not None:
        rows = rows.unionByName(words.select(F.sha2("lang", 256).alias("language"), F.lit("w").alias("kind"), "key", F.col("c").cast("float").alias("value"), F.lit(None).cast("float").alias("count")))
    sharded = rows.mapInArrow(run, "language string, kind string, key long, value float, count float, shard long")
    sharded.repartition("language", "kind", "shard").sortWithinPartitions("language", "kind", "shard", "key").write.partitionBy("language", "kind", "shard").parquet(f"{folder}/bits={bits}")


class Shard:
    """The entries of a file, in the order of their hashes."""

    def __init__(self, where, at: str, counted: bool):
        found = where.get_file_info(at)
        self.h, self.values = np.zeros(0, np.uint64), np.zeros((0, 1 + counted), np.float32)
        if found.type != fs.FileType.NotFound:
            columns = ["value", "count"] if counted else ["value"]
            t = pads.dataset(at, filesystem=where, format="parquet").to_table(columns=["key", *columns])
            self.h, self.values = t["key"].to_numpy().view(np.uint64) ^ _TURNED, np.stack([t[c].to_numpy() for c in columns], axis=1)
            if (self.h[1:] < self.h[:-1]).any():  # several files
                order = np.argsort(self.h)
                self.h, self.values = self.h[order], self.values[order]
        self.size = self.h.nbytes + self.values.nbytes

    def find(self, h: np.ndarray) -> np.ndarray:
        """The values of each hash, nan for those that are not there."""
        out = np.full((len(h), self.values.shape[1]), np.nan, np.float32)
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
            hit = self.h[at] == h
            out[hit] = self.values[at[hit]]
        return out


_LOADED: OrderedDict = OrderedDict()


def shard(folder: str, where, at: str, counted: bool) -> Shard:
    """From the worker's shards, which have HELD bytes at most besides the one in use."""
    if (folder, at) in _LOADED:
        _LOADED.move_to_end((folder, at))
    else:
        if _LOADED and next(iter(_LOADED))[0] != folder:  # another model: a worker serves many jobs
            _LOADED.clear()
        while _LOADED and sum(x.size for x in _LOADED.values()) > HELD:
            _LOADED.popitem(last=False)
        _LOADED[folder, at] = Shard(where, at, counted)
    return _LOADED[folder, at]


class Arrays:
    """A language's n-grams, shard by shard."""

    def __init__(self, folder: str, language: str):
        self.folder = folder
        self.where, path = _split(folder)
        (top,) = [x.path for x in self.where.get_file_info(fs.FileSelector(path)) if "/bits=" in x.path]
        self.bits = int(top.rpartition("=")[2])
        self.path = f"{top}/language={language}"

    def find(self, kind: str, keys: np.ndarray) -> np.ndarray:
        """The value of each key, of n-grams of the highest order with its count. Each shard is asked once."""
        counted, h = kind == f"p{ORDER}", hashed(keys)
        order = np.argsort(h)
        h = h[order]
        out = np.full((len(keys), 1 + counted), np.nan)
        number = h >> np.uint64(64 - self.bits) if self.bits else h * np.uint64(0)
        starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))[: len(h)]
        for a, z in zip(starts, [*starts[1:], len(h)], strict=True) if len(h) else ():
            out[order[a:z]] = shard(self.folder, self.where, f"{self.path}/kind={kind}/shard={number[a]}", counted).find(h[a:z])
        return out if counted else out[:, 0]

    def known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each n-gram: log probability of its last symbol after the others, its count (both nan for unseen ones), and what backing off gives."""
        found = self.find(f"p{ORDER}", keys)
        left, less = np.arange(len(keys)), np.zeros(len(keys))
        extra, k = np.zeros(len(left)), ORDER
        while len(left):
            g = self.find(f"g{k}", (keys[left] & np.uint64((1 << 8 * k) - 1)) >> np.uint64(8))
            extra += np.where(np.isnan(g), 0, g)  # an unseen context backs off freely
            k -= 1
            if k == 0:
                less[left] = extra - np.log(256)
                break
            p = self.find(f"p{k}", keys[left] & np.uint64((1 << 8 * k) - 1))
            seen = ~np.isnan(p)
            less[left[seen]] = extra[seen] + p[seen]
            left, extra = left[~seen], extra[~seen]
        return found[:, 0], found[:, 1], less

    def log_p(self, keys: np.ndarray, doc: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each n-gram's last symbol after the others; unseen n-grams back off. doc: the text of each; those that no other
        text has count as unseen."""
        each, of = np.unique(keys, return_inverse=True)  # texts repeat their n-grams: a look-up for each different one
        return _of_others(keys, doc, *[x[of] for x in self.known(each)])


def _of_others(keys: np.ndarray, doc: np.ndarray | None, p: np.ndarray, count: np.ndarray, less: np.ndarray) -> np.ndarray:
    """p of the n-grams that other texts have, less of all others."""
    unseen = np.isnan(p)
    if doc is not None:
        size = np.bincount(doc)
        few = np.flatnonzero(count <= size[doc])  # a text has no n-gram more often than it has n-grams
        unseen[few[count[few] <= _own_counts(doc[few], keys[few])]] = True
    return np.where(unseen, less, p)


class Places:
    """Different keys in the order of their hashes, and where each is."""

    def __init__(self, keys: np.ndarray):
        h = hashed(keys)
        order = np.argsort(h)
        self.keys = keys[order]
        bits = max(1, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.concatenate([[0], np.cumsum(np.bincount((h[order] >> self.shift).astype(np.int64), minlength=1 << bits))[:-1]]).astype(np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, all of which are there."""
        at = self.first[(hashed(keys) >> self.shift).astype(np.int64)]
        left = np.flatnonzero(self.keys[at] != keys)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] != keys[left]]
        return at


class Lot:
    """What the model has of the n-grams and words of a lot of texts."""

    def __init__(self, found: Arrays, ngrams: np.ndarray, words: np.ndarray):
        self.ngrams, self.words = Places(ngrams), Places(words)
        self.known, self.counts = found.known(self.ngrams.keys), found.find("w", self.words.keys)

    def find(self, kind: str, keys: np.ndarray) -> np.ndarray:
        """The count of each word."""
        return self.counts[self.words.of(keys)]

    def log_p(self, keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
        at = self.ngrams.of(keys)
        return _of_others(keys, doc, *[x[at] for x in self.known])


def arrays(folder: str, language: str) -> Arrays:
    return Arrays(folder, language)


# --- scores and verdicts ------------------------------------------------------------------------------------------

SCORES = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *((x, pa.int64()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_scored")), ("log_ppl", pa.float64())])
SCORES_DDL = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_scored long, log_ppl double"


def _own_counts(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often the key of each element occurs in its text."""
    both = mix(keys ^ doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(both[order]) != 0)) if len(both) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(both)))
    out = np.empty(len(both), np.int64)
    out[order] = np.repeat(size, size)
    return out


def log_perplexity(data: np.ndarray, offsets: np.ndarray, found: Arrays | Lot, layer: tuple[float, ...], sums: np.ndarray | None = None, known: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(words that are scored, minus their mean log probability) of each text, its own counts taken out. known: the texts' ``words``."""
    n = len(offsets) - 1
    first, last, doc, h = known or words(data, offsets, sums)
    scored = np.bincount(doc, minlength=n)
    if not len(first):
        return scored, np.zeros(n)
    at, keys = ngrams(data, offsets)
    spelled = np.zeros(len(data) + 1)
    if len(keys):
        of = np.searchsorted(offsets, at, side="right") - 1
        spelled[at + ORDER - 1] = found.log_p(keys, of)
    # a word's spelling is its bytes and the blank that ends it
    ends = np.minimum(last + 1, offsets[doc + 1])
    so_far = np.concatenate([[0], np.cumsum(spelled)])
    spelling = so_far[ends] - so_far[first]
    total, d1, d2, d3, mass = layer
    others = np.maximum(0, np.nan_to_num(found.find("w", h)) - _own_counts(doc, h))
    share = np.maximum(0, others - np.select([others == 1, others == 2], [d1, d2], d3)) / np.maximum(1, total - scored[doc])
    with np.errstate(divide="ignore"):
        p = np.logaddexp(np.log(share), np.log(mass) + spelling)
    return scored, np.bincount(doc, weights=-p, minlength=n) / np.maximum(1, scored)


def _scored(texts: list[pa.RecordBatch], lang: str, folder: str, layer: tuple[float, ...] | None) -> Iterator[pa.RecordBatch]:
    """The rows of a lot of texts of a language."""
    parts, grams, each = [], [], []
    for lot in pa.Table.from_batches(texts).combine_chunks().to_batches():
        for b in sub_batches(lot):
            data, offsets = flat_bytes(b.column(1))
            sums = running_sums(data)
            own = words(data, offsets, sums)
            parts.append((b, base_counts(data, offsets, sums), own))
            grams.append(np.unique(ngrams(data, offsets)[1]))
            each.append(np.unique(own[3]))
    if layer:  # else there is no word in the language
        found = Lot(arrays(folder, hashlib.sha256(lang.encode()).hexdigest()), np.unique(np.concatenate(grams)), np.unique(np.concatenate(each)))
    while parts:
        b, base, own = parts.pop()
        n_scored, value = log_perplexity(*flat_bytes(b.column(1)), found, layer, known=own) if layer else (np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows))
        yield table(SCORES, doc_id=b.column(0), lang=[lang] * b.num_rows, n_scored=n_scored, log_ppl=pa.array(value, mask=n_scored == 0), **base)
    release()


def scores(docs: DataFrame, folder: str, layers: dict[str, tuple[float, ...]]) -> DataFrame:
    """Base counts, number of scored words and log perplexity of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for b in sub_batches(batch):
                langs = np.array(b.column(2).to_pylist())
                for lang in np.unique(langs).tolist():
                    own = b.filter(pa.array(langs == lang))
                    held.setdefault(lang, []).append(own)
                    size[lang] = size.get(lang, 0) + own.nbytes
                    while size and (max(size.values()) > LOT or sum(size.values()) > WAITING):
                        large = max(size, key=size.get)
                        del size[large]
                        yield from _scored(held.pop(large), large, folder, layers.get(large))
        for lang in list(held):
            yield from _scored(held.pop(lang), lang, folder, layers.get(lang))

    return _rows(docs).mapInArrow(run, SCORES_DDL)


def judge(docs: DataFrame, below: float = BELOW, above: float = ABOVE, folder: str | None = None) -> DataFrame:
    """doc_id, base counts, base_failed, kept, perplexity and the band's ends of every row."""
    folder = folder or new_folder(docs.sparkSession, "ngrams")
    grams, each = stored(counted_ngrams(docs)), stored(counted_words(docs))
    write_model(model(grams), folder, each, least=2)  # what is there once is in the text that is judged, and not in others
    found = cut(scores(docs, folder, word_layer(each)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return banded(found.withColumn("base_failed", failed), below, above)


def banded(found: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """Verdicts of scored rows; each end of a language's band follows from the texts on its side of the median."""
    usual = found.where("not base_failed and log_ppl is not null").select("lang", "log_ppl", "n_scored").distinct()
    middle = usual.groupBy("lang").agg(F.percentile_approx("log_ppl", 0.5, 10000).alias("middle"))  # a row for each language
    away = usual.join(F.broadcast(middle), "lang").withColumn("away", (F.col("log_ppl") - F.col("middle")) / _widening())
    side = lambda on, sign: F.greatest(F.lit(LEAST_SPREAD), F.coalesce(1.4826 * F.percentile_approx(F.when(on, sign * F.col("away")), 0.5, 10000), F.lit(LEAST_SPREAD)))
    spread = away.groupBy("lang").agg(F.first("middle").alias("middle"), side(F.col("away") <= 0, -1).alias("under"), side(F.col("away") >= 0, 1).alias("over"))
    out = found.join(F.broadcast(spread), "lang", "left").withColumn("lower", F.exp(F.col("middle") - below * F.col("under") * _widening())).withColumn("upper", F.exp(F.col("middle") + above * F.col("over") * _widening()))
    out = out.withColumn("perplexity", F.exp("log_ppl"))
    inside = F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")), F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"), "perplexity", "lower", "upper")


def _widening():
    return F.sqrt(1 + SHORT / F.greatest(F.lit(1.0), F.col("n_scored").cast("double")))
