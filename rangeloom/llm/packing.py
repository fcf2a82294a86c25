"""Best-fit packing of token sequences by bin completion with branch and bound.

Every document becomes pieces of at most ``capacity`` tokens. Pieces of equal length are interchangeable, so the search
works on the histogram of lengths (at most ``capacity`` counts, however many documents there are) and its answer is a
list of patterns with a number of uses. Around the largest remaining length the undominated fillings are enumerated from
long to short lengths; a branch whose reachable sums leave more waste than the incumbent filling is cut, and a filling whose
lengths fit into those of another one goes. A branch is a filling and how often it is used: as often as the lengths last, or less. The
outer search keeps the best-fit-decreasing packing as its first incumbent and cuts states whose waste so far already forces as
many bins as the incumbent has. It ends when the incumbent meets the lower bound, when all is searched, or after NODES states: bin
packing has no fast exact way, so what is left open is told by ``gap``, not hidden.

Pieces then take their places by their rank within their length. Ranks come from counts by (length, salt), so a length
that holds a third of all pieces is still many groups.

Defined cases: null text is the empty text, one end id; repeated rows and ids, and null ids, are packed each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeloom.llm.common import cut, flat_bytes, shuffle_partitions, sub_batches, table, texts
from rangeloom.llm.tokens import encode_column, encoder_path, hub_encoder

CAPACITY = 1024
END_ID = 2
#: States of the outer search, fillings of a state, and steps of their enumeration.
NODES, FILLINGS, STEPS = 6000, 6, 800

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; a first piece may be shorter than those after it."""
    path = tokenizer or encoder_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = hub_encoder(path)
        for batch in batches:
            for b in sub_batches(batch):
                ids, offsets = encode_column(encoder, *flat_bytes(b.column(1)))
                ids = ids.astype("<u4")
                rows = []
                for doc, a, z in zip(b.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own = np.append(ids[a:z], np.uint32(end_id)).astype("<u4")
                    n, at, k = len(own), 0, 0
                    while at < n:
                        size = (n % capacity or capacity) if not at else capacity
                        rows.append((doc, k, at, size, zlib.crc32(own[at : at + size])))
                        at, k = at + size, k + 1
                yield table(PIECES, **dict(zip(PIECES.names, zip(*rows, strict=True), strict=True)))

    return texts(docs).mapInArrow(run, PIECES_DDL)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by volume, by lengths that cannot share a bin (Martello and Toth's L2), and by how many
    lengths over a (k + 1)-th of a bin one can hold (the dual feasible functions of Fekete and Schepers)."""
    lengths = sorted(counts)
    best = -(-sum(x * n for x, n in counts.items()) // capacity)
    for k in [0, *(x for x in lengths if 2 * x <= capacity)]:
        large = sum(n for x, n in counts.items() if x > capacity - k)
        middle = [(x, n) for x, n in counts.items() if capacity - k >= x > capacity / 2]
        room = sum((capacity - x) * n for x, n in middle)
        small = sum(x * n for x, n in counts.items() if k <= x <= capacity / 2)
        best = max(best, large + sum(n for _, n in middle) + max(0, -(-(small - room) // capacity)))
    for k in range(1, 101):
        parts = sum(n * (k * x if (k + 1) * x % capacity == 0 else (k + 1) * x // capacity * capacity) for x, n in counts.items())
        best = max(best, -(-parts // (k * capacity)))
    return best


Pattern = tuple[tuple[int, int], ...]  # (length, how many in a bin), longest first


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on the histogram, with bins kept by their free room."""
    room: dict[int, Counter] = {}
    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            fit = min((r for r in room if r >= x), default=None)
            if fit is None:
                fit, each = capacity, min(left, capacity // x)
                bins = Counter({(): left // each})
                if left % each:
                    bins, left_over = (bins, left % each) if left >= each else (Counter(), left)
                    room.setdefault(capacity - left_over * x, Counter())[((x, left_over),)] += 1
                if bins[()]:
                    room.setdefault(capacity - each * x, Counter())[((x, each),)] += bins[()]
                break
            pattern, n = next(iter(room[fit].items()))
            each = min(fit // x, left)
            use = min(n, left // each)
            room[fit][pattern] -= use
            if not room[fit][pattern]:
                del room[fit][pattern]
                if not room[fit]:
                    del room[fit]
            room.setdefault(fit - each * x, Counter())[(*pattern, (x, each))] += use
            left -= each * use
    return [(p, n) for bins in room.values() for p, n in bins.items()]


def fits_into(small: Pattern, large: Pattern) -> bool:
    """Whether the lengths of small can be put into those of large, each of which is a bin (by best fit). A bin that
    holds large instead is then never worse, as small can go where large came from."""
    room = sorted(x for x, k in large for _ in range(k))
    for x, k in small:
        for _ in range(k):
            i = bisect.bisect_left(room, x)
            if i == len(room):
                return False
            if left := room.pop(i) - x:
                bisect.insort(room, left)
    return True


def undominated(found: list[tuple[int, Pattern]]) -> list[tuple[int, Pattern]]:
    """Those of the fillings, least waste first, that fit into no other one that is kept."""
    out: list[tuple[int, Pattern]] = []
    for waste, filling in found:
        if not any(fits_into(filling, x) for _, x in out):
            out.append((waste, filling))
    return out


def fillings(counts: dict[int, int], slack: int, most: int = FILLINGS) -> list[tuple[int, Pattern]]:
    """(waste, filling) of the least wasteful undominated fillings of ``slack``; those with longer lengths first.

    reach[i] marks the sums that lengths from the i-th on can make; a branch is cut if no sum in reach brings its waste
    below that of the worst filling kept.
    """
    lengths = sorted((x for x, n in counts.items() if n and x <= slack), reverse=True)
    keep = (1 << (slack + 1)) - 1
    reach = [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        x, bits, k = lengths[i], reach[i + 1], 1
        left = min(counts[x], slack // x)
        while left:
            k = min(k, left)
            bits |= bits << (k * x)
            left, k = left - k, 2 * k
        reach[i] = bits & keep
    found: list[tuple[int, Pattern]] = []

    def least_waste(i: int, room: int) -> int:
        return room - (reach[i] & ((1 << (room + 1)) - 1)).bit_length() + 1

    def search(i: int, room: int, chosen: Pattern) -> None:
        nonlocal steps
        steps += 1
        if len(found) == most and found[-1][0] <= least_waste(i, room) or steps > STEPS:
            return
        while i < len(lengths) and lengths[i] > room:
            i += 1
        if i == len(lengths) or not room:
            found.append((room, chosen))
            found.sort(key=lambda f: f[0])
            del found[most:]
            return
        x = lengths[i]
        options = range(min(counts[x], room // x), -1, -1)
        for k in sorted(options, key=lambda k: least_waste(i + 1, room - k * x)):
            search(i + 1, room - k * x, (*chosen, (x, k)) if k else chosen)

    steps = 0
    # skipping a length recurses once a length, so the walk jumps to lengths that lie on a least-waste path
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 4 * len(lengths) + 1000))
    try:
        search(0, slack, ())
    finally:
        sys.setrecursionlimit(limit)
    if not found:
        room, chosen = slack, []
        for x in lengths:
            if k := min(counts[x], room // x):
                chosen.append((x, k))
                room -= k * x
        found.append((room, tuple(chosen)))
    return undominated(found)


def gap(plan: list[tuple[Pattern, int]], counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Bins of a plan beyond the lower bound: 0 proves that no packing has fewer."""
    return sum(n for _, n in plan) - lower_bound(counts, capacity)


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Patterns and their uses that pack the histogram; as few bins as the search of ``nodes`` states finds."""
    counts = {x: n for x, n in counts.items() if n}
    best = best_fit(counts, capacity)
    bins = sum(n for _, n in best)
    least = lower_bound(counts, capacity)
    volume = sum(x * n for x, n in counts.items())
    left, waste, used = Counter(counts), 0, 0
    trail: list[tuple[Pattern, int, int, list]] = []  # pattern, uses, waste a bin, fillings not yet tried
    options: list | None = None
    while bins > least and nodes > 0:
        largest = max((x for x, n in left.items() if n), default=0)
        if not largest:
            if used < bins:
                best, bins = [(p, n) for p, n, _, _ in trail], used
            options = []
        elif -(-(volume + waste) // capacity) >= bins:
            options = []
        elif options is None:
            nodes -= 1
            left[largest] -= 1
            found = fillings(left, capacity - largest)
            left[largest] += 1
            options = []
            for w, filling in found:
                pattern = Counter(dict(filling))
                pattern[largest] += 1
                options.append((w, pattern, min(left[x] // k for x, k in pattern.items())))
            # after each filling at its most, the same ones used less: the lengths they save may fit better elsewhere
            options += [(w, pattern, n) for w, pattern, uses in options for n in {uses // 2, 1} if 0 < n < uses]
        if options:
            w, pattern, uses = options[0]
            for x, k in pattern.items():
                left[x] -= k * uses
            trail.append((tuple(sorted(pattern.items(), reverse=True)), uses, w, options[1:]))
            waste, used, options = waste + w * uses, used + uses, None
        elif trail:
            pattern, uses, w, options = trail.pop()
            for x, k in pattern:
                left[x] += k * uses
            waste, used = waste - w * uses, used - uses
        else:
            break
    return best


def places(plan: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, how many in a bin, first offset), sorted by length and rank."""
    rows, taken, sequence = [], Counter(), 0
    for pattern, uses in plan:
        offset = 0
        for x, k in pattern:
            rows.append((x, taken[x], sequence, k, offset))
            taken[x] += k * uses
            offset += k * x
        sequence += uses
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def ranked(parts: DataFrame) -> DataFrame:
    """parts with rank, from 0 within equal length, without one task for a length."""
    salts = 4 * shuffle_partitions(parts.sparkSession)
    # with the partition, so that equal rows do not share a salt; parts are materialised, so it is the same each time
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()), F.lit(salts)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    base = parts.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", before.alias("base"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return parts.withColumn("own", own).join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("own")).drop("base", "own", "salt")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    parts = cut(pieces(docs, capacity, tokenizer, end_id))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    where = places(complete_bins(counts, capacity))
    key = where[:, 0] << 48 | where[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = np.asarray(b.column(3)), np.asarray(b.column(5)).astype(np.int64)
            row = where[np.searchsorted(key, length << 48 | rank, side="right") - 1]
            turn = rank - row[:, 1]
            sequence, offset = row[:, 2] + turn // row[:, 3], row[:, 4] + turn % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=[*PIECES.names, "sequence_id", "offset"])

    cols = [*PIECES.names, F.col("rank").cast("long").alias("rank")]
    return ranked(parts).select(*cols).mapInArrow(run, PIECES_DDL + ", sequence_id long, offset long")
