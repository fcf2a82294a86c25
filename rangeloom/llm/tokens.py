"""Encoding whole columns with a public tokenizer, one call for each distinct unit of text.

The byte-level tokenizers cut text by a pattern before they merge. Some cuts are certain from two neighbouring
characters alone: before a space or newline that follows a visible character, and between an ASCII letter and an ASCII
mark. Text between certain cuts (a unit) encodes the same alone as in place, so each distinct unit goes through the
library once and the ids of a text are gathered from those of its units. Hashes of all units of a block come from
running sums, so only units that were never seen go to the library, many in one string where the cuts between them are certain
too; a unit that is found by its hash is compared byte by byte.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain, pairwise

import numpy as np

from rangeloom.llm.common import mix

SPECIAL = b"<|endoftext|>"
BLOCK = 1_000_000
PRIME = (1 << 61) - 1
_BASE = 0x9E3779B97F4A7C15 % PRIME
#: Units in one string for the library.
JOINED = 256


def _between(data: np.ndarray, first: int, last: int) -> np.ndarray:
    """Whether each byte is first to last: bytes below first wrap to large ones."""
    return data - np.uint8(first) <= np.uint8(last - first)


def _space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | (data == 10)


def certain_cuts(data: np.ndarray) -> np.ndarray:
    """Marks the positions i > 0 at which any tokenisation of the bytes has a boundary between pre-tokens."""
    marks = np.zeros(len(data), bool)
    if len(data) < 2:
        return marks
    letter, graph = _between(data | np.uint8(32), ord("a"), ord("z")), _between(data, 33, 126)
    visible = graph.copy()
    # first bytes of characters of 2, 3 and 4 bytes none of which is white space
    visible[1:] |= _between(data[:-1], 0xC3, 0xDF)
    visible[2:] |= _between(data[:-2], 0xE4, 0xEF) | (data[:-2] == 0xE0)
    visible[3:] |= data[:-3] >= 0xF0
    marks[1:] = _space(data[1:]) & visible[:-1] | letter[:-1] & (graph & ~letter)[1:]
    return marks


class Powers:
    """Powers of a base, in halves of 32 bits, and of its inverse modulo the prime 2^61 - 1, as far as asked."""

    def __init__(self) -> None:
        self.low, self.high, self.down = np.ones(1, np.uint32), np.zeros(1, np.uint32), np.ones(1, np.uint64)

    def upto(self, n: int) -> "Powers":
        while len(self.down) < n:
            m = len(self.down)
            more = min(m, n + (1 << 16) - m)
            up = times(self.low[:more] | self.high[:more].astype(np.uint64) << np.uint64(32), np.uint64(pow(_BASE, m, PRIME)))
            self.low = np.concatenate([self.low, (up & np.uint64(0xFFFFFFFF)).astype(np.uint32)])
            self.high = np.concatenate([self.high, (up >> np.uint64(32)).astype(np.uint32)])
            self.down = np.concatenate([self.down, times(self.down[:more], np.uint64(pow(pow(_BASE, -1, PRIME), m, PRIME)))])
        return self


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    y = x & np.uint64(PRIME)
    y += x >> np.uint64(61)
    return np.minimum(y, y - np.uint64(PRIME))  # below the prime the difference wraps to a large one


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, from products of halves."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    mid = a0 * b1 + a1 * b0
    return _reduced(_reduced(a1 * b1 * np.uint64(2) + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << half)) + a0 * b0)


POWERS = Powers()
#: Bytes summed at a time: their weighted sums stay below 2^64 (up to 2^22 bytes), and numpy's scratch stays in the cache.
_STEP = 1 << 17


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes wherever they stand: the span's polynomial modulo the prime
    2^61 - 1, from two running sums (of the powers' halves), spread over 64 bits. Two different spans of n bytes share it for n
    of 2^61 bases at most; modulo a power of two there are strings that share it whatever the base."""
    return hashes_of(running_sums(data), starts, ends)


def running_sums(data: np.ndarray) -> np.ndarray:
    """The polynomials of all starts of data, for the hashes of any of its spans."""
    sums = np.zeros(len(data) + 1, np.uint64)
    for i in range(0, len(data), _STEP):
        part = data[i : i + _STEP].astype(np.uint64) + np.uint64(1)
        z = i + len(part)
        powers = POWERS.upto(z)
        high = _reduced(np.cumsum(part * powers.high[i:z]))
        # times 2^32 modulo the prime turns 61 bits by 32 places
        high = (high & np.uint64((1 << 29) - 1)) << np.uint64(32) | high >> np.uint64(29)
        sums[i + 1 : z + 1] = _reduced(_reduced(np.cumsum(part * powers.low[i:z])) + high + sums[i])
    return sums


def hashes_of(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hashes of the data that has these running sums."""
    return mix(times(_reduced(sums[ends] + np.uint64(PRIME) - sums[starts]), POWERS.upto(len(sums)).down[starts]))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position of data, which has eight bytes more than are asked for."""
    return np.ndarray(len(data) - 7, "<u8", data.data, 0, (1,))


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class UnitEncoder:
    """Encodes flat bytes of many texts; what it remembers is bounded by ``limit`` ids.

    token_bytes: the bytes of each id, by which the ids of a string are dealt to its units; without them each unit is a string.
    """

    SLOTS = 21

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 3 << 20, token_bytes: np.ndarray | None = None):
        self.encode_strings, self.limit, self.token_bytes = encode, limit, token_bytes
        self._forget()

    def _forget(self) -> None:
        self.tag = np.zeros(1 << self.SLOTS, np.uint64)
        self.place = np.zeros(1 << self.SLOTS, np.int32)
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.ids, self.used = np.zeros(1, np.int64), np.zeros(1 << 16, np.int32), 0
        self.text_first, self.text = np.zeros(1, np.int64), np.zeros(1 << 16, np.uint8)

    def _through(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the strings that stand one after the other in raw, and how many each has."""
        found = self.encode_strings([raw[a:b].decode() for a, b in pairwise([0, *ends.tolist()])])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def _encoded(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As _through, for units: those that begin with a space or newline share a string with the units before them where the
        cut is certain. No name of a special token arises at such a joint, as none has a space."""
        raw = data.tobytes()
        if self.token_bytes is not None:
            joint = certain_cuts(data)[ends[:-1]] & _space(data[ends[:-1]])
            joint[JOINED - 1 :: JOINED] = False
            ids, _ = self._through(raw, ends[np.append(~joint, True)])
            stops = np.cumsum(self.token_bytes[ids])
            last = np.searchsorted(stops, ends)
            if len(stops) and stops[-1] == ends[-1] and np.array_equal(stops[last], ends):
                return ids, np.diff(last, prepend=-1)
        return self._through(raw, ends)  # also where ids do not stand for their bytes

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        size = ends - starts
        stops = np.cumsum(size)
        raw = data[np.repeat(starts - stops + size, size) + np.arange(stops[-1])]
        ids, sizes = self._encoded(raw, stops)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        n = len(self.first) - 1
        self.first = np.concatenate([self.first, self.used + np.cumsum(sizes)])
        self.used += len(ids)
        a = self.text_first[-1]
        while a + len(raw) + 8 > len(self.text):
            self.text = np.concatenate([self.text, np.zeros(len(self.text), np.uint8)])
        self.text[a : a + len(raw)] = raw
        self.text_first = np.concatenate([self.text_first, a + stops])
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, np.arange(n, n + len(keys), dtype=np.int32))

    def _same(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each unit has the bytes of the known unit at its place; data has eight bytes to spare."""
        at = self.text_first[place]
        same = self.text_first[place + 1] - at == size
        here, there = _words(data), _words(self.text)
        left = np.flatnonzero(same & (size <= 64))
        a, b, n = starts[left], at[left], size[left]
        while len(left):
            keep = _KEEP[np.minimum(n, 8)]
            differ = (here[a] ^ there[b]) & keep != 0
            same[left[differ]] = False
            more = np.flatnonzero(~differ & (n > 8))
            left, a, b, n = left[more], a[more] + 8, b[more] + 8, n[more] - 8
        for i in np.flatnonzero(same & (size > 64)).tolist():
            same[i] = np.array_equal(data[starts[i] : starts[i] + size[i]], self.text[at[i] : at[i] + size[i]])
        return same

    def _places(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each unit by its hash alone; units whose hash is new are learned."""
        slot = (h >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        place = self.place[slot]
        miss = np.flatnonzero(self.tag[slot] != h)
        if len(miss):
            keys, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            at = np.searchsorted(self.keys, keys)
            new = (at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != keys) if len(self.keys) else np.ones(len(keys), bool)
            if new.any():
                which = miss[one[new]]
                self._learn(keys[new], data, starts[which], ends[which])
                at = np.searchsorted(self.keys, keys)
            own = self.at[at]
            s = slot[miss[one]]
            self.tag[s], self.place[s] = keys, own
            place[miss] = own[back]
        return place

    def _block(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the units, and how many each has. A unit whose hash is that of other bytes goes on to the next hash."""
        if self.used > self.limit:
            self._forget()
        h, data = span_hashes(data, starts, ends), np.append(data, np.zeros(8, np.uint8))
        place = self._places(h, data, starts, ends)
        left = np.flatnonzero(~self._same(data, starts, ends - starts, place))
        while len(left):
            h[left] = mix(h[left] + np.uint64(1))
            a, b = starts[left], ends[left]
            place[left] = self._places(h[left], data, a, b)
            left = left[~self._same(data, a, b - a, place[left])]
        size = self.first[place + 1] - self.first[place]
        out = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[place] - out + size, size) + np.arange(out[-1] if len(out) else 0)]
        return ids, size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids int32 of all texts, offsets of the texts in them)."""
        marks = certain_cuts(data)
        marks[offsets[:-1][np.diff(offsets) > 0]] = True
        cuts = np.flatnonzero(marks)
        if not len(cuts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(cuts[1:], len(data))
        parts, sizes, i = [], [], 0
        while i < len(cuts):
            j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + BLOCK)))
            a, b = cuts[i], ends[j - 1]
            ids, size = self._block(data[a:b], cuts[i:j] - a, ends[i:j] - a)
            parts.append(ids)
            sizes.append(size)
            i = j
        total = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(parts), total[np.searchsorted(cuts, offsets)]


_ENCODERS: dict = {}


def hub_encoder(path: str, special_is_text: bool = False) -> UnitEncoder:
    """An encoder by the tokenizers library for the file; one for each worker process.

    special_is_text: the names of special tokens in a text are ordinary text.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, special_is_text) not in _ENCODERS:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = special_is_text
        vocab = t.get_vocab()
        sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        sizes[list(vocab.values())] = list(map(len, vocab))  # a byte-level token has a character for each byte
        _ENCODERS[path, special_is_text] = e = UnitEncoder(lambda units: [x.ids for x in t.encode_batch_fast(units, add_special_tokens=False)], token_bytes=sizes)
        e.tokenizer = t
    return _ENCODERS[path, special_is_text]


def encode_column(encoder: UnitEncoder, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As encoder.encode; texts that hold a special token's name go through the library whole."""
    raw = data.tobytes()
    if encoder.tokenizer.encode_special_tokens or SPECIAL not in raw:
        return encoder.encode(data, offsets)
    ids = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if SPECIAL in raw[a:b]:
            ids.append(np.array(encoder.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids, dtype=np.int32))
        else:
            ids.append(encoder.encode(data[a:b], np.array([0, b - a]))[0])
    return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])])


def encoder_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
