"""Types of contract interfaces, nested at will, and their values as column expressions over encoded bytes.

An encoding is made of 32-byte words. A value of fixed size stands in its place; any other leaves there the distance to its
tail, from the start of what it is a part of. Arrays say how many elements they have, and elements are laid out like the parts
of a tuple. All bounds are checked against the bytes that are there: what does not fit is null, the rest is decoded. Elements of
variable size must stand in order and apart, as encoders write them, so that a value never has more words than the data.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALAR = re.compile(r"address|bool|string|function|bytes([1-9]|[12]\d|3[012])?|u?int(\d+)?")


@dataclass(frozen=True)
class Kind:
    """A type: a scalar by its name, a tuple of named parts, or an array of ``item`` (``length`` None: of any length)."""

    name: str = ""
    parts: tuple[tuple[str, Kind], ...] = ()
    item: Kind | None = None
    length: int | None = None

    @property
    def canonical(self) -> str:
        if self.item:
            return f"{self.item.canonical}[{'' if self.length is None else self.length}]"
        return f"({','.join(k.canonical for _, k in self.parts)})" if self.parts else self.name

    @property
    def varies(self) -> bool:
        """Whether values differ in size."""
        if self.item:
            return self.length is None or self.item.varies
        return any(k.varies for _, k in self.parts) if self.parts else self.name in ("string", "bytes")

    @property
    def head(self) -> int:
        """Bytes that a value takes in its place."""
        if self.varies:
            return 32
        return self.item.head * self.length if self.item else sum(k.head for _, k in self.parts) if self.parts else 32

    @property
    def wide(self) -> bool:
        """Whether numbers of it may need more digits than a decimal has."""
        bits = re.fullmatch(r"u?int(\d+)", self.name)
        return self.item.wide if self.item else bool(bits) and int(bits[1]) > 126


def scalar(name: str) -> Kind:
    m = _SCALAR.fullmatch(name)
    if not m:
        raise ValueError(f"type {name} is not supported")
    if "int" in name:
        bits = int(m[2] or 256)
        if bits % 8 or not 8 <= bits <= 256:
            raise ValueError(f"type {name} is not supported")
        name = name.rstrip("0123456789") + str(bits)
    return Kind(name)


def split_list(text: str) -> list[str]:
    """Parts between the commas that stand in no brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c in "([") - (c in ")]")
        if depth < 0:
            raise ValueError(f"brackets do not match: {text}")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    if depth:
        raise ValueError(f"brackets do not match: {text}")
    return [*out, text[start:]] if text.strip() else []


def parse_parameter(text: str) -> tuple[Kind, list[str]]:
    """A type and the words that follow it."""
    text = text.strip()
    if m := re.match(r"(?:tuple)?\s*\(", text):
        depth, z = 1, m.end()
        while depth:
            if z == len(text):
                raise ValueError(f"brackets do not match: {text}")
            depth += (text[z] == "(") - (text[z] == ")")
            z += 1
        parts = [parse_parameter(x) for x in split_list(text[m.end() : z - 1])]
        if not parts:
            raise ValueError(f"a tuple without parts: {text}")
        kind, text = Kind(parts=tuple((words[-1] if words else f"arg{i}", k) for i, (k, words) in enumerate(parts))), text[z:]
    else:
        name = re.match(r"\w*", text)[0]
        kind, text = scalar(name), text[len(name) :]
    m = re.match(r"(\s*\[\s*\d*\s*\])*", text)
    for size in re.findall(r"\[\s*(\d*)\s*\]", m[0]):
        if size and not int(size):
            raise ValueError("an array of no elements has no encoding")
        kind = Kind(item=kind, length=int(size) if size else None)
    return kind, text[m.end() :].split()


def word_at(data: Column, at: Column | int, end: Column) -> Column:
    """The word at a byte position, null if it does not end by ``end``."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.when((at >= 0) & (at + 32 <= end), F.substring(data, (at + 1).cast("int"), F.lit(32)))


def small(word: Column) -> Column:
    """A word as a long, null from 2^31 on: an offset or a length that data could have."""
    low = F.conv(F.hex(F.substring(word, 29, 4)), 16, 10).cast("long")
    return F.when((F.substring(word, 1, 28) == F.lit(bytearray(28))) & (low < 1 << 31), low)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), the value being computed once."""
    return F.transform(F.array(value), body)[0]


Leaf = Callable[[str, Column], Column]


def _tail_bytes(data: Column, at: Column, end: Column) -> Column:
    def held(size: Column) -> Column:
        return F.when(at + 32 + size <= end, F.substring(data, (at + 33).cast("int"), size.cast("int")))

    return let(small(word_at(data, at, end)), held)


def decoded(kind: Kind, data: Column, at: Column | int, base: Column | int, end: Column, leaf: Leaf, texts: bool) -> Column:
    """The value whose place is at byte ``at`` of data, in something that starts at ``base`` and ends at ``end``.

    leaf makes the column of a scalar word by its type's name. texts: wide numbers inside a tuple get a second field ``<name>_text``,
    as ``fields`` gives it.
    """
    at, base = (F.lit(x).cast("long") if isinstance(x, int) else x for x in (at, base))
    if kind.varies:
        return let(small(word_at(data, at, end)), lambda distance: let(base + distance, lambda p: _tail(kind, data, p, end, leaf, texts)))
    if kind.item:
        return _elements(kind.item, data, at, F.lit(kind.length).cast("long"), end, leaf, texts)
    if kind.parts:
        return F.struct(*fields(kind.parts, data, at, end, leaf, texts))
    return leaf(kind.name, word_at(data, at, end))


def _tail(kind: Kind, data: Column, p: Column, end: Column, leaf: Leaf, texts: bool) -> Column:
    """A value of variable size that starts at ``p``; null if that is not in the data."""
    if kind.item and kind.length is None:
        value = let(small(word_at(data, p, end)), lambda n: _elements(kind.item, data, p + 32, n, end, leaf, texts))
    elif kind.item:
        value = _elements(kind.item, data, p, F.lit(kind.length).cast("long"), end, leaf, texts)
    elif kind.parts:
        value = F.struct(*fields(kind.parts, data, p, end, leaf, texts))
    else:
        value = _tail_bytes(data, p, end)
        value = F.when(F.is_valid_utf8(value.cast("string")), value.cast("string")) if kind.name == "string" else value
    return F.when(p.isNotNull() & (p <= end), value)


def _elements(item: Kind, data: Column, start: Column, n: Column, end: Column, leaf: Leaf, texts: bool) -> Column:
    """An array of n elements whose places begin at ``start``; null if they do not all fit."""
    fits = lambda x: F.when(start + n * item.head <= end, x)
    if item.name and not item.varies:  # a word each, by its first byte from 1, and made once for all that its value refers to it
        first = (start + 1).cast("int")
        at = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(first, first + ((n - 1) * 32).cast("int"), F.lit(32)))
        return F.transform(F.transform(fits(at), lambda x: F.substring(data, x, F.lit(32))), lambda word: leaf(item.name, word))
    places = fits(F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("long"), n - 1)))
    if not item.varies:
        return F.transform(places, lambda i: decoded(item, data, start + i * item.head, start, end, leaf, texts))
    # where each tail starts; the next one's start, or the end, is where it must end
    starts = F.transform(places, lambda i: start + small(word_at(data, start + i * 32, end)))

    def apart(p: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            following = F.when(i + 1 < F.size(p), F.get(p, i + 1)).otherwise(end)
            stop = F.coalesce(following, end)
            return F.when((x <= stop) & (x >= start + n * 32) & ((i == 0) | (F.coalesce(F.get(p, i - 1), x) <= x)), _tail(item, data, x, stop, leaf, texts))

        return F.transform(p, one)

    return let(starts, apart)


def fields(parts: tuple[tuple[str, Kind], ...], data: Column, start: Column | int, end: Column, leaf: Leaf, texts: bool) -> list[Column]:
    """Columns of the parts of a tuple that starts at ``start``."""
    start, out, at = F.lit(start).cast("long") if isinstance(start, int) else start, [], 0
    for name, kind in parts:
        out.append(decoded(kind, data, start + at, start, end, leaf, texts).alias(name))
        if texts and kind.wide:
            digits = lambda k, w: leaf(f"{k} text", w)
            out.append(decoded(kind, data, start + at, start, end, digits, texts).alias(f"{name}_text"))
        at += kind.head
    return out
