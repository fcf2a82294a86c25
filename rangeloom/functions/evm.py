"""Event logs of contracts: topics of signatures and typed parameters, as column expressions.

A signature reads ``Name(type [indexed] name, ...)``. It is parsed and hashed once on the driver; no row passes through
Python. Indexed parameters come from topics 1 to 3 in order, the others from the data; types may be arrays and tuples of types, nested
at will. Data that is too short, and offsets or lengths beyond it, give null for what they are of.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rangeloom.functions.abi_types import Kind, decoded, let, parse_parameter, split_list

#: Round constants and rotations of the Keccak permutation follow from its rules (FIPS 202, section 3.2).
_MASK = (1 << 64) - 1


def _round_constants() -> list[int]:
    out, lfsr = [], 1
    for _ in range(24):
        c = 0
        for j in range(7):
            if lfsr & 1:
                c |= 1 << ((1 << j) - 1)
            lfsr = lfsr << 1 ^ (0x171 if lfsr & 0x80 else 0)
        out.append(c)
    return out


def _turn(x: int, n: int) -> int:
    n %= 64
    return (x << n | x >> (64 - n)) & _MASK if n else x


def keccak256(data: bytes) -> bytes:
    """Keccak-256 with the original padding."""
    rate = 136
    data = bytearray(data) + b"\x01" + bytes(-(len(data) + 1) % rate)
    data[-1] |= 0x80
    a = [[0] * 5 for _ in range(5)]
    for block in range(0, len(data), rate):
        for i in range(rate // 8):
            a[i % 5][i // 5] ^= int.from_bytes(data[block + 8 * i : block + 8 * i + 8], "little")
        for constant in _round_constants():
            parity = [a[x][0] ^ a[x][1] ^ a[x][2] ^ a[x][3] ^ a[x][4] for x in range(5)]
            for x in range(5):
                d = parity[x - 1] ^ _turn(parity[(x + 1) % 5], 1)
                for y in range(5):
                    a[x][y] ^= d
            x, y, lane = 1, 0, a[1][0]
            for t in range(24):
                x, y = y, (2 * x + 3 * y) % 5
                lane, a[x][y] = a[x][y], _turn(lane, (t + 1) * (t + 2) // 2)
            for y in range(5):
                row = [a[x][y] for x in range(5)]
                for x in range(5):
                    a[x][y] = row[x] ^ (~row[(x + 1) % 5] & row[(x + 2) % 5] & _MASK)
            a[0][0] ^= constant
    return b"".join(a[i % 5][i // 5].to_bytes(8, "little") for i in range(4))


@dataclass(frozen=True)
class Parameter:
    kind: Kind
    name: str
    indexed: bool

    @property
    def type(self) -> str:
        return self.kind.canonical


@dataclass(frozen=True)
class Event:
    name: str
    parameters: tuple[Parameter, ...]

    @property
    def canonical(self) -> str:
        return f"{self.name}({','.join(p.type for p in self.parameters)})"

    @property
    def topic(self) -> bytes:
        return keccak256(self.canonical.encode())


def parse_signature(signature: str) -> Event:
    m = re.fullmatch(r"\s*(?:event\s+)?(\w+)\s*\((.*)\)\s*(?:anonymous\s*)?;?\s*", signature, re.S)
    if not m:
        raise ValueError(f"not an event signature: {signature}")
    found = []
    for i, part in enumerate(x for x in split_list(m[2]) if x.strip()):
        kind, words = parse_parameter(part)
        rest = [w for w in words if w != "indexed"]
        if len(rest) > 1:
            raise ValueError(f"not a parameter: {part}")
        found.append(Parameter(kind, rest[0] if rest else f"arg{i}", "indexed" in words))
    if sum(p.indexed for p in found) > 3:
        raise ValueError("an event has at most three indexed parameters")
    return Event(m[1], tuple(found))


def event_topic(signature: str) -> Column:
    """The 32-byte topic of a signature as a literal, so that filters on it reach the scan."""
    return F.lit(bytearray(parse_signature(signature).topic))


def _number(part: Column) -> Column:
    """Up to eight bytes, most significant first."""
    return F.conv(F.hex(part), 16, 10).cast("decimal(20,0)")


def uint_word(word: Column) -> Column:
    """A 32-byte word as an unsigned decimal(38,0); null if it needs more than 38 digits.

    Words below 2^63, nearly all of them, are one conversion to a long; longer ones are two halves."""
    low, zeros = F.substring(word, 25, 8), lambda n: F.substring(word, 1, n) == F.lit(bytearray(n))
    short = F.substring(word, 1, 25) < F.lit(bytearray(24) + b"\x80")  # bytes compare as unsigned, from the left
    both = F.try_add(F.try_multiply(_number(F.substring(word, 17, 8)), F.lit(str(1 << 64)).cast("decimal(20,0)")), _number(low))
    return F.when(short, F.conv(F.hex(low), 16, 10).cast("long").cast("decimal(38,0)")).when(zeros(16), both.cast("decimal(38,0)"))


def int_word(word: Column) -> Column:
    """A 32-byte word in two's complement as decimal(38,0); null beyond 38 digits."""
    flipped = F.unhex(F.translate(F.hex(word), "0123456789ABCDEF", "FEDCBA9876543210"))
    negative = F.substring(F.hex(F.substring(word, 1, 1)), 1, 1) >= "8"
    # subtraction is exact; negation would round to 34 digits
    return F.when(negative, F.try_subtract(F.lit("-1").cast("decimal(38,0)"), uint_word(flipped))).otherwise(uint_word(word)).cast("decimal(38,0)")


def word_digits(word: Column, more: int = 0) -> Column:
    """A 32-byte word as the text of its unsigned decimal number plus ``more``, of any size. Each of its eight numbers of four bytes
    is multiplied by its power of 2^32 in limbs of eight digits; the sum of a limb's products stays below 2^63."""
    base, low = 10**8, F.lit(0xFFFFFFFF)
    quads = F.array(*[F.conv(F.hex(F.substring(word, 1 + 8 * i, 8)), 16, -10).cast("long") for i in reversed(range(4))])  # two's complement
    halves = lambda q: F.array(*[half for i in range(4) for half in (q[i].bitwiseAND(low), F.shiftrightunsigned(q[i], 32))])

    def limbs(parts: Column) -> Column:
        found = []
        for j in range(10):
            products = [parts[i] if c == 1 else parts[i] * F.lit(c) for i in range(8) if (c := 2 ** (32 * i) // base**j % base)]
            found.append(reduce(lambda x, y: x + y, products) if products else F.lit(0).cast("long"))
        return F.array(*found)

    def step(acc: Column, limb: Column) -> Column:
        total = limb + acc["carry"]
        return F.struct(F.concat(F.lpad((total % base).cast("string"), 8, "0"), acc["out"]).alias("out"), F.call_function("div", total, F.lit(base)).alias("carry"))

    start = F.struct(F.lit("").alias("out"), F.lit(more).cast("long").alias("carry"))
    text = F.aggregate(let(let(quads, halves), limbs), start, step)["out"]
    return F.regexp_replace(text, "^0+(?=.)", "")  # the text is referred to once: inside a condition, Spark would make it for each time


def _signed_digits(word: Column) -> Column:
    """As word_digits, of the number in two's complement: -(1 + the flipped word) if it is negative."""
    negative = F.substring(F.hex(F.substring(word, 1, 1)), 1, 1) >= "8"
    flipped = F.unhex(F.translate(F.hex(word), "0123456789ABCDEF", "FEDCBA9876543210"))
    return F.when(negative, F.concat(F.lit("-"), word_digits(flipped, 1))).otherwise(word_digits(word))


def _value(kind: str, word: Column) -> Column:
    """The column of a scalar's word; ``<type> text`` gives the digits of numbers that are null for their size."""
    if kind.endswith(" text"):
        kind = kind.removesuffix(" text")
        return F.when(word.isNotNull() & _value(kind, word).isNull(), _signed_digits(word) if kind.startswith("int") else word_digits(word))
    if kind == "address":
        return F.substring(word, 13, 20)
    if kind == "bool":
        return F.hex(F.substring(word, 32, 1)) != "00"
    if kind.startswith("uint"):
        return uint_word(word)
    if kind.startswith("int"):
        return int_word(word)
    return F.substring(word, 1, 24 if kind == "function" else int(kind.removeprefix("bytes")))


def _whole(word: Column) -> Column:
    return F.when(F.octet_length(word) == 32, word)


def decode_event(signature: str, topic1: Column, topic2: Column, topic3: Column, data: Column, with_hex: bool = False, wide: str = "text") -> Column:
    """A struct of the event's parameters. Numbers are decimal(38,0). Types of more than 126 bits can hold more: with wide =
    ``text`` they get ``<name>_text`` beside the number, the whole number in decimal digits where the number is null for its
    size (so nothing is lost and the rest costs nothing); with wide = ``none`` they do not. with_hex adds ``<name>_hex`` with the
    whole word of each number. Arrays become arrays (of numbers, with an array of texts beside them), tuples structs. Indexed arrays, tuples
    and texts are only there as their hash."""
    topics, at, out = [topic1, topic2, topic3], 0, []
    end, more = F.octet_length(data).cast("long"), wide == "text"
    for p in parse_signature(signature).parameters:
        simple = not (p.kind.item or p.kind.parts or p.kind.varies)
        if p.indexed:
            word = _whole(topics.pop(0))
        elif simple:
            word, at = _whole(F.substring(data, at + 1, 32)), at + 32
        else:
            part = decoded(p.kind, data, at, 0, end, _value, more)
            out.append(part.alias(p.name))
            if more and p.kind.wide:
                out.append(_texts(p, data, at, end))
            at += p.kind.head
            continue
        value = _value(p.type, word) if simple else word
        out.append(value.alias(p.name))
        if simple and more and p.kind.wide:
            out.append(_value(f"{p.type} text", word).alias(f"{p.name}_text"))
        if simple and with_hex and re.match("u?int", p.type):
            out.append(F.concat(F.lit("0x"), F.lower(F.hex(word))).alias(f"{p.name}_hex"))
    return F.struct(*out)


def _texts(p: Parameter, data: Column, at: int, end: Column) -> Column:
    """The digits of the wide numbers of an array whose place is at ``at``."""
    return decoded(p.kind, data, at, 0, end, lambda k, w: _value(f"{k} text", w), True).alias(f"{p.name}_text")
