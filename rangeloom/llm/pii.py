"""Surrogates for personal data: keyed, of the same type and format, distinct for distinct entities.

Detected entities are e-mail addresses, phone and national identity numbers, addresses of both internet protocols, payment cards (with a valid
check digit), bank accounts (IBAN with valid check digits), secrets (named assignments, keys with well-known prefixes and long hexadecimal strings) and
persons. A person stands after titles or, with two names, after a word that announces one (TITLES and CUES, fixed lists in several languages)
or with a listed given name; later or earlier mentions in the same text by whole, family or given name need none of these. A surrogate keeps type,
length, separators, script and case (an address of version 6 its version only); a card or an account gets valid check digits. Listed given names are
replaced by given names of the same gender; other names keep their last letter, which shows the gender in many languages, and their pattern
of vowels and consonants, but for scripts without cases.

Each surrogate is a keyed permutation without fixed points of the entity's normal form within its format (a Feistel network with
cycle walking over the format's values), so an entity has one surrogate in the whole corpus and two entities of a format never
share one, without a table of entities. ``collisions`` checks that over the whole corpus with one aggregation; should it find one, the corpus
gets another key derived from the first.

Values of more than LONG characters are permuted by a Feistel network over their halves, position by position, in time in proportion to their length.

The key is a parameter, or the session's setting ``spark.rangeloom.pii.secret`` (hexadecimal), a name that Spark redacts in its UI and logs; a session
without it gets a random one, so two sessions give different surrogates unless they share the setting.

Defined cases: null text stays null; texts without entities are returned as they are; rows with repeated or null ids give
a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
import secrets
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.llm.common import in_small_batches, release

KEY_SETTING = "spark.rangeloom.pii.secret"
#: Characters from which on a value is permuted in halves.
LONG = 256


def session_key(spark: SparkSession) -> bytes:
    """The key of the session's setting; a random one is set where there is none."""
    found = spark.conf.get(KEY_SETTING, None)
    if not found:
        found = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, found)
    return bytes.fromhex(found)


# --- keyed permutations -------------------------------------------------------------------------------------------


def _turned(key: bytes, tweak: str, value: int, size: int, turns: range) -> int:
    """A Feistel network over the least even number of bits that hold size, walked until it is back below size. The turns in
    falling order undo those in rising order."""
    half = ((size - 1).bit_length() + 1) // 2
    mask, back = (1 << half) - 1, turns.step < 0
    while True:
        a, b = value >> half, value & mask
        if back:
            a, b = b, a
        for turn in turns:
            h = hmac.digest(key, f"{tweak}|{size:x}|{turn}|{b:x}".encode(), "sha256")
            if half > 256:
                h = hashlib.shake_256(h).digest(half // 8 + 1)
            a, b = b, a ^ int.from_bytes(h, "big") & mask
        if back:
            a, b = b, a
        value = a << half | b
        if value < size:
            return value


def permuted(key: bytes, tweak: str, value: int, size: int) -> int:
    """A permutation of 0 .. size - 1 that depends on key and tweak and moves every value: the next one in a keyed order."""
    if size < 2:
        return value
    there = _turned(key, tweak, value, size, range(6))
    return _turned(key, tweak, (there + 1) % size, size, range(5, -1, -1))


#: Sets of characters that a position keeps; other letters and digits have the set that block_set() gives, the rest stays.
_SETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "áàâäãåæéèêëíìîïñóòôöõúùûüýÿçœß"]
_SET_OF = {c: s for s in _SETS for c in s}
#: Of names, so that their surrogates can be spoken: vowels stay vowels.
_NAME_SETS = ["aeiouy", "bcdfghjklmnpqrstvwxz", "áàâäãåæéèêëíìîïóòôöõúùûüý", "αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψ"]
_NAME_SET_OF = {c: s for s in _NAME_SETS for c in s}


def lowered(text: str) -> str:
    """Lower case, but for letters whose lower case is more than one character."""
    return "".join(x if len(x := c.lower()) == 1 else c for c in text)


@lru_cache(1 << 12)
def _class(c: str) -> tuple | None:
    """What a letter or digit outside _SETS shares with its set: block of 128 characters, category and cases."""
    if not c.isalnum() or c in _SET_OF:
        return None
    return ord(c) >> 7, unicodedata.category(c), lowered(c) == c, len(c.upper()) == 1 and lowered(c.upper()) == c and c.upper() != c


@lru_cache(1 << 12)
def block_set(c: str) -> str | None:
    if (own := _class(c)) is None:
        return None
    return "".join(x for x in map(chr, range(own[0] << 7, (own[0] + 1) << 7)) if _class(x) == own)


def _halves(key: bytes, tweak: str, sets: list[str], places: list[int], rounds: int = 8) -> list[int]:
    """Places in sets, permuted: each round adds to one half, modulo the sets, a stream that the other half fixes."""
    middle, sizes = len(places) // 2, list(map(len, sets))
    out = list(places)
    for turn in range(rounds):
        own, other = (slice(0, middle), slice(middle, None))[:: 1 if turn % 2 else -1]
        seed = hmac.digest(key, f"{tweak}|{turn}|".encode() + ",".join(map(str, out[other])).encode(), "sha256")
        stream = hashlib.shake_256(seed).digest(8 * len(out[own]))
        out[own] = [(x + int.from_bytes(stream[8 * i : 8 * i + 8], "big")) % n for i, (x, n) in enumerate(zip(out[own], sizes[own], strict=True))]
    return out


def same_pattern(key: bytes, tweak: str, text: str, special: dict[str, str] | None = None) -> str:
    """Lower-case text permuted within its pattern of character sets; special: sets that go before the usual ones."""
    sets = [(special or {}).get(c) or _SET_OF.get(c) or block_set(c) for c in text]
    if len(text) > LONG:
        pattern = hashlib.sha256("".join("-" if s is None else s[0] for s in sets).encode()).hexdigest()
        own = [s for s in sets if s]
        new = iter(_halves(key, f"{tweak}|{len(text)}|{pattern}", own, [s.index(c) for c, s in zip(text, sets, strict=True) if s]))
        return "".join(s[next(new)] if s else c for c, s in zip(text, sets, strict=True))
    value, size = 0, 1
    for c, s in zip(text, sets, strict=True):
        if s:
            value, size = value * len(s) + s.index(c), size * len(s)
    value = permuted(key, tweak + "|" + "".join("-" if s is None else f"({s[0]}{len(s)})" for s in sets), value, size)
    out = []
    for c, s in zip(reversed(text), reversed(sets), strict=True):
        if s:
            value, i = divmod(value, len(s))
            c = s[i]
        out.append(c)
    return "".join(reversed(out))


def name_pattern(key: bytes, tweak: str, name: str) -> str:
    """A lower-case name permuted within its pattern of vowels and consonants, but for the last letter of three or more."""
    end = name[-1:] if sum(map(str.isalpha, name)) > 2 and name[-1:].upper() != name[-1:].lower() else ""
    return same_pattern(key, f"{tweak}|{end}", name.removesuffix(end), _NAME_SET_OF) + end


def recased(model: str, text: str) -> str:
    """text with the cases of model, but for letters whose upper case is longer or has another lower case."""
    up = lambda c: x if len(x := c.upper()) == 1 and lowered(x) == c else c
    return "".join(up(c) if m.isupper() else c for m, c in zip(model, text, strict=True))


def refilled(model: str, digits: str) -> str:
    """The model with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isascii() and c.isdigit() else c for c in model)


def only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


# --- entities -----------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


#: Given names by gender, fixed values for surrogates; a name of a list is replaced by one of that list.
WOMEN = "Alice Anna Carla Clara Elena Emma Eva Greta Ines Irene Julia Laura Lena Lucia Maria Marta Nadia Olga Paula Petra Rosa Sara Sofia Vera".split()
MEN = "Adam Alan Bruno Carlos David Diego Erik Felix Georg Hugo Ivan Jan Jean Karl Luis Marco Martin Otto Pablo Paul Peter Robert Simon Victor".split()
_LISTED = {x.lower() for x in WOMEN + MEN}
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señor|Señora|Sr|Sra|Don|Doña|Господин|Госпожа|Г-н|Г-жа|Κύριος|Κυρία"
CUES = "[Nn]ame(?: is)?|[Cc]ontact|[Pp]atient|[Cc]ustomer|[Ee]mployee|[Aa]ttn|[Ss]igned(?: by)?|[Dd]ear|Kind regards|[Kk]ontakt|[Kk]unde|Kundin|[Nn]om|[Cc]liente?|[Nn]ombre|Cher|Chère|Querid[oa]|Liebe[r]?|Имя|Όνομα"


def _ranges(kinds: tuple[str, ...]) -> str:
    """The letters of these categories for a character class."""
    found = [i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i)) in kinds]
    starts = [i for i, before in zip(found, [-2, *found], strict=False) if i != before + 1]
    ends = [i for i, after in zip(found, [*found[1:], -2], strict=True) if i + 1 != after]
    return "".join(f"{chr(i)}-{chr(k)}" for i, k in zip(starts, ends, strict=True))


_UPPER, _LOWER = _ranges(("Lu", "Lt")), _ranges(("Ll",))
_TITLE = rf"(?:(?:{TITLES})\b\.? ?)+"
_NAME = rf"(?!(?:{TITLES})\b)[{_UPPER}][{_LOWER}]+(?:[-'][{_UPPER}][{_LOWER}]+)*"
#: Names in scripts without cases: Han, Hiragana, Katakana and Hangul.
_SHORT_NAME = "[\u4e00-\u9fff\u3040-\u30ff\uac00-\ud7a3]{2,4}"

PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@(?:[\w-]+\.)+[^\W\d_]{2,}(?![\w-])"),
    "secret": re.compile(r"""(?i)\b(?:api[_-]?key|access[_-]?key|auth|password|passwd|secret|token)\b["']?\s{0,3}[:=]\s{0,3}["']?(?P<v>[A-Za-z0-9_\-+/]{16,})"""),
    "keyed": re.compile(r"(?<![\w])(?:(?:AKIA|ASIA)(?P<v>[0-9A-Z]{16})|(?:gh[pousr]_|sk-|xox[abp]-)(?P<w>[A-Za-z0-9_-]{20,}))(?![\w])"),
    "hex": re.compile(r"(?<![\w])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}(?![\w])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)"),
    "card": re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])"),
    "phone": re.compile(r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,12}(?:[ .-][0-9]{2,8}){0,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|0[0-9]{3,4} [0-9]{6})(?![\w])"),
    "called": re.compile(r"(?i)(?<!\w)(?:phone|tel(?:ephone|efon|éfono)?|téléphone|mobile|mobil|móvil|call|fax|тел(?:ефон)?)(?: number| is)?[:.]? {0,2}(?P<v>[0-9]{8,15})(?!\w)"),
    "national": re.compile(r"(?<![\w-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![\w-])"),
    "ip6": re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![\w:])"),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]|\w)"),
    "person": re.compile(rf"(?<!\w){_TITLE}(?<=[ .])(?P<v>{_NAME}(?: {_NAME})?(?!\w)|{_SHORT_NAME})"),
    "announced": re.compile(rf"(?<!\w)(?:{CUES})[:,]? (?P<v>{_NAME} {_NAME})(?!\w)"),
    "listed": re.compile(rf"(?<!\w)(?P<v>(?:{'|'.join(WOMEN + MEN)}) {_NAME})(?!\w)"),
}
#: Patterns that find what another kind is.
_SAME_KIND = {"announced": "person", "listed": "person", "keyed": "secret", "called": "phone"}
#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": re.compile("@"), "keyed": re.compile("A[KS]IA|gh[pousr]_|sk-|xox[abp]-"), "ip6": re.compile(":[0-9A-Fa-f]{0,4}:"), "listed": re.compile(rf"\b(?:{'|'.join(WOMEN + MEN)}) [{_UPPER}]"), "person": re.compile(rf"\b(?:{TITLES})\b"), "secret": re.compile("[:=]"), "announced": re.compile(rf"\b(?:{CUES})[:,]? [{_UPPER}]")}
_DIGIT = re.compile("[0-9]")


def valid(kind: str, found: str) -> bool:
    if kind == "card":
        return luhn(only_digits(found)) and len(set(only_digits(found))) > 1
    if kind == "iban":
        return iban_ok(found)
    if kind == "ip":
        return all(int(x) < 256 for x in found.split("."))
    if kind == "ip6":
        try:
            return bool(ipaddress.IPv6Address(found)) and found.count(":") > 2
        except ValueError:
            return False
    if kind == "phone":
        return 8 <= len(only_digits(found)) <= 15
    return True


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities in a text, in order and apart; earlier kinds of PATTERNS go first."""
    if not text:
        return []
    digits = _DIGIT.search(text) is not None
    taken: list[tuple[int, int, str]] = []
    for kind, pattern in PATTERNS.items():
        need = _NEEDS.get(kind)
        if not (need.search(text) if need else digits):
            continue
        for m in pattern.finditer(text):
            a, z = m.span(next((g for g in pattern.groupindex if m[g] is not None), 0))
            i = bisect.bisect(taken, (a, z, ""))
            kind = _SAME_KIND.get(kind, kind)
            apart = (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or taken[i][0] >= z)
            if apart and valid(kind, text[a:z]):
                taken.insert(i, (a, z, kind))
    return untitled(text, taken)


def untitled(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """taken with the mentions without title of the persons in it: by whole name, family name or given name."""
    kinds: dict[str, str] = {}
    for a, z, kind in taken:
        if kind == "person":
            given, _, family = text[a:z].rpartition(" ")
            given, family = (given, family) if given else (family, "")
            kinds[text[a:z]] = "person"
            if family:
                kinds[family] = "person"
                kinds.setdefault(given, "given")
    if kinds:
        names = "|".join(map(re.escape, sorted(kinds, key=len, reverse=True)))
        for m in re.finditer(rf"(?<!\w)(?:{names})(?!\w)", text):
            a, z = m.span()
            i = bisect.bisect(taken, (a, z, ""))
            if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or taken[i][0] >= z):
                taken.insert(i, (a, z, kinds[m[0]]))
    return taken


def normal(kind: str, found: str) -> str:
    """What all mentions of an entity have in common."""
    if kind in ("card", "phone", "national"):
        return only_digits(found)
    if kind in ("email", "hex", "person", "given"):
        return lowered(found)
    if kind == "iban":
        return found.replace(" ", "").upper()
    if kind == "ip":
        return ".".join(str(int(x)) for x in found.split("."))
    if kind == "ip6":
        return ipaddress.IPv6Address(found).exploded
    return found


@lru_cache(1 << 16)
def _digits(key: bytes, kind: str, digits: str) -> str:
    return f"{permuted(key, f'{kind}{len(digits)}', int(digits), 10 ** len(digits)):0{len(digits)}d}"


def surrogate(key: bytes, kind: str, found: str) -> str:
    """The replacement of a mention; equal for equal normal forms but for separators and case."""
    n = normal(kind, found)
    if kind == "phone":  # the first digit stays, of a number with + that of the zone; separators play no part
        return refilled(found, n[0] + _digits(key, f"phone{n[0]}", n[1:]))
    if kind == "national":
        return refilled(found, _digits(key, kind, n))
    if kind == "card":  # the issuer's digit stays, the last one checks
        body = n[0] + _digits(key, f"card{n[0]}", n[1:-1])
        return refilled(found, next(body + c for c in "0123456789" if luhn(body + c)))
    if kind == "ip":
        value = int.from_bytes(bytes(map(int, n.split("."))), "big")
        return ".".join(map(str, permuted(key, "ip", value, 1 << 32).to_bytes(4, "big")))
    if kind == "ip6":
        new = ipaddress.IPv6Address(permuted(key, "ip6", int(ipaddress.IPv6Address(found)), 1 << 128)).exploded
        return new.upper() if found != found.lower() else new
    if kind == "hex":
        return recased(found, f"{permuted(key, 'hex', int(n, 16), 16 ** len(n)):0{len(n)}x}") if found != found.upper() else f"{permuted(key, 'hex', int(n, 16), 16 ** len(n)):0{len(n)}X}"
    if kind == "email":
        local, _, domain = n.partition("@")
        name, dot, top = domain.rpartition(".")
        return recased(found, f"{same_pattern(key, 'local' + domain, local)}@{same_pattern(key, 'domain' + top, name)}{dot}{top}")
    if kind == "iban":
        body = same_pattern(key, "iban" + n[:2], n[4:].lower()).upper()
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{n[:2]}00")) % 97
        left = iter(f"{n[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(left) for c in found)
    if kind == "given":
        return given_name(key, found)
    if kind == "person":  # the parts do not depend on each other, so a family name has one surrogate with and without a given name
        given, _, family = found.rpartition(" ")
        new = recased(family, name_pattern(key, "family", lowered(family)))
        return f"{given_name(key, given)} {new}" if given else new
    return recased(found, same_pattern(key, kind, found.lower()))  # secrets keep their case pattern


def given_name(key: bytes, found: str) -> str:
    """A listed name gives another of its list, any other one a name within its pattern that is in no list."""
    n = lowered(found)
    for names in (WOMEN, MEN):
        if (known := [x.lower() for x in names]).count(n):
            return names[permuted(key, "given", known.index(n), len(names))]
    while True:
        n = name_pattern(key, "given", n)
        if n not in _LISTED:
            return recased(found, n)


def rewritten(key: bytes, text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for a, z, kind in spans:
        parts += [text[at:a], surrogate(key, kind, text[a:z])]
        at = z
    return "".join([*parts, text[at:]])


REPLACED = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_entities", pa.int64()), ("kinds", pa.list_(pa.string()))])


def _over_texts(out: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                yield out(part.column(0).to_pylist(), part.column(1).to_pylist())
            release()

    return run


def replace(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """doc_id, text with surrogates, n_entities and the sorted distinct kinds found, for every row."""

    key = key or session_key(docs.sparkSession)

    def out(ids: list, found: list) -> pa.RecordBatch:
        rows = []
        for doc, text in zip(ids, found, strict=True):
            spans = entities(text)
            rows.append((doc, rewritten(key, text, spans), len(spans), sorted({"person" if k == "given" else k for _, _, k in spans})))
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), REPLACED, strict=True)], schema=REPLACED)

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(_over_texts(out), "doc_id long, text string, n_entities long, kinds array<string>")


def mentions(docs: DataFrame, key: bytes) -> DataFrame:
    """kind, entity (a keyed hash of the normal form) and surrogate (the same, of its normal form) of every mention."""
    schema = pa.schema([("kind", pa.string()), ("entity", pa.binary()), ("surrogate", pa.binary())])

    def short(kind: str, text: str) -> bytes:
        return hashlib.blake2b(f"{kind}|{text}".encode(), key=key, digest_size=16).digest()

    def out(_: list, found: list) -> pa.RecordBatch:
        rows = []
        for text in found:
            for a, z, kind in entities(text):
                new = surrogate(key, kind, text[a:z])
                rows.append((kind, short(kind, normal(kind, text[a:z])), short(kind, normal(kind, new))))
        cols = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(_over_texts(out), "kind string, entity binary, surrogate binary")


def collisions(docs: DataFrame, key: bytes) -> DataFrame:
    """kind, surrogate and number of entities where entities share a surrogate or one entity has several: none is right."""
    pairs = mentions(docs, key).distinct()
    shared = pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1")
    several = pairs.groupBy("kind", F.col("entity").alias("surrogate")).agg(F.count("*").alias("n")).where("n > 1")
    return shared.unionByName(several)


def sound_key(docs: DataFrame, key: bytes | None = None, tries: int = 4) -> bytes:
    """The key, or the first one derived from it, without collisions over the rows of docs."""
    key = key or session_key(docs.sparkSession)
    for _ in range(tries):
        if collisions(docs, key).isEmpty():
            return key
        key = hmac.digest(key, b"next", "sha256")
    raise ValueError(f"surrogates collide with {tries} keys")


def checked(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """As replace, with a key for which collisions() was found empty over the same rows."""
    return replace(docs, sound_key(docs, key))


def replaced_in_place(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """docs with all its columns, the text with surrogates of a sound key."""
    key = sound_key(docs, key)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                b = batch.slice(i, 512)
                new = [rewritten(key, t, entities(t)) for t in b.column(at).to_pylist()]
                yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            release()

    return in_small_batches(docs).mapInArrow(run, docs.schema)
