"""Arrays and tuples of event data: against an encoder of the format, and with hostile words."""

import random

import pytest
from pyspark.sql import functions as F

from rangeloom.functions import evm
from rangeloom.functions.abi_types import Kind, parse_parameter


def word(n):
    return (n % (1 << 256)).to_bytes(32, "big")


def encode(kind: Kind, v) -> bytes:
    """The encoding of a value, by the rules of heads and tails."""
    if kind.item:
        body = sequence([kind.item] * len(v), v)
        return (word(len(v)) if kind.length is None else b"") + body
    if kind.parts:
        return sequence([k for _, k in kind.parts], v)
    if kind.name in ("bytes", "string"):
        raw = v if kind.name == "bytes" else v.encode()
        return word(len(raw)) + raw + bytes(-len(raw) % 32)
    if kind.name == "address":
        return bytes(12) + v
    if kind.name.startswith("bytes"):
        return v.ljust(32, b"\0")
    return word(int(v))


def sequence(kinds, values) -> bytes:
    at, heads, tails = sum(k.head for k in kinds), b"", b""
    for k, v in zip(kinds, values, strict=True):
        raw = encode(k, v)
        heads += word(at + len(tails)) if k.varies else raw
        tails += raw if k.varies else b""
    return heads + tails


def plain(v):
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v if v is None or isinstance(v, (str, bool)) else int(v)


def decode(spark, signature, rows, wide="none"):
    df = spark.createDataFrame([(i, bytearray(x) if x is not None else None) for i, x in enumerate(rows)], "i long, d binary")
    got = df.select("i", evm.decode_event(signature, F.lit(None).cast("binary"), F.lit(None).cast("binary"), F.lit(None).cast("binary"), F.col("d"), wide=wide).alias("x")).orderBy("i").collect()
    return [r.x for r in got]


def test_signatures():
    batch = evm.parse_signature("TransferBatch(address indexed operator, address indexed from, address indexed to, uint[] ids, uint256[] values)")
    assert batch.canonical == "TransferBatch(address,address,address,uint256[],uint256[])"
    assert batch.topic.hex() == "4a39dc06d4c0dbc64b70af90fd698a233a518aa5d07e595d983b8c0526c8f7fb"
    nested = evm.parse_signature("E(tuple(address who, (uint8, string)[2] list)[] indexed x, bytes32[3][] y)")
    assert nested.canonical == "E((address,(uint8,string)[2])[],bytes32[3][])" and nested.parameters[0].indexed
    for bad in ("E(uint256[0] x)", "E(() x)", "E((uint8 x)", "E(uint8)) x)", "E(uint7[] x)", "E(uint256[] x y)", "E(map x)"):
        with pytest.raises(ValueError):
            evm.parse_signature(bad)


def random_kind(r, depth):
    if depth and r.random() < 0.6:
        if r.random() < 0.5:
            return f"{random_kind(r, depth - 1)}[{r.choice(['', '', '1', '3'])}]"
        return "(" + ",".join(random_kind(r, depth - 1) for _ in range(r.randint(1, 3))) + ")"
    return r.choice(["uint256", "int64", "address", "bool", "string", "bytes", "bytes4"])


def random_value(r, kind):
    if kind.item:
        return [random_value(r, kind.item) for _ in range(r.randint(0, 3) if kind.length is None else kind.length)]
    if kind.parts:
        return [random_value(r, k) for _, k in kind.parts]
    return {"uint8": lambda: r.randrange(256), "uint256": lambda: r.randrange(10**38), "int64": lambda: r.randint(-(2**63), 2**63 - 1), "address": lambda: r.randbytes(20), "bool": lambda: r.random() < 0.5, "string": lambda: "é" * r.randint(0, 40), "bytes": lambda: r.randbytes(r.randint(0, 70)), "bytes4": lambda: r.randbytes(4)}[kind.name]()


@pytest.mark.parametrize("seed", range(12))
def test_random_types_and_values(spark, seed):
    r = random.Random(seed)
    kinds = [random_kind(r, 3) for _ in range(2)]
    signature = f"E({kinds[0]} a, {kinds[1]} b)"
    parsed = [parse_parameter(k)[0] for k in kinds]
    values = [[random_value(r, k) for k in parsed] for _ in range(6)]
    assert [plain([x.a, x.b]) for x in decode(spark, signature, [sequence(parsed, v) for v in values])] == plain(values)


@pytest.mark.parametrize("signature", ["E(uint256[] a, string b)", "E((uint8,string)[] a, bytes[][] b)", "E(bytes a, (uint256,uint256[])[2] b)"])
def test_hostile_words_give_null_and_never_fail(spark, signature):
    r = random.Random(signature)
    kinds = [p.kind for p in evm.parse_signature(signature).parameters]
    good = [random_value(r, k) for k in kinds]
    data, rows = sequence(kinds, good), [None, b"", b"\x01" * 31]
    for at in range(0, len(data), 32):
        for w in (0, 1, 31, 1 << 20, (1 << 31) - 1, 1 << 31, 1 << 62, (1 << 63) - 1, 1 << 64, (1 << 256) - 1):
            rows.append(data[:at] + word(w) + data[at + 32 :])
    rows += [data[:n] for n in range(0, len(data), 7)] + [r.randbytes(32 * k) for k in range(8)]
    assert len(decode(spark, signature, rows, "text")) == len(rows)
    got = decode(spark, signature, [data, *rows])
    assert plain([got[0].a, got[0].b]) == plain(good) and got[1].a is None and got[2].b is None
    assert len(got) == len(rows) + 1


def test_a_bad_part_leaves_the_others(spark):
    signature = "E(uint256[] a, string b, (uint256 n, bytes s)[] c)"
    kinds = [p.kind for p in evm.parse_signature(signature).parameters]
    data = bytearray(sequence(kinds, [[1, 2], "text", [[7, b"x"], [8, b"y"]]]))
    broken = data[:32] + word(1 << 40) + data[64:]
    x = decode(spark, signature, [broken])[0]
    assert plain(x.a) == [1, 2] and x.b is None and plain(x.c) == [[7, b"x"], [8, b"y"]]
    tail = bytearray(data)
    tail[-32 * 4 + 32 : -32 * 4 + 64] = word(1 << 50)  # the distance of the last element's bytes
    x = decode(spark, signature, [tail])[0]
    assert x.b == "text" and plain(x.c) == [[7, b"x"], [8, None]]


def test_elements_that_share_a_tail_are_refused(spark):
    """Many elements that point at one long tail would be more words than the data has."""
    n, tail = 50, word(40) + word(9) * 40
    shared = word(32) + word(n) + word(32 * n) * n + tail
    x = decode(spark, "E(uint256[][] a)", [shared])[0]
    assert sum(len(e) for e in x.a if e) <= 41 and len(x.a) == n


def test_wide_numbers_keep_their_digits(spark):
    signature = "E(uint256[] a, (int256 n, uint8 m)[] b, uint256[2] c)"
    kinds = [p.kind for p in evm.parse_signature(signature).parameters]
    big = 2**200 + 1
    x = decode(spark, signature, [sequence(kinds, [[5, big], [[-big, 1], [3, 2]], [big, 4]])], "text")[0]
    assert plain(x.a) == [5, None] and x.a_text == [None, str(big)] and x.c_text == [str(big), None]
    assert [(None if e.n is None else int(e.n), e.n_text, int(e.m)) for e in x.b] == [(None, str(-big), 1), (3, None, 2)]


def test_hostile_words_in_flat_events(spark):
    for w in (1 << 31, 1 << 32, 1 << 62, 1 << 64, (1 << 256) - 1, 33):
        x = decode(spark, "E(uint8 a, string s, bytes b)", [word(1) + word(w) + word(96) + word(w) + bytes(32)])[0]
        assert int(x.a) == 1 and x.s is None and x.b is None


def test_tuples_of_an_interface_description(spark, tmp_path):
    from rangeloom.sources.abi import read_abi_events

    path = tmp_path / "abi.json"
    path.write_text('[{"type":"event","name":"Filled","inputs":[{"name":"who","type":"address","indexed":true},{"name":"legs","type":"tuple[]","components":[{"name":"id","type":"uint256"},{"name":"deep","type":"tuple","components":[{"name":"","type":"bytes"}]}]}]}]')
    r = read_abi_events(spark, f"file://{path}").first()
    assert r.canonical == "Filled(address,(uint256,(bytes))[])" == evm.parse_signature(r.signature).canonical
    assert [n for n, _ in evm.parse_signature(r.signature).parameters[1].kind.item.parts] == ["id", "deep"]
