import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rangeloom.functions import encoding, evm
from rangeloom.sources.abi import read_abi_events

TRANSFER = "Transfer(address indexed from, address indexed to, uint256 value)"


def word(n):
    return bytearray((n % (1 << 256)).to_bytes(32, "big"))


def test_topics():
    assert evm.keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert evm.parse_signature(TRANSFER).topic.hex() == "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
    assert evm.parse_signature("Transfer(address indexed from, address indexed to, uint value)").topic == evm.parse_signature(TRANSFER).topic
    assert evm.keccak256(b"a" * 136) != evm.keccak256(b"a" * 135)
    for bad in ("Transfer", "E(uint7 x)", "E(uint256[0] x)", "E(address indexed a, address indexed b, address indexed c, address indexed d)"):
        with pytest.raises(ValueError):
            evm.parse_signature(bad)


def test_numbers(spark):
    big = [0, 1, 2**48, 2**64, 10**38 - 1, 2**126 - 1, 10**38, 2**127, 2**128, 2**256 - 1]
    rows = spark.createDataFrame([(i, word(n)) for i, n in enumerate(big)], "i int, w binary").select("i", evm.uint_word(F.col("w")).alias("n")).orderBy("i").collect()
    assert [None if r.n is None else int(r.n) for r in rows] == [n if n < 10**38 else None for n in big]
    signed = [0, 1, -1, -(2**64), 10**38 - 1, -(10**38) + 1, 2**127, -(2**127), -(2**255)]
    rows = spark.createDataFrame([(i, word(n)) for i, n in enumerate(signed)], "i int, w binary").select("i", evm.int_word(F.col("w")).alias("n")).orderBy("i").collect()
    assert [None if r.n is None else int(r.n) for r in rows] == [n if abs(n) < 10**38 else None for n in signed]


def test_decoding(spark):
    text = "héllo".encode()
    data = word(7) + word(-3) + word(5 * 32) + word(1) + bytearray(b"ab".ljust(32, b"\0")) + word(len(text)) + bytearray(text.ljust(32, b"\0"))
    sig = "E(address indexed who, uint8 a, int256 b, string s, bool ok, bytes2 tag)"
    df = spark.createDataFrame([(word(0xABCDEF), data)], "t1 binary, d binary")
    got = df.select(evm.decode_event(sig, F.col("t1"), F.lit(None), F.lit(None), F.col("d"), with_hex=True).alias("x")).select("x.*").first()
    assert bytes(got.who).hex() == "abcdef".rjust(40, "0") and (int(got.a), int(got.b), got.s, got.ok, bytes(got.tag)) == (7, -3, "héllo", True, b"ab")
    assert got.a_hex == "0x" + f"{7:064x}" and got.b_text is None


def test_numbers_of_any_size_are_not_lost(spark):
    big = [0, 1, 10**38 - 1, 10**38, 2**128, 2**200 + 9, 2**255 - 1, 2**255, 2**256 - 1, 2**256 - 10**40, None]
    df = spark.createDataFrame([(i, None if n is None else word(n)) for i, n in enumerate(big)], "i int, w binary")
    dec = lambda kind: evm.decode_event(f"E({kind} v)", F.lit(None), F.lit(None), F.lit(None), F.col("w"))
    rows = df.select("i", evm.word_digits(F.col("w")).alias("t"), dec("uint256").alias("u"), dec("int256").alias("s"), dec("uint64").alias("n")).orderBy("i").collect()
    assert [r.t for r in rows] == [None if n is None else str(n) for n in big]
    for r, n in zip(rows, big, strict=True):
        assert "v_text" not in r.n.asDict()
        for got, want in ((r.u, n), (r.s, n if n is None or n < 2**255 else n - 2**256)):
            assert (got.v is None and got.v_text is None) if want is None else (got.v_text == str(want) and got.v is None) if abs(want) >= 10**38 else int(got.v) == want and got.v_text is None


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=300))
def test_keccak_is_stable(data):
    assert len(evm.keccak256(data)) == 32 and evm.keccak256(data) != evm.keccak256(data + b"\0")


def test_abi(spark, tmp_path):
    path = tmp_path / "abi.json"
    path.write_text('[{"type":"event","name":"Transfer","inputs":[{"name":"from","type":"address","indexed":true},{"name":"value","type":"uint256","indexed":false}]},{"type":"function","name":"f","inputs":[]},{"type":"event","name":"Paused","inputs":[]}]')
    got = {r.name: (r.signature, r.canonical) for r in read_abi_events(spark, f"file://{path}").collect()}
    assert got == {"Transfer": ("Transfer(address indexed from, uint256 value)", "Transfer(address,uint256)"), "Paused": ("Paused()", "Paused()")}
    assert read_abi_events(spark, f"file://{path}", "Paused").count() == 1


def test_encodings(spark):
    df = spark.createDataFrame([("0xAB", bytearray(b"\xab"), 1_700_000_000_123_456_789, "2024-01-02 03:04:05 UTC", None)], "h string, b binary, ns long, t string, nothing string")
    r = df.select(encoding.from_hex(F.col("h")).alias("raw"), encoding.to_hex(F.col("b")).alias("hex"), encoding.timestamp_text(encoding.from_nanoseconds(F.col("ns"))).alias("ts"), encoding.timestamp_text(encoding.parse_utc(F.col("t"))).alias("utc"), encoding.text_or_empty(F.col("nothing")).alias("e"), encoding.row_json(df, ["h", "b", "nothing"]).alias("j")).first()
    assert (bytes(r.raw), r.hex, r.ts, r.utc, r.e, r.j) == (b"\xab", "0xab", "2023-11-14 22:13:20.123456", "2024-01-02 03:04:05.000000", "", '{"b":"ab","h":"0xAB"}')
    keys = spark.createDataFrame([(1, None, bytearray(b"x"))], "id long, other string, b binary")
    assert keys.select(encoding.key_from_pattern(keys, "{table}:{id}:{other}:{b}", "t")).first()[0].startswith("t:1:null:")
    with pytest.raises(Exception, match="no id"):
        bad = spark.createDataFrame([(None,)], "id long")
        bad.select(encoding.key_from_pattern(bad, "{table}:{id}", "t")).collect()
    assert keys.select(encoding.key_from_pattern(keys, "{table}:{index}", "t", F.lit(7))).first()[0] == "t:7"
    assert re.fullmatch("t:[0-9]+", keys.select(encoding.key_from_pattern(keys, "{table}:{index}", "t")).first()[0])
    assert re.fullmatch("t:[0-9a-f]{32}", keys.select(encoding.key_from_pattern(keys, "{table}:{nowhere}", "t")).first()[0])
    assert keys.select(encoding.composite_key(keys, ["id", "other"])).first()[0] == "1:null"
    assert len(keys.select(encoding.composite_key(keys)).first()[0]) == 32
    ref = spark.createDataFrame([("ns/name@1.0.0",), ("bad",)], "r string").select(encoding.parse_reference(F.col("r")).alias("x")).select("x.*").collect()
    assert tuple(ref[0]) == ("ns", "name", "1.0.0") and tuple(ref[1]) == (None, None, None)
    assert encoding.hex_encode_binary(df.select("b")).first()[0] == "0xab"


def test_digits_of_numbers_with_carries_through_all_limbs(spark):
    numbers = [10**k + d for k in range(8, 78, 3) for d in (-1, 0, 1)] + [2**k - d for k in range(31, 256, 25) for d in (0, 1)] + [2**256 - 1 - 2**64, 1 << 63, (1 << 64) - 1, 1 << 255]
    df = spark.createDataFrame([(str(n), word(n)) for n in numbers], "n string, w binary")
    assert df.where(evm.word_digits(F.col("w")) != F.col("n")).count() == 0
    more = df.select("n", evm.word_digits(F.col("w"), 1).alias("m"), evm.uint_word(F.col("w")).alias("u")).collect()
    assert all(int(r.m) == int(r.n) + 1 and (None if r.u is None else int(r.u)) == (int(r.n) if int(r.n) < 10**38 else None) for r in more)
