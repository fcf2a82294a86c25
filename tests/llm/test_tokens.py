import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rangeloom.llm import tokens
from rangeloom.llm.common import flat_bytes

ODD = ["a", "B", "é", " ", "  ", "\n", "\t", "'", "s", "'s", "'re", ",", "%", "1", " ", "　", "中", "😀", "\x1c", "\r", "ß", "٣", "—", "<|endoftext|>", "<|", "\u0085"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=40).map("".join), max_size=6))
def test_ids_equal_the_librarys(found):
    e = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"))
    ids, offsets = tokens.encode_column(e, *flat_bytes(pa.array(found, pa.string())))
    for i, t in enumerate(found):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_forgets_without_changing_results():
    own = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"))
    small = tokens.UnitEncoder(own.encode_strings, limit=3)
    for text in ("one two three", "two four", "one two three"):
        ids, _ = small.encode(*flat_bytes(pa.array([text])))
        assert ids.tolist() == own.tokenizer.encode(text).ids


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_strings_that_polynomials_modulo_powers_of_two_cannot_tell_apart(n):
    pair = [thue_morse(n), thue_morse(n, "ba")]
    data, offsets = flat_bytes(pa.array(pair))
    a, b = tokens.span_hashes(data, offsets[:-1], offsets[1:])
    assert a != b
    e = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"))
    want = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in pair]
    for column in (pair, pair[::-1], pair[:1], pair[1:]):
        ids, offsets = tokens.encode_column(e, *flat_bytes(pa.array(column)))
        for i, t in enumerate(column):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == want[pair.index(t)]


def test_units_that_share_a_hash_keep_their_own_ids(monkeypatch):
    own = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"))
    real = tokens.span_hashes
    monkeypatch.setattr(tokens, "span_hashes", lambda d, a, z: real(d, a, z) & np.uint64(3))
    few = tokens.UnitEncoder(own.encode_strings)
    found = ["the quick brown fox " * 3 + "x" * 300 + " " + "x" * 299 + "y", "the quack 12 34 ab-cd " * 5, "internationalisation internationalisatiom"]
    for _ in range(2):
        ids, offsets = few.encode(*flat_bytes(pa.array(found)))
        for i, t in enumerate(found):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids


def test_hashes_follow_the_bytes_wherever_they_stand(monkeypatch):
    data = np.random.default_rng(5).integers(0, 4, 5000).astype(np.uint8)
    starts, sizes = np.random.default_rng(6).integers(0, 4000, 3000), np.random.default_rng(7).integers(0, 6, 3000)
    found = []
    for step in (1 << 22, 700):
        monkeypatch.setattr(tokens, "_STEP", step)
        found.append(tokens.span_hashes(data, starts, starts + sizes).tolist())
    assert found[0] == found[1]
    spans = [data[a : a + n].tobytes() for a, n in zip(starts, sizes, strict=True)]
    assert len(set(zip(spans, found[0], strict=True))) == len(set(spans)) == len(set(found[0]))


def test_new_units_share_strings_for_the_library(monkeypatch):
    e = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"))
    e._forget()
    sent, real = [], e.encode_strings
    monkeypatch.setattr(e, "encode_strings", lambda x: sent.extend(x) or real(x))
    text = " ".join(f"wörd{thue_morse(i % 64 + 4)}é{'xyz'[i % 3] * (i // 64)}" for i in range(4000))
    ids, _ = tokens.encode_column(e, *flat_bytes(pa.array([text])))
    assert ids.tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids
    units = len(e.first) - 1
    assert units > 3000 and len(sent) < units / 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ODD, "<|endoftext", "|>", "endoftext|>"]), max_size=12).map("".join), max_size=30), st.sampled_from([1, 2, 3, 256]), st.booleans())
def test_units_in_one_string_keep_their_own_ids(found, joined, text):
    e = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"), special_is_text=text)
    e._forget()
    before, tokens.JOINED = tokens.JOINED, joined
    try:
        ids, offsets = tokens.encode_column(e, *flat_bytes(pa.array(found, pa.string())))
    finally:
        tokens.JOINED = before
    for i, t in enumerate(found):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_ids_that_do_not_stand_for_their_bytes_are_encoded_by_unit():
    own = tokens.hub_encoder(tokens.encoder_path("byte_bpe_50k.json"))
    text = "one two, thréé\nfour 5"
    for wrong in (np.ones_like(own.token_bytes), np.zeros_like(own.token_bytes), own.token_bytes + 1):
        e = tokens.UnitEncoder(own.encode_strings, token_bytes=wrong)
        assert e.encode(*flat_bytes(pa.array([text])))[0].tolist() == own.tokenizer.encode(text).ids


def test_cuts_are_those_of_the_tables_of_bytes():
    found = np.random.default_rng(8).integers(0, 256, 200000).astype(np.uint8)
    codes = np.arange(256)
    graph, letter = (codes > 32) & (codes < 127), ((codes | 32) >= 97) & ((codes | 32) <= 122) & (codes < 128)
    visible = graph[found]
    for k, lead in enumerate([(codes >= 0xC3) & (codes < 0xE0), (codes == 0xE0) | (codes >= 0xE4) & (codes < 0xF0), codes >= 0xF0], 1):
        visible[k:] |= lead[found[:-k]]
    want = np.isin(found[1:], [32, 10]) & visible[:-1] | letter[found[:-1]] & (graph & ~letter)[found[1:]]
    assert tokens.certain_cuts(found).tolist() == [False, *want.tolist()]
