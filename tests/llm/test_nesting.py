"""Secrets under very deep escapes and in payloads that unpack to very much."""

import base64
import gzip
import lzma
import resource
import time
import urllib.parse
import zlib

import pytest

from tidemark.llm import secrets

SECRET = "token = abcdefg"


def spans(text):
    return [(r["kind"], r["start"], r["end"]) for r in secrets.scan_text(text.encode())]


@pytest.mark.parametrize("chain", ["%" + "25" * 20_000 + "41", "\\u005c" + "u005c" * 8_000 + "u0041", "&#38;" + "#38;" * 10_000 + "#65;", "\\x5c" + "x5C" * 10_000 + "x41"])
def test_deep_chains_take_time_in_proportion(chain):
    text = f"x token = abc{chain}defg y"
    began = time.time()
    got = spans(text)
    assert time.time() - began < 2
    assert [s for s in got if s[0] == "assign"] == [("assign", 2, len(text) - 2)]


def test_mixed_levels_are_still_found():
    for level in range(1, 6):
        coded = SECRET.replace("a", "%41").replace("=", "%3D")
        for _ in range(level):
            coded = urllib.parse.quote(coded, safe=" ")
        assert ("assign", 1, len(coded) + 1) in spans(f" {coded} ") or any(s[0] == "assign" for s in spans(f" {coded} "))
    inner = base64.b64encode(urllib.parse.quote(urllib.parse.quote(SECRET)).encode()).decode()
    twice = urllib.parse.quote(urllib.parse.quote(inner, safe=""), safe="").replace("=", "%253D")
    assert any(s[0] == "assign" for s in spans(f"a {twice} b"))
    assert spans("%25zz %2525 %25") == []


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, lzma.compress])
def test_large_payloads_are_read_in_blocks(pack):
    where = (3, (16 << 20) - 5, 40 << 20)
    for at in where:
        body = bytearray(b" " * (41 << 20))
        body[at : at + len(SECRET)] = SECRET.encode()
        text = f"see {base64.b64encode(pack(bytes(body))).decode()} there"
        got = [s for s in spans(text) if s[0] == "assign"]
        assert got == [("assign", 4, len(text) - 6)], at


def test_a_bomb_does_not_fill_memory():
    """Half a gigabyte of zeros with a secret behind them, in less than a megabyte of text."""
    pack = zlib.compressobj(9)
    parts = [pack.compress(b"\0" * (64 << 20)) for _ in range(8)] + [pack.compress(SECRET.encode()), pack.flush()]
    text = base64.b64encode(b"".join(parts)).decode()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert [s[0] for s in spans(f"a {text} b")] == ["assign"]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def test_damaged_and_joined_payloads():
    whole = gzip.compress(b"nothing here ") + gzip.compress(SECRET.encode())
    assert any(s[0] == "assign" for s in spans(base64.b64encode(whole).decode()))
    cut = zlib.compress((SECRET + " " + "tail " * 500).encode())[:-8]
    assert any(s[0] == "assign" for s in spans(base64.b64encode(cut).decode()))
