"""Operator 5: secret scans through nested encodings, by a recursive decoding worklist.

The text is the first layer. Each layer is scanned for secrets, then unwrapped: URL escapes and
Unicode escapes decode the layer as a whole, each base64 run and each compressed payload becomes a
layer of its own. A base64 run may go on over line breaks and is read at each of its four
alignments; compressed payloads may start at any decoded byte and are read to the end of their last
member. New layers join the worklist until none is new; a layer whose bytes and place
were seen before is not queued again, which ends cycles. Every byte of a layer remembers the span
of the text that it came from, so a secret found four layers down is reported where it stands in
the text. Secrets of the first layer are the base; deeper layers only add spans.

Escaped escape signs (``%2525...41``, ``\\u005cu005c...``, ``&#38;#38;...``) lose all but their last
level at once: between those levels only digits behind a sign differ that no secret holds, so the
layers left out have nothing new, and a text nested in this way costs a few passes however deep.

A payload that breaks off or is damaged counts as far as it unpacks. One that unpacks to more than
``BLOCK`` bytes is read in blocks that overlap by ``OVERLAP``; all its bytes stand for one span of the
text, so a secret cut at a block's end is still one of that span. Layers are made when their turn
comes, so a task holds one layer for each level of nesting, and of the layers seen a digest only.

Defined cases: null text is empty; repeated rows are scanned as rows of their own; extra columns
are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in the order of the report, and the least length of each.
KINDS = ("assign", "access", "hex")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")  # a run of 24 or more is the same match as a run that is then measured

_URL = re.compile(rb"%([0-9A-Fa-f]{2})")
_ESCAPE = re.compile(rb"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
_RUN = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")  # from a run's beginning only, so in one pass
_BREAK = re.compile(rb"[\x20\t\r\n]+")
_BYTE = re.compile(rb"\\x([0-9A-Fa-f]{2})")
#: How compressed bytes start; zlib's second byte is one of four that need no dictionary.
_MAGIC = re.compile(rb"(?P<gzip>\x1f\x8b\x08)|(?P<zlib>\x78[\x01\x5e\x9c\xda])|(?P<bzip2>BZh[1-9])|(?P<xz>\xfd7zXZ\x00)|(?P<zstd>\x28\xb5\x2f\xfd)")
#: Escape signs that are escaped themselves, again and again, in front of what they escape.
_CHAINS = {
    "url": (re.compile(rb"%(?:25)+(?=[0-9A-Fa-f]{2})"), b"%"),
    "unicode": (re.compile(rb"\\u005[cC](?:u005[cC])*(?=u[0-9A-Fa-f]{4})|\\x5[cC](?:x5[cC])*(?=x[0-9A-Fa-f]{2})|&#(?:38|[xX]26);(?:#(?:38|[xX]26);)*(?=#)"), None),
    "bytes": (re.compile(rb"\\x5[cC](?:x5[cC])*(?=x[0-9A-Fa-f]{2})"), b"\\"),
}
BLOCK, OVERLAP = 16 << 20, 1 << 20
_PIECE = 1 << 20  # bytes unpacked at a time
_LEAST = 12  # bytes of the shortest secret, and less than any wrapping of it


#: What compressed bytes start with, as far as all of a kind share it.
_SIGNS = (b"\x1f\x8b\x08", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")


def _marked(characters: bytes) -> bytes:
    return bytes(0x78 if i in characters else 0x20 for i in range(256))


_HEX_SIGNS = _marked(b"0123456789abcdef")
_RUN_SIGNS = _marked(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _has_run(data: bytes, signs: bytes, n: int) -> bool:
    """Whether ``n`` of the marked bytes stand in a row: much quicker than to look for them by pattern."""
    return b"x" * n in data.translate(signs)


class Starts:
    """Where compressed payloads may start: the next place of each sign is looked for once."""

    def __init__(self, data: bytes):
        self.data, self.ahead = data, {sign: data.find(sign) for sign in _SIGNS}

    def next(self, at: int) -> re.Match | None:
        for sign, place in self.ahead.items():
            if 0 <= place < at:
                self.ahead[sign] = self.data.find(sign, at)
        places = [p for p in self.ahead.values() if p >= 0]
        return _MAGIC.search(self.data, min(places)) if places else None


def find(layer: bytes) -> list[tuple[str, int, int]]:
    """Secrets of one layer as (kind, start, end) in bytes, leftmost and non-overlapping by kind."""
    found = []
    low = layer.lower()  # bytes: A-Z only
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(low) if len(m[1]) >= 6]
    if b"AKIA" in layer:
        found += [("access", *m.span()) for m in _ACCESS.finditer(layer) if m.end() - m.start() >= 20]
    if _has_run(layer, _HEX_SIGNS, 24):
        found += [("hex", *m.span()) for m in _HEX.finditer(layer)]
    return found


class Same:
    """A sequence of n equal values."""

    def __init__(self, value, n: int):
        self.value, self.n = value, n

    def __getitem__(self, i):
        return self.value


def _at(values: range | Same | np.ndarray, places: np.ndarray) -> np.ndarray:
    """The values at these places. A range begins at 0."""
    if isinstance(values, range):
        return places
    return np.full(len(places), values.value) if isinstance(values, Same) else values[places]


class Layer:
    """Bytes with, for each, the span of the text it came from, and whether it was decoded.

    Only bytes that stand under an encoding hold numbers of their own: the text itself is a range,
    and what was unpacked from one payload is one span.
    """

    def __init__(self, data: bytes, starts: range | Same | np.ndarray, ends: range | Same | np.ndarray, decoded: np.ndarray | Same | None, via: str):
        self.data, self.starts, self.ends, self.decoded, self.via = data, starts, ends, decoded, via

    def span(self, a: int, b: int) -> tuple[int, int]:
        return int(self.starts[a]), int(self.ends[b - 1])

    def fresh(self, a: int, b: int) -> bool:
        if self.decoded is None or isinstance(self.decoded, Same):
            return self.decoded is not None
        return bool(self.decoded[a:b].any())


def _replaced(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with each match of ``pattern`` decoded, None if nothing is."""
    out, cuts, at = bytearray(), [], 0
    for m in pattern.finditer(layer.data):
        piece = decode(m)
        if piece is None:
            continue
        a, b = m.span()
        out += layer.data[at:a] + piece
        cuts.append((a, b, len(piece)))
        at = b
    if not cuts:
        return None
    out += layer.data[at:]
    a, b, n = np.array(cuts, dtype=np.int64).T
    # runs of bytes in turn: kept as they are, decoded, kept, ..., kept
    begins, sizes = np.empty(2 * len(a) + 1, dtype=np.int64), np.empty(2 * len(a) + 1, dtype=np.int64)
    begins[0], begins[2::2], begins[1::2] = 0, b, a
    sizes[1::2], sizes[0::2] = n, np.append(a, len(layer.data)) - begins[0::2]
    new = np.repeat(np.arange(len(sizes)) % 2 == 1, sizes)
    within = np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = np.repeat(begins, sizes) + np.where(new, 0, within)
    last = first.copy()
    last[new] = np.repeat(b - 1, n)
    old = new if layer.decoded is None else new | _at(layer.decoded, first).astype(bool)
    ends = last + 1 if isinstance(layer.ends, range) else _at(layer.ends, last)
    return Layer(bytes(out), _at(layer.starts, first), ends, old, f"{layer.via}>{name}")


def _escaped(m: re.Match) -> bytes | None:
    digits, base = next((x, 10 if k == 3 else 16) for k, x in enumerate(m.groups()) if x is not None)
    point = int(digits, base)
    return chr(point).encode("utf-8", "surrogatepass") if point <= 0x10FFFF else None


class Unpacker:
    """The members of a payload that follow each other from ``at`` on, piece by piece; afterwards
    where reading ended and whether at least the first member was whole."""

    def __init__(self, data: bytes, name: str, at: int):
        self.data, self.name, self.end, self.whole = data, name, at, False

    def __iter__(self) -> Iterator[bytes]:
        try:
            while (m := _MAGIC.match(self.data, self.end)) and m.lastgroup == self.name:
                yield from self._member()
                if not self.whole:
                    return
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
            pass
        except Exception as error:  # the zstd library has its own error class
            if type(error).__name__ != "ZstdError":
                raise

    def _member(self) -> Iterator[bytes]:
        if self.name in ("gzip", "zlib"):
            reader = zlib.decompressobj(31 if self.name == "gzip" else 15)
        elif self.name in ("bzip2", "xz"):
            reader = bz2.BZ2Decompressor() if self.name == "bzip2" else lzma.LZMADecompressor()
        else:
            import zstandard

            reader = zstandard.ZstdDecompressor().decompressobj()
        step = 1024 if self.name == "zstd" else 65536  # zstd has no bound on what a call returns
        given = b""
        while not reader.eof:
            if not given and getattr(reader, "needs_input", True):
                given = self.data[self.end : self.end + step]
                self.end += len(given)
                if not given:
                    return
            if self.name == "zstd":
                out, given = reader.decompress(given), b""
            else:
                out = reader.decompress(given, _PIECE)
                given = getattr(reader, "unconsumed_tail", b"")
                while len(out) == _PIECE and not given and not reader.eof and not hasattr(reader, "needs_input"):
                    yield out
                    out = reader.decompress(b"", _PIECE)
                    given = reader.unconsumed_tail
            if out:
                yield out
        self.end -= len(reader.unused_data)
        self.whole = True


def _blocks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Pieces put together to blocks, each of which begins with the end of the one before it."""
    held, fresh = bytearray(), False
    for piece in pieces:
        held += piece
        fresh = True
        if len(held) >= BLOCK:
            yield bytes(held)
            del held[:-OVERLAP]
            fresh = False
    if fresh:
        yield bytes(held)


def _payloads(data: bytes) -> Iterator[tuple[str, int, int, Iterator[bytes]]]:
    """(name, start, end, blocks of the content) of the compressed payloads, wherever they start."""
    at, starts = 0, Starts(data)
    while m := starts.next(at):
        first, size, reader = [], 0, Unpacker(data, m.lastgroup, m.start())
        for piece in reader:  # to the end, to know where that is; what is long is not held but read again
            size += len(piece)
            if size <= BLOCK:
                first.append(piece)
        end, whole = reader.end, reader.whole
        if size:
            blocks = iter([b"".join(first)]) if size <= BLOCK else _blocks(iter(Unpacker(data, m.lastgroup, m.start())))
            yield m.lastgroup, m.start(), max(end, m.end()), blocks
        at = end if whole else m.start() + 1  # what looked like a start may have been none


def _base64(layer: Layer, a: int, b: int) -> Iterator[Layer]:
    """The layers under a base64 run, and under what is compressed in it, at each alignment."""
    raw = layer.data[a:b].rstrip(b"=")
    run = _BREAK.sub(b"", raw)
    places = np.arange(a, a + len(raw))
    if len(run) < len(raw):
        places = places[~np.isin(np.frombuffer(raw, dtype=np.uint8), np.frombuffer(b"\x20\t\r\n", dtype=np.uint8))]
    run = run.translate(bytes.maketrans(b"-_", b"+/"))
    for k in range(4):
        part = run[k : len(run) - ((len(run) - k) % 4 == 1)]
        data = base64.b64decode(part + b"=" * (-len(part) % 4))
        if len(data) < _LEAST:
            continue
        j = np.arange(len(data)) * 8
        starts, last = _at(layer.starts, places[k + j // 6]), places[k + (j + 7) // 6]
        ends = last + 1 if isinstance(layer.ends, range) else _at(layer.ends, last)
        for name, s, e, blocks in _payloads(data):
            for inner in blocks:
                n = len(inner)
                yield Layer(inner, Same(starts[s], n), Same(layer.ends[b - 1] if e >= len(data) else ends[e - 1], n), Same(True, n), f"{layer.via}>base64>{name}")
        yield Layer(data, starts, ends, Same(True, len(data)), f"{layer.via}>base64")


def _decoded(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with its escapes decoded once, and with chains of escaped signs cut to the last."""
    chain, sign = _CHAINS[name]
    short = _replaced(layer, chain, lambda m: sign or m[0][:1], name)
    if short is None:
        return _replaced(layer, pattern, decode, name)
    short.via = layer.via
    return _replaced(short, pattern, decode, name) or short


def unwrapped(layer: Layer) -> Iterator[Layer]:
    data = layer.data
    if b"%" in data and (x := _decoded(layer, _URL, lambda m: bytes([int(m[1], 16)]), "url")):
        yield x
    if (b"\\" in data or b"&#" in data) and (x := _decoded(layer, _ESCAPE, _escaped, "unicode")):
        yield x
    if b"\\x" in data and (x := _decoded(layer, _BYTE, lambda m: bytes([int(m[1], 16)]), "bytes")):
        yield x
    if _has_run(data, _RUN_SIGNS, 16):
        for m in _RUN.finditer(data):
            yield from _base64(layer, *m.span())
    if b"\n" in data:
        for m in _WRAPPED.finditer(data):
            yield from _base64(layer, *m.span())
    if layer.decoded is not None:
        for name, s, e, blocks in _payloads(data):
            for inner in blocks:
                n = len(inner)
                yield Layer(inner, Same(layer.starts[s], n), Same(layer.ends[e - 1], n), Same(True, n), f"{layer.via}>{name}")


def scan_text(text: bytes) -> list[dict]:
    """Every secret of a text: kind, start, end in code points, base, via (the layers it lay under)."""
    first = Layer(text, range(len(text)), range(1, len(text) + 1), None, "text")
    found: dict[tuple[str, int, int], tuple[bool, str]] = {}

    def look(layer: Layer) -> None:
        for kind, a, b in find(layer.data):
            if layer is first:
                found[kind, a, b] = (True, "text")
            elif layer.fresh(a, b):
                found.setdefault((kind, *layer.span(a, b)), (False, layer.via))

    def mark_of(layer: Layer) -> tuple[bytes, int]:
        return hashlib.blake2b(layer.data, digest_size=16).digest(), int(layer.starts[0]) if layer.data else 0

    look(first)
    work, seen = [unwrapped(first)], {mark_of(first)}
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif (mark := mark_of(layer)) not in seen:
            seen.add(mark)
            look(layer)
            work.append(unwrapped(layer))
    if not found:
        return []
    if text.isascii():
        at = int
    else:  # characters begin at bytes that continue none
        before = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
        at = lambda i: int(before[i])
    rows = [{"kind": k, "start": at(a), "end": at(b), "base": base, "via": via} for (k, a, b), (base, via) in found.items()]
    return sorted(rows, key=lambda r: (r["start"], KINDS.index(r["kind"]), r["end"]))


FOUND = "array<struct<kind: string, start: int, end: int, base: boolean, via: string>>"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("via", pa.string())]))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: doc_id and ``found``, its secrets in order of place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            rows = [scan_text(x.as_py() or b"") for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _FOUND)], names=["doc_id", "found"])

    source = df.select(df[key].alias("doc_id"), df[text].alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, found {FOUND}")


def report(found: DataFrame) -> DataFrame:
    """Counts of the base secrets by kind, a digest of their places, and all places as text."""
    of = lambda kind: F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == kind))).cast("long")
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.filter("found", lambda x: x["base"])), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )
