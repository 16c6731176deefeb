"""Operator 7: language-model scores from a log-frequency Bloom filter.

Training counts of words and of pairs of neighbouring words are added up over the whole corpus by
the block exchange. Their counts are quantised to powers of two, and the filter holds an n-gram of
level j once for each level up to j; a reader probes level after level until one is missing. The
filter holds every n-gram, pairs seen once included, and grows with their number.

A block sends a row to each range, so rows grow with the product of their numbers: blocks and
ranges are larger than the exchange's own, and words, which are fewer, have fewer ranges than pairs.

It is cut into slices by range of the hash. Each is built where its n-grams were added up and kept
as a packed row of a table; the counts themselves are not kept. While all slices together are at
most ``most_broadcast`` bytes, which is checked, the filter is broadcast to the workers, which
probe it text by text. Beyond that the probes travel: a block sends each slice the distinct n-grams
that it has to look up, and gets their levels back, so that no machine ever holds more than a
slice. Both ways give the same scores.

The probability of a word after another mixes the pair's relative frequency with the word's own
smoothed one; a word after an unseen word has its own alone. The exact unigram score beside it
does not use the filter: the exchange answers every block with the exact counts of its words too.

Defined cases: a null text is empty and so is one end token; a null id counts as an empty one when
dealing out the held-out rows; with no training rows counts are 0 and the vocabulary is empty.
Extra columns are ignored; repeated rows count as often as they stand.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _bytes, _exchange
from tidemark.llm._tables import materialise, pieces

END = np.uint64(0x5BD1E9955BD1E995)
WORDS, PAIRS = 0, 1
BITS = {WORDS: 64, PAIRS: 48}
PROBES = 4
LEVELS = 40
_ADD = 0.1
#: Pieces of text of the exchange's size that a block and a range of a kind stand for.
BLOCK_PIECES = 2
RANGE_PIECES = {WORDS: 16, PAIRS: 4}
#: Bytes of text that are hashed at once, and tokens that are sorted at once, alone and with their places: as caches like it.
CHUNK, MOST_TOKENS, MOST_PLACES = 1 << 17, 1 << 21, 1 << 19

_MERGED = "kind int, p int, block long, payload binary, bits long, total long, known long"
_MERGED_ARROW = pa.schema([("kind", pa.int32()), ("p", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()), ("bits", pa.int64()), ("total", pa.int64()), ("known", pa.int64())])
_LEVELS = "kind int, p int, block long, payload binary"
_LEVELS_ARROW = pa.schema([("kind", pa.int32()), ("p", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])


def tokens(chunk: _bytes.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of each token of a chunk, each row's end included, and the token before it."""
    hashes, rows = _bytes.words(chunk)
    edges = np.searchsorted(rows, np.arange(len(chunk)), side="right")
    hashes = np.insert(hashes, edges, END)
    rows = np.insert(rows, edges, np.arange(len(chunk)))
    return hashes, rows, np.concatenate(([END], hashes[:-1])).astype(np.uint64)


def pair_keys(before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return _exchange.trimmed(_bytes.mix64(before * np.uint64(0x9E3779B97F4A7C15) + hashes), BITS[PAIRS])


def level(counts: np.ndarray) -> np.ndarray:
    """1 for 1, 2 for 2 and 3, 3 for 4 to 7, and so on; 0 for 0."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


def count_of(levels: np.ndarray) -> np.ndarray:
    """A count for each level: the geometric middle of its range."""
    return np.where(levels > 1, math.sqrt(2) * 2.0 ** (levels - 1), levels)


def _hash_pair(keys: np.ndarray, kind: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    x = _bytes.mix64(keys + np.uint64((2 * j + kind + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)


def _bit_place(low: np.ndarray, high: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The bit of a slice that probe i of each key looks at."""
    return ((low + np.uint64(i) * high) % np.uint64(bits)).view(np.int64)


def build_slice(keys: np.ndarray, counts: np.ndarray, kind: int, bits_per_entry: int) -> "Slice":
    """The slice of the filter that holds these keys, each once for every level up to its own."""
    levels = level(counts)
    bits = max(64, int(levels.sum()) * bits_per_entry // 8 * 8)
    flags = np.zeros(bits, dtype=bool)
    for j in range(1, int(levels.max(initial=0)) + 1):
        low, high = _hash_pair(keys[levels >= j], kind, j)
        for i in range(PROBES):
            flags[_bit_place(low, high, i, bits)] = True
    return Slice(np.packbits(flags, bitorder="little"), kind, bits)


@dataclass
class Slice:
    flags: np.ndarray  # bytes
    kind: int
    bits: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level that each key reaches, by probing one after the other; 0 if it is unknown."""
        out = np.zeros(len(keys), dtype=np.int64)
        left = np.arange(len(keys))
        for j in range(1, LEVELS):
            if not len(left):
                break
            low, high = _hash_pair(keys[left], self.kind, j)
            for i in range(PROBES):  # most of those that this level lacks fail the first
                place = _bit_place(low, high, i, self.bits)
                held = ((self.flags[place >> 3] >> (place & 7).astype(np.uint8)) & 1).view(bool)
                low, high, left = low[held], high[held], left[held]
            out[left] = j
        return out


def _parts(table: pa.Table, most: int = MOST_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words and pairs of a block's tokens, and the number of tokens of each row; some rows at once."""
    held, size = [], 0
    for chunk in _bytes.chunks(table["text"], CHUNK):
        hashes, rows, before = tokens(chunk)
        held.append((hashes, pair_keys(before, hashes), np.bincount(rows, minlength=len(chunk))))
        size += len(hashes)
        if size >= most:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each stands."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1])))
    return keys[first], np.diff(first, append=len(keys))


def _coded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and for each place which of them stands there."""
    by = np.argsort(keys)
    keys = keys[by]
    first = np.concatenate((np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1]))
    codes = np.empty(len(keys), dtype=np.int32)
    codes[by] = np.cumsum(first, dtype=np.int32) - 1
    return keys[first], codes


def _counts(many: dict[int, int]):
    """A block's requests: all its words, whose exact counts it wants back, and its training pairs."""

    def run(table: pa.Table) -> pa.Table:
        trained, row = np.array(table["train"].to_pylist(), dtype=np.int64) > 0, 0
        tallies = {WORDS: _exchange.Tally(), PAIRS: _exchange.Tally()}
        for words, pairs, sizes in _parts(table):
            once = np.repeat(trained[row : row + len(sizes)], sizes)
            row += len(sizes)
            for kind, keys in ((WORDS, words), (PAIRS, pairs)):
                tallies[kind].add_distinct(*_runs(keys[once]))
            asked, _ = _runs(words[~once])
            tallies[WORDS].add_distinct(asked, np.zeros(len(asked), dtype=np.int64))
        return _requests(table, many, {kind: t.result() for kind, t in tallies.items()})

    return run


def _requests(table: pa.Table, many: dict[int, int], sent: dict) -> pa.Table:
    block = table["block"][0].as_py()
    return _exchange.request_table([r for kind, (keys, counts) in sent.items() if len(keys) for r in _exchange.request_rows(block, kind, keys, counts, BITS[kind], many[kind])])


def _merge(bits_per_entry: int):
    """Of one range: its slice of the filter, and for each block the counts of its words."""

    def run(table: pa.Table) -> pa.Table:
        p, kind = table["p"][0].as_py(), table["kind"][0].as_py()
        keys, totals, places = _exchange.placed(table)
        known = totals > 0  # the others are only asked about
        rows = [{"kind": kind, "p": p, "block": b, "payload": _bytes.pack_counts(totals[at])} for b, at in places] if kind == WORDS else []
        made = build_slice(keys[known], totals[known], kind, bits_per_entry)
        rows.append({"kind": kind, "p": p, "payload": made.flags.tobytes(), "bits": made.bits, "total": int(totals.sum()), "known": int(known.sum())})
        return pa.Table.from_pylist(rows, schema=_MERGED_ARROW)

    return run


def _probes(many: dict[int, int]):
    """A block's requests to the slices: the distinct words and pairs that it has to look up."""

    def run(table: pa.Table) -> pa.Table:
        tallies = {WORDS: _exchange.Tally(), PAIRS: _exchange.Tally()}
        for words, pairs, _ in _parts(table):
            tallies[WORDS].add_distinct(*_runs(words))
            tallies[PAIRS].add_distinct(*_runs(pairs))
        return _requests(table, many, {kind: (t.result()[0], None) for kind, t in tallies.items()})

    return run


def _probed(asked: pa.Table, slices: pa.Table) -> pa.Table:
    """The levels that one slice has for each block's n-grams, none without a slice. An n-gram that
    many blocks ask for is looked up once."""
    held = [Slice(np.frombuffer(x["payload"], dtype=np.uint8), x["kind"], x["bits"]) for x in slices.to_pylist()]
    sent = [_bytes.unpack(k.as_py()) for k in asked["keys"]]
    if not sent:
        return _LEVELS_ARROW.empty_table()
    keys, codes = _coded(np.concatenate(sent))
    levels = (held[0].levels(keys) if held else np.zeros(len(keys), dtype=np.int64))[codes]
    rows = [_bytes.pack_counts(x) for x in np.split(levels, np.cumsum([len(k) for k in sent])[:-1])]
    return pa.table([asked["kind"], asked["p"], asked["block"], pa.array(rows, pa.binary())], schema=_LEVELS_ARROW)


class Filter:
    """All slices, as workers get them."""

    def __init__(self, many: dict[int, int], slices: dict[tuple[int, int], "Slice"]):
        self.many, self.slices = many, slices

    def levels(self, kind: int, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        for p, part in _exchange.ranges(keys, BITS[kind], self.many[kind]):
            if (kind, p) in self.slices:
                out[part] = self.slices[kind, p].levels(keys[part])
        return out


def _score(many: dict[int, int], n: int, v: int, weight: float, sent: Broadcast | None):
    """The scores of a block's texts. right: the counts of its words, and unless the filter was sent
    the levels of its words and pairs."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [(*_coded(words), *_coded(pairs), sizes) for words, pairs, sizes in _parts(left, MOST_PLACES)]
        _bytes.give_back()
        keys, pairs = parts[0][0], parts[0][2]
        if len(parts) > 1:
            keys, pairs = (_runs(np.concatenate([x[k] for x in parts]))[0] for k in (0, 2))

        def answers(what: str, kind: int, asked: np.ndarray) -> np.ndarray:
            got = right.filter(pc.and_(pc.equal(right["kind"], kind), pc.equal(right["what"], what))).select(["p", "payload"])
            values = _exchange.answers(got, many[kind])
            if len(values) != len(asked):
                raise ValueError(f"a block of {len(asked)} n-grams got {len(values)} {what}")
            return values

        levels = (lambda kind, asked: answers("levels", kind, asked)) if sent is None else sent.value.levels
        counts = answers("counts", WORDS, keys)
        base = np.log10((counts + _ADD) / (n + _ADD * (v + 1)))
        own_count, pair_count = count_of(levels(WORDS, keys)), count_of(levels(PAIRS, pairs))
        own = np.minimum((own_count + _ADD) / (n + _ADD * (v + 1)), 1.0)
        out = []
        end = int(np.searchsorted(keys, END))
        for own_keys, word_codes, own_pairs, pair_codes, sizes in parts:
            at = np.searchsorted(keys, own_keys)[word_codes]
            prior = np.concatenate(([end], at[:-1]))  # a row's last token is the end
            both = pair_count[np.searchsorted(pairs, own_pairs)][pair_codes]
            rows = np.repeat(np.arange(len(sizes)), sizes)
            ahead = own_count[prior]
            probability = np.where(ahead > 0, weight * np.minimum(both / np.maximum(ahead, 1), 1.0) + (1 - weight) * own[at], own[at])
            size = len(sizes)
            out.append((sizes, np.bincount(rows, counts[at] > 0, minlength=size), np.bincount(rows, base[at], minlength=size), np.bincount(rows, np.log10(probability), minlength=size)))
        _bytes.give_back()
        tokens_, known, base_, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": tokens_.astype(np.int64), "n_known": known.astype(np.int64), "train_tokens": np.full(len(tokens_), n, dtype=np.int64), "base_score": base_, "score": score})

    return run


def score(df: DataFrame, held_out, key: str = "doc_id", text: str = "text", bits_per_entry: int = 10, pair_weight: float = 0.4, most_broadcast: int = 256 << 20) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a Column: rows for which it holds are scored but not learned from. A broadcast of
    ``most_broadcast`` bytes is held once in each worker process and once on the driver.
    """
    _, all_pieces = _exchange.measured(df, text)
    many = {kind: pieces(all_pieces, of) for kind, of in RANGE_PIECES.items()}
    docs = df.select(_exchange.block_of(df[key], df[text], pieces(all_pieces, BLOCK_PIECES)).alias("block"), df[key].alias("doc_id"), F.coalesce(df[text], F.lit("")).alias("text"), held_out.alias("held_out")).withColumn("train", (~F.col("held_out")).cast("int"))
    asked = docs.groupBy("block").applyInArrow(_counts(many), _exchange.REQUEST)
    merged = materialise(asked.groupBy("kind", "p").applyInArrow(_merge(bits_per_entry), _MERGED), "lm-counts")
    slices = merged.filter("block IS NULL")
    sums = slices.agg(F.sum(F.when(F.col("kind") == WORDS, F.col("total"))), F.sum(F.when(F.col("kind") == WORDS, F.col("known"))), F.sum(F.length("payload"))).first()
    n, v, size = (x or 0 for x in sums)
    back = merged.filter("block IS NOT NULL").select("block", "kind", "p", F.lit("counts").alias("what"), "payload")
    sent = None
    if size <= most_broadcast:
        held = slices.select("kind", "p", "payload", "bits").collect()  # at most ``most_broadcast`` bytes
        sent = df.sparkSession.sparkContext.broadcast(Filter(many, {(r.kind, r.p): Slice(np.frombuffer(r.payload, dtype=np.uint8), r.kind, r.bits) for r in held}))
    else:
        probes = docs.groupBy("block").applyInArrow(_probes(many), _exchange.REQUEST)
        answers = probes.groupBy("kind", "p").cogroup(slices.select("kind", "p", "payload", "bits").groupBy("kind", "p")).applyInArrow(_probed, _LEVELS)
        back = back.unionByName(materialise(answers, "lm-levels").select("block", "kind", "p", F.lit("levels").alias("what"), "payload"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_score(many, n, v, pair_weight, sent), schema)
