"""Operator 8: best-fit packing with large-item matching.

Documents become token ids; ids longer than a sequence are cut into full pieces and a rest. Which
pieces share a sequence depends on their lengths alone, so the plan is made from the histogram of
lengths, at most ``capacity`` numbers however large the corpus is: pieces above a third of the
capacity are matched at most two a bin, the longest first, each with the longest partner that
fits; smaller ones then go, longest first, into the tightest gap that takes them. Equal bins are
handled as one class with a multiplicity, so the plan's size is bounded by the capacity too.
Pieces take the planned places by their rank within their length, a rank that is counted per
bucket so that no length is ever sorted in one task.

Tokenizing is the cost, and words repeat: each distinct word of a batch is encoded once. Words are
cut where the tokenizer's own splitting always cuts (white space, and between an ASCII letter and
ASCII punctuation other than an apostrophe); texts that may hold special tokens are encoded whole.

Defined cases: null text is empty, so its document is the single end id; repeated rows and null
ids are packed as rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import _bytes
from tidemark.llm._tables import materialise

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in '!"#$%&()*+,-./:;<=>?@[]^_`{|}~']] = True

#: Words that lower-casing, composing and splitting leave as they are, lower-case letters of
#: ASCII and Latin-1; what the model calls the bytes of the latter; words that hold each of them.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_NAMES = {b: chr(b) for b in [*range(0xA1, 0xAD), *range(0xAE, 0x100)]} | {0x9F: "\u0141", 0xA0: "\u0142", 0xAD: "\u0143"}
_AS_BYTES = {p: "".join(_NAMES[b] for b in chr(p).encode()) for p in [*range(0xDF, 0xF7), *range(0xF8, 0x100)]}
_PROBES = ["words", "abcdefghijklm", "nopqrstuvwxyz", "anßt", *(f"ca{chr(p)}e" for p in _AS_BYTES)]

_SPREAD = 1 << 40
_PACKED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row_key long"


class WordEncoder:
    """Encodes texts as the tokenizer does, each distinct word once for as long as it is remembered.

    ``most_words`` bounds the memory of words; beyond it they are forgotten and encoded anew.
    """

    def __init__(self, vocabulary: str, most_words: int = 1_000_000):
        # one thread: Spark has given the other cores to other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.most_words = most_words
        self._forget()
        whole = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in _PROBES]
        alone = [[t.id for t in self.tokenizer.model.tokenize(w.translate(_AS_BYTES))] for w in _PROBES]
        # a vocabulary that treats letters otherwise gets all words through its own steps
        self.letters = _LETTERS.fullmatch if whole == alone else lambda word: None
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, texts: list[str], at_once: int = 2048) -> list[np.ndarray]:
        """Few at once: an encoding takes many times the memory of its ids."""
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        out: list[np.ndarray] = []
        for k in range(0, len(texts), at_once):
            out += [np.array(e.ids, dtype=np.uint32) for e in run(texts[k : k + at_once], add_special_tokens=False)]
        return out

    def _encode_words(self, words: list[str], at_once: int = 2048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many ids each word has, where they begin, and the ids of all. Words of plain letters go to the model as they
        are. Others share an encoding, which tells the word of each id: made apart, the encodings would
        cost as much as the merges."""
        sizes, flat = np.zeros(len(words), dtype=np.int64), []
        plain = [bool(self.letters(w)) for w in words]
        order = [k for k, p in enumerate(plain) if p]
        merge = self.tokenizer.model.tokenize
        for k in order:
            ids = [t.id for t in merge(words[k].translate(_AS_BYTES))]
            sizes[k] = len(ids)
            flat += ids
        others = np.flatnonzero(~np.array(plain, dtype=bool))
        for k in range(0, len(others), at_once):
            some = others[k : k + at_once]
            e = self.tokenizer.encode([words[i] for i in some], is_pretokenized=True, add_special_tokens=False)
            sizes[some] = np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(some))
            flat += e.ids
        made = np.concatenate((np.array(order, dtype=np.int64), others))  # the order in which the ids were made
        at = np.empty(len(words), dtype=np.int64)
        at[made] = np.cumsum(sizes[made]) - sizes[made]
        return sizes, at, np.array(flat, dtype=np.uint32)

    def _forget(self) -> None:
        self.hashes, self.order = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.sizes, self.at, self.flat = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def _known(self, found: np.ndarray, texts) -> np.ndarray:
        """The place of each word's ids; those not seen yet are encoded. texts: the words at given indices."""
        if len(self.hashes) > self.most_words:
            self._forget()
        by = np.argsort(found)
        found = found[by]
        at = np.searchsorted(self.hashes, found)
        new = np.ones(len(found), dtype=bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != found[inside]
        if new.any():
            sizes, starts, flat = self._encode_words(texts(by[new]))
            self.hashes = np.insert(self.hashes, at[new], found[new])
            self.order = np.insert(self.order, at[new], len(self.sizes) + np.arange(len(sizes)))
            self.at = np.concatenate((self.at, len(self.flat) + starts))
            self.sizes, self.flat = np.concatenate((self.sizes, sizes)), np.concatenate((self.flat, flat))
        places = np.empty(len(found), dtype=np.int64)
        places[by] = self.order[at + np.cumsum(new) - new]  # new words before one have moved it on
        return places

    def rows(self, chunk: _bytes.Chunk) -> list[np.ndarray]:
        """The ids of each row."""
        raw = chunk.data.tobytes()
        if any(s[:2] in raw and s in raw for s in self.specials):
            texts = [raw[a:b].decode() for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)]
            return self._encode(texts)
        data = _bytes.LOWER[chunk.data]
        cut = np.zeros(len(data), dtype=bool)
        letter, mark = _LETTER[data], _MARK[data]
        cut[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        starts, ends, rows = _bytes.word_bounds(_bytes.Chunk(chunk.first, data, chunk.offsets), cut)
        if not len(starts):
            return [np.zeros(0, dtype=np.uint32)] * len(chunk)
        found, first, which = _bytes.distinct(_bytes.span_hashes(data, starts, ends))
        low = data.tobytes()
        places = self._known(found, lambda i: [low[a:b].decode() for a, b in zip(starts[first[i]].tolist(), ends[first[i]].tolist(), strict=True)])
        which = places[which]
        sizes, at, flat = self.sizes, self.at, self.flat
        each = sizes[which]
        total = np.concatenate(([0], np.cumsum(each)))
        ids = flat[np.repeat(at[which] - total[:-1], each) + np.arange(total[-1])]
        of_row = np.searchsorted(rows, np.arange(len(chunk) + 1), side="left")
        return np.split(ids, total[of_row[1:-1]])


def _pieces(vocabulary: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocabulary)  # its memory of words lasts for the task
        for batch in batches:
            keys, marks = batch.column(0), batch.column(2)
            for chunk in _bytes.chunks(batch.column(1), 1 << 19):
                out: list[tuple] = []
                for row, ids in enumerate(encoder.rows(chunk)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((chunk.first + row, piece, start, len(part), zlib.crc32(part.tobytes())))
                row, piece, start, length, crc = map(np.array, zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), marks.take(pa.array(row))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "row_key"],
                )

    return run


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Bins for ``histogram`` (length -> pieces) as (how many, lengths in order)."""
    left = {n: k for n, k in histogram.items() if k}
    large = sorted(n for n in left if 3 * n > capacity)
    open_bins: dict[int, list[list]] = {}  # gap -> [how many, lengths]

    def opened(many: int, lengths: tuple[int, ...]) -> None:
        gap = capacity - sum(lengths)
        if gap not in open_bins:
            open_bins[gap] = []
            insort(gaps, gap)
        open_bins[gap].append([many, lengths])

    gaps: list[int] = []
    while large:
        n = large[-1]
        at = bisect_left(large, capacity - n + 1) - 1
        if at < 0:
            opened(left.pop(n), (n,))
            large.pop()
            continue
        partner = large[at]
        many = left[n] // 2 if partner == n else min(left[n], left[partner])
        if many:
            opened(many, (n, partner))
            for x in (n, partner):
                left[x] -= many
        else:  # one is left of a length that pairs only with itself or shorter ones
            at -= 1
            if at >= 0:
                opened(1, (n, large[at]))
                left[large[at]] -= 1
            else:
                opened(1, (n,))
            left[n] -= 1
        large = [x for x in large if left[x]]
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        many = left[n]
        while many:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                full = capacity // n
                if many >= full:
                    opened(many // full, (n,) * full)
                    many %= full
                else:
                    opened(1, (n,) * many)
                    many = 0
                continue
            gap = gaps[at]
            kind = open_bins[gap][-1]
            take = min(many, kind[0])
            kind[0] -= take
            if not kind[0]:
                open_bins[gap].pop()
                if not open_bins[gap]:
                    del open_bins[gap], gaps[at]
            opened(take, (*kind[1], n))
            many -= take
    return [(many, lengths) for kinds in open_bins.values() for many, lengths in kinds]


def _places(bins: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int]]:
    """Runs of places: length, first rank, first sequence, offset."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for many, lengths in bins:
        offset = 0
        for n in lengths:
            first = used.get(n, 0)
            runs.append((n, first, sequence, offset))
            used[n] = first + many
            offset += n
        sequence += many
    return runs


def _placed(runs, capacity: int):
    """Give ranked pieces their sequence and offset; runs: a broadcast of sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts, sequences, offsets = runs.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * _SPREAD + rank, side="right") - 1
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequences[at] + rank - firsts[at]), pa.array(offsets[at])], names=_PACKED)

    return run


def pack(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, bucket_rows: int = 4096) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = df.sparkSession
    source = df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text"), F.xxhash64(df[key], df[text]).alias("row_key"))
    pieces = materialise(source.mapInArrow(_pieces(vocabulary, capacity, end_id), PIECES), "pieces")
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in lengths.collect()}  # at most `capacity` rows, whatever the input
    runs = np.array(sorted(_places(plan_bins(histogram, capacity))), dtype=np.int64).reshape(-1, 4).T
    shared = spark.sparkContext.broadcast((runs[0] * _SPREAD + runs[1], runs[1], runs[2], runs[3]))
    # a piece's rank within its length: its bucket starts after the rows of the buckets before it
    cuts = spark.createDataFrame([(n, -(-k // bucket_rows)) for n, k in histogram.items()], "length long, buckets long")
    marked = pieces.join(F.broadcast(cuts), "length").withColumn("bucket", F.pmod(F.xxhash64("row_key", "piece"), F.col("buckets")))
    counts = marked.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("row_key", "doc_id", "piece")
    ranked = marked.withColumn("nth", F.row_number().over(order) - 1).join(starts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_placed(shared, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
