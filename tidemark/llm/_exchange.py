"""Corpus-wide counts of hashed features, by an exchange of packed blocks.

A corpus has too many words or shingles for a row each. Instead every block of documents sends,
for each range of the hash space, one packed row with its distinct features and their counts. A
range adds up what all blocks sent, and answers each block with the totals of the features the
block asked about, in the block's own order. A feature that is in every document costs a range one
entry a block, so no key is hot.

A block and a range stand for about ``BLOCK`` bytes of text whatever the input and the number of
shuffle partitions, so a task holds one small block at a time and more input means more of them.
A range without features of a block gets no row from it: there are never more rows than features.

Features are told apart by ``bits`` of their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _bytes
from tidemark.llm._tables import pieces

#: Bytes of text of a block and of a range.
BLOCK = 4 << 20

REQUEST = "p int, kind int, block long, keys binary, counts binary"
_REQUEST = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def measured(df: DataFrame, text: str, block: int = BLOCK) -> tuple[int, int]:
    """Number of rows, and of the blocks and ranges for their texts."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(df[text]).cast("long")), F.lit(0))).first()
    return rows, pieces(size, block)


def block_of(key: Column, text: Column, many: int) -> Column:
    return F.pmod(F.xxhash64(key, text), F.lit(many).cast("long"))


def trimmed(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their counts."""
    by = np.argsort(keys, kind="stable" if counts.dtype.kind == "f" else None)  # sums of fractions keep their order
    keys, counts = keys[by], counts[by]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


class Tally:
    """Adds up keys chunk by chunk, so that a block never holds more than its distinct keys."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.add_distinct(*summed(keys, counts))

    def add_distinct(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Keys that are distinct and in order already."""
        self.parts.append((keys, counts))
        self.size += len(self.parts[-1][0])
        if len(self.parts) > 1 and self.size > 2 * len(self.parts[0][0]) + (1 << 20):
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        if len(self.parts) > 1:
            self.parts = [summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))]
        self.size = len(self.parts[0][0])
        return self.parts[0]


def ranges(keys: np.ndarray, bits: int, many: int) -> Iterator[tuple[int, slice]]:
    """The non-empty ranges that sorted keys fall in."""
    p = ((keys >> np.uint64(bits - 32)) * np.uint64(many)) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate((np.ones(min(len(p), 1), dtype=bool), p[1:] != p[:-1])))
    for a, b in zip(edges, np.append(edges[1:], len(p)), strict=True):
        yield int(p[a]), slice(a, b)


def request_rows(block: int, kind: int, keys: np.ndarray, counts: np.ndarray | None, bits: int, many: int) -> list[dict]:
    return [{"p": p, "kind": kind, "block": block, "keys": _bytes.pack(keys[s]), "counts": None if counts is None else _bytes.pack_counts(counts[s])} for p, s in ranges(keys, bits, many)]


def request_table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_REQUEST)


def placed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """Of one range and kind: its distinct keys, their totals, and for each block where the keys
    that it sent stand among them, in order."""
    sent = [(b.as_py(), _bytes.unpack(k.as_py()), _bytes.unpack_counts(c.as_py())) for b, k, c in zip(table["block"], table["keys"], table["counts"], strict=True)]
    keys, totals = summed(np.concatenate([k for _, k, _ in sent]), np.concatenate([c.astype(np.int64) for _, _, c in sent]))
    return keys, totals, ((b, np.searchsorted(keys, k)) for b, k, _ in sent)


def merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Of one range and kind: its distinct keys, their totals, and for each block the totals of
    the keys that it sent, in order."""
    keys, totals, places = placed(table)
    return keys, totals, [(b, totals[at]) for b, at in places]


def answers(table: pa.Table, many: int) -> np.ndarray:
    """The totals that a block got back, in the order of its keys. table: p, payload."""
    got = sorted(zip(table["p"].to_pylist(), table["payload"].to_pylist(), strict=True))
    return np.concatenate([_bytes.unpack_counts(x) for _, x in got]).astype(np.int64) if got else np.zeros(0, dtype=np.int64)
