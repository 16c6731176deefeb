"""Small results of repeated queries, kept for a while."""

from __future__ import annotations

import threading
import time
from collections import OrderedDict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed value: seconds that a result is good for.
SECONDS = 300.0


class ResultTooLarge(ValueError):
    """A result has more rows than may be shown; limit the query."""


class ResultCache:
    """Results by what their plans mean: two frames that Spark knows to give the same share one, however
    they were written. A published table lies under a path of its version, so a new version is
    another plan. Nothing larger than ``most_rows`` is fetched at all; results beyond ``most_bytes``
    together push out those that were not asked for the longest."""

    def __init__(self, seconds: float = SECONDS, most_rows: int = 10_000, most_bytes: int = 64 << 20, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.most_rows, self.most_bytes, self.clock = seconds, most_rows, most_bytes, clock
        self.fetched = 0
        self._kept: OrderedDict[tuple, tuple[float, DataFrame, pa.Table]] = OrderedDict()
        self._lock = threading.Lock()

    def fetch(self, df: DataFrame) -> pa.Table:
        key = (df.semanticHash(), df.schema.json())
        with self._lock:
            held = self._kept.get(key)
            if held and held[0] > self.clock() and held[1].sameSemantics(df):
                self._kept.move_to_end(key)
                return held[2]
        table = df.limit(self.most_rows + 1).toArrow()
        if table.num_rows > self.most_rows:
            raise ResultTooLarge(f"more than {self.most_rows} rows")
        with self._lock:
            self.fetched += 1
            self._kept[key] = (self.clock() + self.seconds, df, table)
            self._kept.move_to_end(key)
            self._shrink()
        return table

    def _shrink(self) -> None:
        now = self.clock()
        for key in [k for k, (until, _, _) in self._kept.items() if until <= now]:
            del self._kept[key]
        while self._kept and sum(t.nbytes for _, _, t in self._kept.values()) > self.most_bytes:
            self._kept.popitem(last=False)

    def __len__(self) -> int:
        return len(self._kept)
