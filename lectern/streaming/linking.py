"""Greedy linking of a stream: a record that matches nothing becomes something to match."""

from __future__ import annotations

import contextlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lectern.functions import text as X
from lectern.functions.udfs import ratio, ratio_from

_STATE = "ords array<long>, keys array<string>, years array<int>"


def _near(year: int | None, other: int | None, tolerance: int) -> bool:
    return year is None or other is None or abs(year - other) <= tolerance


#: Columns that letters are counted in: a to z, 0 to 9, and what all others share.
LETTERS = 40


def _letters(key: str) -> np.ndarray:
    codes = np.frombuffer(key.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    at = np.where((codes >= 97) & (codes <= 122), codes - 97, np.where((codes >= 48) & (codes <= 57), codes - 22, 36 + codes % 4))
    return np.bincount(at, minlength=LETTERS).astype(np.int32)


class _Taken:
    """A block's accepted records, in order, found by key, and by length and letters: a record meets those only that have enough
    letters in common with it, which is told for many at once."""

    def __init__(self, least: float, tolerance: int):
        self.least, self.tolerance = least, tolerance
        # of two strings that can be alike, the longer is at most so many times as long
        self.step = math.log(1.001 * (2 - least) / max(least, 1e-3))
        self.rows: list[tuple[int, str, int | None]] = []
        self.by_key: dict[str, list[int]] = {}
        self.bands: dict[int, tuple[list[int], np.ndarray]] = {}

    def add(self, ord_: int, key: str, year: int | None) -> None:
        place = len(self.rows)
        self.rows.append((ord_, key, year))
        self.by_key.setdefault(key, []).append(place)
        if self.least >= 1:
            return
        places, counts = self.bands.get(band := self._band(key), ([], np.zeros((4, LETTERS), dtype=np.int32)))
        if len(places) == len(counts):
            counts = np.concatenate([counts, np.zeros_like(counts)])
        counts[len(places)] = _letters(key)
        places.append(place)
        self.bands[band] = places, counts

    def _band(self, key: str) -> int:
        return int(math.log(len(key)) / self.step)

    def _fits(self, place: int, year: int | None) -> bool:
        return _near(year, self.rows[place][2], self.tolerance)

    def best(self, key: str, year: int | None) -> int | None:
        """The earliest accepted record that the key matches, those with equal keys first. Years must not be known to be apart."""
        equal = next((p for p in self.by_key.get(key, ()) if self._fits(p, year)), None)
        if equal is not None or self.least >= 1:
            return None if equal is None else self.rows[equal][0]
        own, n, near = _letters(key), len(key), []
        for band in range(self._band(key) - 1, self._band(key) + 2):
            places, counts = self.bands.get(band, ((), None))
            if places:
                there = counts[: len(places)]
                alike = 2 * np.minimum(there, own).sum(axis=1) >= self.least * (n + there.sum(axis=1)) * (1 - 1e-9)
                near += [places[i] for i in alike.nonzero()[0]]
        found = (p for p in sorted(near) if self._fits(p, year) and ratio_from(self.least, key, self.rows[p][1]) is not None)
        return next((self.rows[p][0] for p in found), None)


def online_links(records: DataFrame, least: float = 0.9, tolerance: int = 3) -> DataFrame:
    """(ord, match) of each record of a stream (ord, author, title, year int) as it arrives: the accepted record that it is a copy
    of, else null, and then it is accepted itself. Records are matched within a block (surname and first title word).

    Within a micro-batch records are taken by ord, so what is found depends on the order of arrival, as it must. A record with no
    title key is accepted and never matched. The state is a block's accepted records: their number, title key and year.
    """
    key = X.title_key(F.coalesce("title", F.lit("")))
    keyed = records.select("ord", key.alias("key"), F.col("year").cast("int").alias("year"), X.surname(F.col("author")).alias("_sur"))
    blocked = keyed.withColumn("block", F.concat_ws("|", "_sur", F.substring_index("key", " ", 1))).drop("_sur")

    def step(block: Any, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ords, keys, years = state.get if state.exists else ([], [], [])
        taken = _Taken(least, tolerance)
        for accepted in zip(ords, keys, years, strict=True):
            taken.add(*accepted)
        out = []
        for row in pd.concat(list(batches)).sort_values("ord").itertuples():
            year = None if pd.isna(row.year) else int(row.year)
            match = taken.best(row.key, year) if row.key else None
            if match is None and row.key:
                taken.add(int(row.ord), row.key, year)
            out.append((int(row.ord), match))
        state.update(tuple(list(column) for column in zip(*taken.rows, strict=True)) if taken.rows else ([], [], []))
        yield pd.DataFrame({"ord": [o for o, _ in out], "match": pd.array([m for _, m in out], dtype="Int64")})

    return blocked.groupBy("block").applyInPandasWithState(step, "ord long, match long", _STATE, "append", GroupStateTimeout.NoTimeout)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class Accepted(StatefulProcessor):
    """A block's accepted records as keyed state: by title key their numbers and years, and the keys by length. A record reads the
    entry of its own key, and only if that has no match the keys of lengths that can be alike; what is not accepted again within
    the time to live goes by itself."""

    def __init__(self, least: float, tolerance: int, ttl_ms: int | None):
        self.least, self.tolerance, self.ttl = least, tolerance, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.by_key = handle.getMapState("by_key", "key string", "ords array<long>, years array<int>", self.ttl)
        self.by_length = handle.getMapState("by_length", "n int", "keys array<string>", self.ttl)

    def _first(self, key: str, year: int | None) -> int | None:
        if not self.by_key.containsKey((key,)):
            return None
        ords, years = self.by_key.getValue((key,))
        return next((o for o, y in zip(ords, years, strict=True) if _near(year, y, self.tolerance)), None)

    def _alike(self, key: str, year: int | None) -> int | None:
        n, letters, found = len(key), Counter(key), []
        for m in range(int(n * self.least / (2 - self.least)), int(n * (2 - self.least) / self.least) + 2):
            if 2 * min(n, m) >= self.least * (n + m) and self.by_length.containsKey((m,)):
                for other in self.by_length.getValue((m,))[0]:
                    # common letters bound the ratio
                    if other != key and 2 * (letters & Counter(other)).total() >= self.least * (n + m) and ratio(key, other) >= self.least:
                        found.append(self._first(other, year))
        return min((o for o in found if o is not None), default=None)

    def _accept(self, ord_: int, key: str, year: int | None) -> None:
        ords, years = self.by_key.getValue((key,)) if self.by_key.containsKey((key,)) else ([], [])
        self.by_key.updateValue((key,), ([*ords, ord_], [*years, year]))
        keys = self.by_length.getValue((len(key),))[0] if self.by_length.containsKey((len(key),)) else []
        # written again even where it is known: its time starts anew, as the record's does
        self.by_length.updateValue((len(key),), (list(dict.fromkeys([*keys, key])),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        for row in pd.concat(list(rows)).sort_values("ord").itertuples():
            year = None if pd.isna(row.year) else int(row.year)
            match = None
            if row.key:
                match = self._first(row.key, year)
                match = self._alike(row.key, year) if match is None and self.least < 1 else match
                if match is None:
                    self._accept(int(row.ord), row.key, year)
            out.append((int(row.ord), match))
        yield pd.DataFrame({"ord": [o for o, _ in out], "match": pd.array([m for _, m in out], dtype="Int64")})

    def close(self) -> None:
        pass


def keyed_links(records: DataFrame, least: float = 0.9, tolerance: int = 3, ttl_ms: int | None = None) -> DataFrame:
    """As online_links, with keyed state in place of one list for each block: a record is compared with the titles that can be
    alike only, and an accepted one is forgotten after ttl_ms of processing time (null: never), so that state is bounded by what
    arrives in that time. Start the stream inside keyed_state(spark)."""
    key = X.title_key(F.coalesce("title", F.lit("")))
    keyed = records.select("ord", key.alias("key"), F.col("year").cast("int").alias("year"), X.surname(F.col("author")).alias("_sur"))
    blocked = keyed.withColumn("block", F.concat_ws("|", "_sur", F.substring_index("key", " ", 1))).drop("_sur")
    mode = "none" if ttl_ms is None else "processingTime"
    return blocked.groupBy("block").transformWithStateInPandas(Accepted(least, tolerance, ttl_ms), "ord long, match long", "append", mode)
