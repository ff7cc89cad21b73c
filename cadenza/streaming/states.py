"""The newest row of each key as keyed state of a stream.

Each key's newest row lives in the state store (RocksDB, in the checkpoint), so a batch costs what its own keys cost, however large the table of states has
grown, and nothing has to be compacted.  What comes out are changes: a row whenever a key's newest row changes, and once more, marked idle, when the watermark has passed
its time by ``idle``; then the key's state goes.  A table may seed the state on the first start.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructType

_NONE = (0,)


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime().replace(tzinfo=None)
    return value.item() if hasattr(value, "item") else value


def _rank(row: tuple) -> tuple:
    """The order of a struct of the row: nulls first."""
    return tuple(_NONE if v is None else (1, v) for v in row)


def _millis(at: datetime) -> int:
    return int(at.replace(tzinfo=timezone.utc).timestamp() * 1000)


class Newest(StatefulProcessor):
    """``columns``: the time first, then the rest of the row, in the order that breaks ties."""

    def __init__(self, key: str, columns: list[str], schema: StructType, idle: timedelta | None):
        self.key, self.columns, self.schema, self.idle = key, columns, schema, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    def _frame(self, key: tuple, row: tuple, idle: bool) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *row, idle)], columns=[self.key, *self.columns, "idle"]).astype(object)

    def _keep(self, row: tuple) -> None:
        held = self.newest.get() if self.newest.exists() else None
        if self.idle is not None:
            if held is not None:
                self.handle.deleteTimer(_millis(_plain(held[0]) + self.idle))
            self.handle.registerTimer(_millis(row[0] + self.idle))
        self.newest.update(row)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = before = tuple(map(_plain, self.newest.get())) if self.newest.exists() else None
        for frame in rows:
            for row in frame[self.columns].itertuples(index=False):
                row = tuple(map(_plain, row))
                if row[0] is not None and (best is None or _rank(row) > _rank(best)):
                    best = row
        if best is not None and best != before:
            self._keep(best)
            yield self._frame(key, best, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            row = tuple(map(_plain, self.newest.get()))
            self.newest.clear()
            yield self._frame(key, row, True)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        rows = [tuple(map(_plain, r)) for r in initialState[self.columns].itertuples(index=False)]
        rows = [r for r in rows if r[0] is not None]
        if rows:
            self._keep(max(rows, key=_rank))

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, key: str, at: str, late: str, idle: timedelta | None = None, seed: DataFrame | None = None) -> DataFrame:
    """Changes of the newest row of each key by (``at``, then the rest of the row): the columns of ``stream`` with ``idle``.

    ``late`` bounds how late rows may come: rows behind the watermark are left out, which changes nothing for a key with newer ones.  Rows without a time or key are left out.  ``seed``: rows
    of the same columns from before the stream began.  The session's state store must be RocksDB (``rocksdb`` sets it).  Write in update mode."""
    rest = [c for c in stream.columns if c not in (key, at)]
    state = StructType([stream.schema[c] for c in (at, *rest)])
    out = StructType([stream.schema[c] for c in (key, at, *rest)]).add("idle", BooleanType())
    rows = stream.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withWatermark(at, late)
    started = None if seed is None else seed.where(F.col(key).isNotNull()).select(*stream.columns).groupBy(key)
    made = rows.groupBy(key).transformWithStateInPandas(Newest(key, [at, *rest], state, idle), out, "Update", "EventTime", started)
    return made.select(*stream.columns, "idle")


def rocksdb(spark) -> None:
    """Keyed state needs a store that can hold several variables a key."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
