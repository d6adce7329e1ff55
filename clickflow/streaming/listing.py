"""The dynamic blacklist with its state in Structured Streaming's state store.

One state per user: the clicks so far of each (day, ad), and whether the user is listed. No watermark, so no
click is ever late; no table of listed users is read back in a batch; a restart goes on from the checkpoint.
The day counts of a user who gets listed are dropped; with ``keep``, those of others expire that long after
their last click by the cluster's clock (not by event time: a replay of an old log loses nothing). A query
with ``keep`` works by the clock, so it wants a processing-time trigger: ``availableNow`` never ends it.

Each call to the state store is a message between the Python worker and its JVM, so a user's counts lie there by
month: a batch reads and writes a user's months that it has clicks in, not each (day, ad), and what it writes is
bounded by the days and ads of a month however long the stream runs. Rows reach the processor as rows: a
data frame per user costs more than the user's clicks.

A user is one state key, handled by one task of a batch: a hot user costs that task the user's clicks of the
one batch, which the intake bounds (``maxFilesPerTrigger``). Clicks that cannot pass any more are let go while the
others are read, so the task holds at most about twice ``threshold`` clicks of each of the user's (day, ad) and
two CLICKS_AT_ONCE; a listed user's clicks are only counted off.

State of this kind needs the RocksDB provider (``STATE_STORE``), set before the query starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ads import BLACKLIST_THRESHOLD
from ..session import workers_import

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
ADMITTED = "event_id bigint, date string, adid string, userid string, lists_user boolean"


CLICKS_AT_ONCE = 10_000


class Listing(StatefulProcessor):
    """Passes a user's clicks, in (ts, event_id) order within a batch, up to the one that makes ``threshold``
    on one (day, ad); that one is marked ``lists_user``."""

    def __init__(self, threshold: int, keep_ms: int | None):
        self.threshold, self.keep_ms = threshold, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState(
            "counts", "month string", "dates array<string>, adids array<string>, clicks array<bigint>, seen array<bigint>",
            self.keep_ms)
        self.listed = handle.getValueState("listed", "event_id bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.listed.exists():
            for _ in rows:
                pass
            return
        now = 0 if self.keep_ms is None else timerValues.getCurrentProcessingTimeInMs()
        stored: dict[str, dict[tuple, tuple[int, int]]] = {}
        clicks, totals, crossed = [], {}, False
        while block := [self._click(row) for row in islice(rows, max(CLICKS_AT_ONCE, len(clicks)))]:
            clicks, totals, crossed = self._passing(clicks + block, stored, now)
        if crossed:
            self.listed.update((clicks[-1][3],))
            self.counts.clear()
        else:
            self._store(stored, totals, now)
        for at, (*_, event_id, date, adid) in enumerate(clicks, 1):
            yield Row(event_id=event_id, date=date, adid=adid, userid=key[0], lists_user=crossed and at == len(clicks))

    @staticmethod
    def _click(row: Row) -> tuple:
        """A click with its place in front: by time, then by id, a null id last."""
        return row.at, row.event_id is None, row.event_id or 0, row.event_id, row.date, row.adid

    def _passing(self, clicks: list[tuple], stored: dict, now: int) -> tuple[list[tuple], dict, bool]:
        """The clicks up to the one that makes ``threshold``, in order, the totals there, and whether there is
        one. More clicks can only move it forward, so those behind it never pass."""
        clicks.sort(key=lambda click: click[:3])
        totals: dict[tuple, int] = {}
        for at, (*_, date, adid) in enumerate(clicks, 1):
            cell = date, adid
            totals[cell] = (totals[cell] if cell in totals else self._before(cell, stored, now)) + 1
            if totals[cell] >= self.threshold:
                return clicks[:at], totals, True
        return clicks, totals, False

    def _before(self, cell: tuple, stored: dict, now: int) -> int:
        """Clicks of earlier batches on a (day, ad); its month is read once a batch."""
        month = self._month(cell)
        if month not in stored:
            found = self.counts.getValue((month,)) if self.counts.containsKey((month,)) else ([], [], [], [])
            stored[month] = {(date, adid): (n, seen) for date, adid, n, seen in zip(*found)
                             if self.keep_ms is None or seen + self.keep_ms > now}
        return stored[month].get(cell, (0, 0))[0]

    def _store(self, stored: dict, totals: dict, now: int) -> None:
        for cell, n in totals.items():
            stored[self._month(cell)][cell] = n, now
        for month, cells in stored.items():
            self.counts.updateValue((month,), (
                [date for date, _ in cells], [adid for _, adid in cells],
                [n for n, _ in cells.values()], [seen for _, seen in cells.values()]))

    @staticmethod
    def _month(cell: tuple) -> str:
        return (cell[0] or "")[:7]

    def close(self) -> None:
        pass


def admitted(parsed: DataFrame, threshold: int = BLACKLIST_THRESHOLD, keep: pd.Timedelta | None = None) -> DataFrame:
    """Stream of the clicks that the blacklist lets pass (``ADMITTED``), decided per event as the batch
    :func:`~clickflow.operators.ads.ad_blacklist_filter`, and equal to it where batches arrive in event order.
    In any order the listed users are those of :func:`~clickflow.operators.ads.ad_blacklist`, as long as no
    (day, ad) count of theirs expires in between."""
    workers_import(parsed.sparkSession)
    keep_ms = None if keep is None else int(keep.total_seconds() * 1000)
    return (parsed.select("event_id", F.unix_micros("ts").alias("at"), "date", "adid", "userid").groupBy("userid")
            .transformWithState(statefulProcessor=Listing(int(threshold), keep_ms), outputStructType=ADMITTED,
                                        outputMode="Append", timeMode="None" if keep is None else "ProcessingTime"))


def listed_users(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(userid, event_id): the list, and the click that listed each user, read from the state store of a
    finished query over :func:`admitted`."""
    state = spark.read.format("statestore").option("stateVarName", "listed").load(checkpoint)
    return state.select(F.col("key.userid").alias("userid"), F.col("value.event_id").alias("event_id"))


def running_counts(parsed: DataFrame, grain) -> DataFrame:
    """Stream of running clicks per (date, *grain). Without a watermark: no click is late, and the state is
    the result itself, a row per key."""
    return parsed.groupBy("date", *grain).agg(F.count(F.lit(1)).alias("n"))


def counts_in_state(spark: SparkSession, checkpoint: str, grain) -> DataFrame:
    """(date, *grain, n): the running counts of a query over :func:`running_counts`, read from its state store
    at the last committed batch; no table of results is kept beside it."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.date", *[F.col(f"key.{g}") for g in grain], F.col("value.count").alias("n"))


def against_list(parsed: DataFrame, listed: DataFrame) -> DataFrame:
    """Stream of the clicks of users outside a fixed table ``listed`` (userid): a streaming anti join, read
    again in every batch, without ``foreachBatch`` and without state."""
    return parsed.join(listed.select("userid"), "userid", "left_anti")
