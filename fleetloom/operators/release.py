"""Merged reports of a whole feed in order of time: a watermark from the least first report, vehicles that fall silent, ordered release.

A feed is walked response by response. All reports of a response go through the merge rules (operators.merge). A vehicle that a response lacks
counts as unseen once more. The watermark is the least first report over the vehicles that were seen in one of the last RECENT responses before
this one, less GRACE_MS; an unseen vehicle whose first report is further back than GRACE_MS before the watermark is emitted and forgotten. What was
emitted waits, and leaves in order of time and vehicle once it is older than the watermark. At the end everything leaves.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .merge import merged_rows, step

RECENT, GRACE_MS = 3, 3_000
_REPORT = ("unix_ms", "route_tag", "dir_tag", "heading", "lat", "lon")
OUTPUT = "feed string, place long, watermark_ms long, vehicle_id string, unix_ms long, route_tag string, dir_tag string, heading int, lat double, lon double"


class Feed:
    """The state of one feed: merge states and unseen counts of its vehicles, and the rows that wait. Bounded by vehicles, not by reports."""

    def __init__(self) -> None:
        self.states: dict[str, tuple] = {}
        self.unseen: dict[str, int] = {}
        self.waiting: list[tuple] = []  # a heap of (ms, vehicle, number, row)
        self.watermark: int | None = None
        self.emitted = self.released = 0

    def _emit(self, vehicle: str, state: tuple) -> None:
        for row in merged_rows(vehicle, state):
            heapq.heappush(self.waiting, (row[1], vehicle, self.emitted, list(row[2:])))
            self.emitted += 1

    def _leave(self) -> tuple:
        ms, vehicle, _, row = heapq.heappop(self.waiting)
        self.released += 1
        return self.released, self.watermark, vehicle, ms, *row

    def respond(self, reports: Iterable[tuple]) -> Iterator[tuple]:
        """Take a response, (vehicle, unix_ms, route, direction, heading, lat, lon) each; give (place, watermark, vehicle, ms, ..) of the rows that leave."""
        seen = set()
        for vehicle, *r in sorted(reports, key=lambda r: (r[0], r[1])):
            seen.add(vehicle)
            self.states[vehicle], done = step(self.states.get(vehicle), tuple(r))
            self.unseen[vehicle] = 0
            if done is not None:
                self._emit(vehicle, done)
        silent = [v for v in self.states if v not in seen]
        for v in silent:
            self.unseen[v] += 1
        recent = [s[0] for v, s in self.states.items() if self.unseen[v] <= RECENT]
        if recent:
            self.watermark = min(recent) - GRACE_MS
        for v in sorted(silent):
            if self.watermark - self.states[v][0] > GRACE_MS:
                self._emit(v, self.states.pop(v))
                del self.unseen[v]
        while self.waiting and self.waiting[0][0] < self.watermark:
            yield self._leave()

    def close(self) -> Iterator[tuple]:
        """All that is left, in order."""
        for v in sorted(self.states):
            self._emit(v, self.states[v])
        self.states, self.unseen = {}, {}
        while self.waiting:
            yield self._leave()

    def dump(self) -> str:
        return json.dumps([self.states, self.unseen, self.waiting, self.watermark, self.emitted, self.released])

    @classmethod
    def load(cls, text: str) -> Feed:
        feed = cls()
        states, feed.unseen, waiting, feed.watermark, feed.emitted, feed.released = json.loads(text)
        feed.states, feed.waiting = {v: tuple(s) for v, s in states.items()}, [tuple(w) for w in waiting]
        return feed


def release_reports(df: DataFrame, response: str, feed: str = "feed") -> DataFrame:
    """df(feed, response, vehicle_id, unix_ms, ..) -> OUTPUT: each feed's merged reports, place by place, with the watermark at which they left.

    A feed streams through its task in order of response; feeds are independent. Rows without a vehicle are left out.
    """
    rows = df.filter("vehicle_id IS NOT NULL").select(F.col(feed).cast("string").alias("feed"), F.col(response).alias("_r"), "vehicle_id", F.col("unix_ms").cast("long").alias("unix_ms"), "route_tag", "dir_tag", F.col("heading").cast("int").alias("heading"), "lat", "lon")
    rows = rows.repartition("feed").sortWithinPartitions("feed", "_r")
    names = [x.split()[0] for x in OUTPUT.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64()]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for name, own in groupby(stream, key=lambda r: r[0]):
            state = Feed()
            for _, reports in groupby(own, key=lambda r: r[1]):
                if out := [(name, *row) for row in state.respond(r[2:] for r in reports)]:
                    yield batch(out)
            if out := [(name, *row) for row in state.close()]:
                yield batch(out)

    return rows.mapInArrow(walk, OUTPUT)


class FeedRelease(StatefulProcessor):
    """The same for a stream, with one Feed as state for each feed. SILENCE_MS after a feed's last report in event time it is closed."""

    SILENCE_MS = 600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", "feed string, last_ms long")

    def _frame(self, name: str, rows: Iterable[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(name, *r) for r in rows], columns=[x.split()[0] for x in OUTPUT.split(", ")])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        kept = self.state.get() if self.state.exists() else None
        feed = Feed.load(kept[0]) if kept else Feed()
        frame = pd.concat(list(rows)).sort_values("response", kind="stable")
        frame = frame[["response", "vehicle_id", *_REPORT]].astype(object)
        frame = frame.where(frame.notna(), None)
        out = [row for _, own in frame.groupby("response", sort=True) for row in feed.respond(tuple(x.item() if hasattr(x, "item") else x for x in r[1:]) for r in own.itertuples(index=False))]
        last = max(int(frame["unix_ms"].max()), kept[1] if kept else 0)
        if kept:
            self.handle.deleteTimer(kept[1] + self.SILENCE_MS)
        self.handle.registerTimer(last + self.SILENCE_MS)
        self.state.update((feed.dump(), last))
        yield self._frame(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        feed = Feed.load(self.state.get()[0])
        self.state.clear()
        yield self._frame(key[0], feed.close())

    def close(self) -> None:
        pass


def release_stream(reports: DataFrame, delay: str = "3 seconds") -> DataFrame:
    """reports(feed, response, vehicle_id, unix_ms, ..), streaming -> OUTPUT. Responses have to arrive in order of micro-batches; the state store is RocksDB (set by the caller's session or by vehicle_merge)."""
    timed = reports.withColumn("ts", F.timestamp_millis("unix_ms")).withWatermark("ts", delay)
    return timed.groupBy("feed").transformWithStateInPandas(FeedRelease(), OUTPUT, "Append", "EventTime")
