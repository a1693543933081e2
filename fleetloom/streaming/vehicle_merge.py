"""Merging repeated reports in a stream: state for each vehicle, event-time eviction, ordered release at the sink.

The batch operator (operators.merge) states the rules. A stream keeps the same state for each vehicle and emits when a report doesn't merge.
A vehicle that falls silent is emitted by an event-time timer once the watermark has passed its first report by GRACE_MS; the watermark
is Spark's (greatest time seen less the allowed delay, for all vehicles), where a feed of one server could use the least time over vehicles.
So rows are in time order within a micro-batch and a day's file is sorted when the day is closed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import when
from ..operators.merge import merged_rows, step

GRACE_MS = 6_000
_TAGS = "route_tag string, dir_tag string"
_STATE = f"first_ms long, {_TAGS}, heading int, lat double, lon double, last_route string, last_dir string, n int, total long"
OUTPUT = "vehicle_id string, unix_ms long, route_tag string, dir_tag string, heading int, lat double, lon double"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class VehicleMerger(StatefulProcessor):
    """One state for each vehicle; see step()."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("merge", _STATE)

    def _timer(self, before: int | None, first_ms: int) -> None:
        """The vehicle's only timer follows its first report; most reports leave it alone."""
        if before != first_ms:
            if before is not None:
                self.handle.deleteTimer(before + GRACE_MS)
            self.handle.registerTimer(first_ms + GRACE_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s = self.state.get() if self.state.exists() else None
        s = tuple(s) if s is not None else None
        before = s[0] if s is not None else None
        out: list[tuple] = []
        frames = pd.concat(list(rows)).sort_values(["arrival", "unix_ms"], kind="stable")
        rows = frames[["unix_ms", "route_tag", "dir_tag", "heading", "lat", "lon"]].astype(object)
        for r in rows.where(rows.notna(), None).itertuples(index=False):
            s, emit = step(s, tuple(r))
            if emit is not None:
                out += merged_rows(key[0], emit)
        plain = lambda v: v.item() if hasattr(v, "item") else v
        s = tuple(plain(v) for v in s)
        self.state.update(s)
        self._timer(before, s[0])
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = tuple(self.state.get())
        self.state.clear()
        yield self._frame(merged_rows(key[0], s))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[c.split()[0] for c in OUTPUT.split(", ")])

    def close(self) -> None:
        pass


def merge_stream(reports: DataFrame, delay: str = "3 seconds") -> DataFrame:
    """reports(vehicle_id, unix_ms, route_tag, dir_tag, heading, lat, lon, arrival), streaming -> merged rows."""
    spark = reports.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = reports.withColumn("ts", F.timestamp_millis("unix_ms")).withWatermark("ts", delay)
    return timed.groupBy("vehicle_id").transformWithStateInPandas(VehicleMerger(), OUTPUT, "Append", "EventTime")


def write_days(stream: DataFrame, path: str, checkpoint: str, raw_path: str | None = None, zone: str = "UTC", **trigger):
    """Start a query that appends each micro-batch, sorted by time and vehicle, to Parquet under day=; and to raw_path as it came."""

    def save(batch: DataFrame, _: int) -> None:
        batch = batch.withColumn("day", when.archive_day(F.col("unix_ms"), zone))
        batch.persist()
        # Ranges of time within a day, so that a full day is no single task's.
        batch.repartitionByRange("day", "unix_ms").sortWithinPartitions("day", "unix_ms", "vehicle_id").write.mode("append").partitionBy("day").parquet(path)
        if raw_path:
            batch.drop("day").write.mode("append").parquet(raw_path)
        batch.unpersist()

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def write_raw(reports: DataFrame, path: str, checkpoint: str, zone: str = "UTC", **trigger):
    """Start a query that appends the reports as they came to Parquet under day=, beside the one that merges them."""
    dated = reports.withColumn("day", when.archive_day(F.col("unix_ms"), zone))
    return dated.writeStream.format("parquet").partitionBy("day").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def close_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """A closed day's rows in order of time and vehicle."""
    return spark.read.parquet(path).filter(F.col("day") == F.lit(day).cast("date")).orderBy("unix_ms", "vehicle_id")


def token_bucket(capacity: float, period: float) -> Callable:
    """A pure rate limiter: state x (used, elapsed) -> (state, available, wait). Excess has to be waited for at the refill rate."""
    rate = capacity / period

    def use(available: float, used: float, elapsed: float) -> tuple[float, float]:
        available = min(capacity, available + rate * elapsed) - used
        return available, max(0.0, -available / rate)

    return use
