"""Merging repeated vehicle reports.

A vehicle's state is (first report, last differing tags, count, sum of times). A report merges while it is within 2 s of the first one and
has its position and heading; a change of route or direction during a merge is remembered. An older report is dropped. Anything else
emits the merged row, at the mean time, and one more at a millisecond later with the changed tags, and starts anew. Missing tags
and headings equal each other. Batch and stream share step() and merged_rows().
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MERGE_MS = 2000
_FIELDS = ("unix_ms", "route_tag", "dir_tag", "heading", "lat", "lon")
_OUT = "unix_ms long, route_tag string, dir_tag string, heading int, lat double, lon double, dropped long"


def merged_rows(vehicle, s: tuple) -> list[tuple]:
    """What a state emits: the merged row at its mean time, and its changed tags a millisecond later."""
    first_ms, route, direction, heading, lat, lon, last_route, last_dir, n, total = s
    ms = (2 * total + n) // (2 * n)  # floor of the mean plus a half
    rows = [(vehicle, ms, route, direction, heading, lat, lon)]
    return rows if last_route is None and last_dir is None else [*rows, (vehicle, ms + 1, last_route, last_dir, heading, lat, lon)]


def step(s: tuple | None, r: tuple, same_tags: bool = False) -> tuple[tuple, tuple | None]:
    """(new state, state to emit or None) for a report (ms, route, direction, heading, lat, lon)."""
    ms, route, direction, heading, lat, lon = r
    if s is not None:
        changed = (route, direction) != (s[1], s[2])
        if (s[3], s[4], s[5]) == (heading, lat, lon) and abs(s[0] - ms) <= MERGE_MS and not (same_tags and changed):
            return (*s[:6], route if changed else None, direction if changed else None, s[8] + 1, s[9] + ms), None
        if s[0] > ms:
            return s, None  # an older report is dropped
    return (ms, route, direction, heading, lat, lon, None, None, 1, ms), s


def merge_reports(df: DataFrame, arrival: str, vehicle: str = "vehicle_id", slice_ms: int | None = None, same_tags: bool = False) -> DataFrame:
    """vehicle, unix_ms, route_tag, dir_tag, heading, lat, lon, dropped: the merged rows of each vehicle; dropped counts the vehicle's older reports.

    Rows stream through their task in order of vehicle and arrival, so one state is all that is held, however many reports a vehicle has.
    With slice_ms a vehicle's day or hour is walked by itself, which spreads a busy vehicle over tasks at the price of a merge across the
    border of two slices. same_tags is the earlier rule: only reports of the same route and direction merge.
    """
    part = F.floor(F.col("unix_ms") / slice_ms) if slice_ms else F.lit(0).cast("long")
    rows = df.select(F.col(vehicle).alias("_v"), part.alias("_slice"), F.col(arrival).alias("_a"), F.col("unix_ms").cast("long").alias("unix_ms"), "route_tag", "dir_tag", F.col("heading").cast("int").alias("heading"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    kind = rows.schema["_v"].dataType.simpleString()
    rows = rows.repartition("_v", "_slice").sortWithinPartitions("_v", "_slice", "_a", *_FIELDS).drop("_a")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = schema = None
        dropped, out = 0, []

        def emit(s: tuple, gone: int) -> None:
            # A row's drops are those since the last one of its walk.
            for k, row in enumerate(merged_rows(key[0], s)):
                out.append((key[0], key[1], *row[1:], 0 if k else gone))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        names = ["_v", "_slice", *_FIELDS, "dropped"]
        types: list[pa.DataType] = []
        for b in batches:
            if schema is None:
                schema = b.schema
                types = [schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
            for v, part, *r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != (v, part):
                    if state is not None:
                        emit(state, dropped)
                    key, state, dropped = (v, part), None, 0
                before = state
                state, done = step(state, tuple(r), same_tags)
                if done is not None:
                    emit(done, dropped)
                    dropped = 0
                elif state is before:
                    dropped += 1
            if out:
                yield flush()
        if state is not None:
            emit(state, dropped)
            yield flush()

    merged = rows.mapInArrow(walk, f"_v {kind}, _slice long, {_OUT}")
    dropped = F.sum("dropped").over(Window.partitionBy("_v", "_slice"))
    return merged.withColumn("dropped", dropped).select(F.col("_v").alias(vehicle), *_FIELDS, "dropped")


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")).select(key, "_best.*")
