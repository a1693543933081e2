"""Views that turn the generic test tables into vehicle reports and path segments, in Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_EVENTS = [
    "event_id", "user_id", "{ms} AS unix_ms", "user_id % 8 AS r", "(event_id % 5) * 8 + user_id % 8 AS p",
    "(event_id * 13) % 9 AS k", "((event_id * 29) % 100) / 1e2 AS f",
]
_REPORT = [
    "event_id", "unix_ms", "lpad(CAST(user_id AS VARCHAR(20)), 4, '0') AS vehicle_id", "CAST(r AS VARCHAR(20)) AS route_tag",
    """CASE WHEN event_id % 50 = 7 THEN concat(CAST((r+1)%8 AS VARCHAR(20)), '_0_var0')
       ELSE concat(CAST(r AS VARCHAR(20)), '_', CAST(event_id % 2 AS VARCHAR(20)), '_var0') END AS dir_tag""",
    "CAST((event_id * 37) % 363 - 2 AS INT) AS heading",
    """421e-1 + (p%8)*5e-2 + 3e-3*((k*(p+3))%4) + f*(3e-3*(((k+1)*(p+3))%4) - 3e-3*((k*(p+3))%4))
       + ((event_id*7919)%2001 - 1000)/1e6 + CASE WHEN event_id % 10 = 3 THEN 1e0 ELSE 0e0 END AS lat""",
    "-712e-1 + CAST((p - p%8)/8 AS INT)*8e-2 + (k + f)*8e-3 + ((event_id*104729)%2001 - 1000)/1e6 AS lon",
]
_SEGMENT = [
    "p AS path_index", "k AS seg_index", "CAST(p%8 AS VARCHAR(20)) AS route_tag",
    "421e-1 + (p%8)*5e-2 + 3e-3*((k*(p+3))%4) AS lat1", "-712e-1 + CAST((p - p%8)/8 AS INT)*8e-2 + k*8e-3 AS lon1",
    "421e-1 + (p%8)*5e-2 + 3e-3*(((k+1)*(p+3))%4) AS lat2", "-712e-1 + CAST((p - p%8)/8 AS INT)*8e-2 + (k+1)*8e-3 AS lon2",
]
PATHS, SEGMENTS, ROUTES = 40, 9, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vehicle_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, unix_ms, vehicle_id, route_tag, dir_tag, heading, lat, lon: one row for each event."""
    ms = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) DIV 1000"
    return table(spark, sf_dir, "events").selectExpr(*(x.format(ms=ms) for x in _EVENTS)).selectExpr(*_REPORT)


def path_segments(spark: SparkSession) -> DataFrame:
    """path_index, seg_index, route_tag, lat1, lon1, lat2, lon2: 40 paths of 9 segments."""
    return spark.range(PATHS * SEGMENTS).selectExpr(f"id DIV {SEGMENTS} AS p", f"id % {SEGMENTS} AS k").selectExpr(*_SEGMENT)


def directions(spark: SparkSession) -> DataFrame:
    """dir_tag, route_tag: two directions for each route."""
    return spark.range(2 * ROUTES).selectExpr(
        "concat(CAST(id DIV 2 AS VARCHAR(20)), '_', CAST(id % 2 AS VARCHAR(20)), '_var0') AS dir_tag", "CAST(id DIV 2 AS VARCHAR(20)) AS route_tag"
    )


VIEWS = f"""
e0 AS (SELECT {", ".join(_EVENTS).format(ms="epoch_us(ts) // 1000")} FROM events),
vehicle_reports AS (SELECT {", ".join(_REPORT)} FROM e0),
path_segments AS (SELECT {", ".join(_SEGMENT)} FROM (SELECT a.range AS p, b.range AS k FROM range({PATHS}) a, range({SEGMENTS}) b)),
directions AS (SELECT concat(CAST(range // 2 AS VARCHAR), '_', CAST(range % 2 AS VARCHAR), '_var0') AS dir_tag, CAST(range // 2 AS VARCHAR) AS route_tag FROM range({2 * ROUTES}))
"""


def over_views(sql: str, *ctes: str) -> str:
    """DuckDB SQL over the views, with further common table expressions."""
    return f"WITH {', '.join([VIEWS, *ctes])} {sql}"
