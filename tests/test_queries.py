"""Every registered query of the library against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from fleetloom.plans.fixtures import over_views
from fleetloom.plans.join_queries import _NEAR
from fleetloom.plans.registry import ORACLES, QUERIES, flagship

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def key(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool) or not isinstance(v, int | float):
        return (1, str(v))
    return (2, "nan" if v != v else repr(round(float(v), 5) + 0.0))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(key(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    r = duck.sql(ORACLES[name])
    names = list(r.columns)
    assert sorted(names) == columns
    assert got == sorted(tuple(key(x[names.index(c)]) for c in columns) for x in r.fetchall())


def test_flagship(spark):
    assert flagship(spark, SF).count() > 0


def test_entry_needs_no_session_to_list_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(QUERIES) <= set(names) and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["j03_nearest_segment", "j09_nearest_perpendicular"])
def test_nearest_of_two_segments_almost_as_far(spark, tmp_path, name):
    spark.read.parquet("/root/testdata/sf0.1/events.parquet").filter("event_id IN (18872, 46131)").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    columns = "event_id, path_index, seg_index"
    got = sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select(*columns.split(", ")).collect())
    assert got == con.execute(f"SELECT {columns} FROM ({ORACLES[name]}) ORDER BY ALL").fetchall()


def test_nearest_perpendicular_at_every_place_with_near_ties(spark, tmp_path):
    # A report's place repeats after 600,300 events (the least multiple of 9, 100 and 2,001) and 8 users, so these are all there are.
    con = duckdb.connect()
    con.execute("CREATE TABLE places AS SELECT e.range + 600300 * u.range AS event_id, TIMESTAMP '2024-01-01' AS ts, u.range AS user_id FROM range(600300) e, range(8) u")
    con.execute("CREATE VIEW events AS FROM places")
    close = "list_sort(list(distance))[2] - min(distance) < 1e-9 * min(distance) OR min(least(abs(t), abs(1 - t))) < 1e-9"
    con.execute("CREATE TABLE ties AS FROM places WHERE event_id IN (" + over_views(f"SELECT event_id FROM near WHERE t > -1e-9 AND t < 1 + 1e-9 GROUP BY event_id HAVING {close}", _NEAR) + ")")
    assert con.execute("SELECT count(*) FROM ties").fetchone()[0] > 300
    con.execute(f"COPY ties TO '{tmp_path}/events.parquet'")
    con.execute("CREATE OR REPLACE VIEW events AS FROM ties")
    got = sorted(tuple(r) for r in QUERIES["j09_nearest_perpendicular"](spark, str(tmp_path)).select("event_id", "path_index", "seg_index").collect())
    assert got == con.execute(f"SELECT event_id, path_index, seg_index FROM ({ORACLES['j09_nearest_perpendicular']}) ORDER BY ALL").fetchall()
