"""Golden feed documents, CSV archives, tar and zip entries, catalogue tables, and the stream against the batch fold."""

import io
import tarfile
import zipfile

import duckdb
from pyspark.sql import functions as F

from fleetloom.operators import merge, release
from fleetloom.plans.registry import ORACLES, QUERIES
from fleetloom.plans.table_queries import repeated_reports
from fleetloom.sources import archives, catalog, csv_rows, feed_xml, replay
from fleetloom.streaming import vehicle_merge

c = F.col
VEHICLES = """
<?xml version="1.0" encoding="utf-8" ?>
<body copyright="x">
<vehicle id="0199" routeTag="70" dirTag="70_1_var0" lat="42.3758" lon="-71.2382" secsSinceReport="20" predictable="true" heading="268" speedKmHr="0.0"/>
<vehicle id="0877" routeTag="77" dirTag="" lat="42.4" lon="-71.1" secsSinceReport="35" predictable="false" heading="-7" speedKmHr="3.5"/>
<lastTime time="1350562779906"/>
</body>"""
ERROR = '\n<body><Error shouldRetry="true">\n  Agency server cannot accept client\n</Error></body>'
ROUTE = """<body><route tag="76" title="76" color="ff" oppositeColor="00" latMin="42.1" latMax="42.5" lonMin="-71.3" lonMax="-71.0">
<stop tag="s1" title="One" lat="42.2" lon="-71.1" stopId="01"/><stop tag="s2" title="Two" lat="42.3" lon="-71.2"/><stop tag="s3" title="" lat="42.3" lon="-71.2"/><stop tag="s4" title="Zero" lat="0" lon="0"/>
<direction tag="76_0" title="Out" name="Outbound" useForUI="true"><stop tag="s2"/><stop tag="s1"/><stop tag="s2"/><stop tag="s9"/></direction>
<path><point lat="42.2" lon="-71.1"/><point lat="42.3" lon="-71.2"/></path><path><point lat="42.3" lon="-71.2"/><point lat="42.4" lon="-71.2"/></path><path><point lat="142.3" lon="0"/></path></route>
<route tag="77" title="77"><path><point lat="42.2" lon="-71.1"/><point lat="42.3" lon="-71.2"/></path></route></body>"""
SCHEDULE = '<body><route tag="1" title="One" scheduleClass="a" serviceClass="wkd" direction="in"><header><stop tag="x">X</stop></header><tr blockID="b1"><stop tag="x" epochTime="21600000">06:00:00</stop><stop tag="y" epochTime="-1">--</stop><stop tag="z" epochTime="23820000">06:37:00</stop></tr></route></body>'


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, xml string")


def test_vehicle_feed(spark):
    got = feed_xml.vehicle_reports(docs(spark, VEHICLES, ERROR, "<body></body>")).orderBy("i", "vehicle_id").collect()
    assert [(r.vehicle_id, r.unix_ms, r.heading, r.error) for r in got if r.i == 0] == [("0199", 1350562779906, 268, None), ("0877", 1350562764906, -1, None)]
    assert [(r.error, r.should_retry) for r in got if r.i == 1] == [("Agency server cannot accept client", True)]
    assert [r.error for r in got if r.i == 2] == ["no last time"]


def test_catalogue(spark):
    r = feed_xml.routes(docs(spark, ROUTE)).cache()
    assert {x.route_tag: x.errors for x in catalog.routes(r).collect()} == {"76": [], "77": ["no directions", "no bounds"]}
    assert sorted(x.stop_tag for x in catalog.stops(r).collect()) == ["s1", "s2"]
    assert [(x.seq, x.stop_tag, x.repeated, x.unknown) for x in catalog.direction_stops(r).orderBy("seq").collect()] == [(0, "s2", False, False), (1, "s1", False, False), (2, "s2", True, False), (3, "s9", False, True)]
    paths, bridge = catalog.paths(r)
    assert [x.path_index for x in paths.orderBy("path_index").collect()] == [1, 2]
    assert sorted((x.path_index, x.route_tag) for x in bridge.collect()) == [(1, "76"), (1, "77"), (2, "76")]
    assert catalog.directions(r).first().use_for_ui is True and catalog.locations(r).filter("lat = 42.2").count() == 1
    xml = catalog.paths_xml(paths, bridge).agg(F.concat(F.lit("<body>"), F.array_join(F.collect_list("xml"), ""), F.lit("</body>")).alias("xml"))
    back = feed_xml.parse(xml, "xml", feed_xml.PATHS).select(F.explode("body.path").alias("p")).select("p._index", F.size("p.point").alias("n"), F.transform("p.route", lambda t: t["_tag"]).alias("tags"))
    assert sorted(tuple(x) for x in back.collect()) == [(1, 2, ["76", "77"]), (2, 2, ["76"])]


def test_schedule(spark):
    got = feed_xml.schedule_times(docs(spark, SCHEDULE)).orderBy("seq").collect()
    assert [(x.block_id, x.stop_tag, x.epoch_ms) for x in got] == [("b1", "x", 21600000), ("b1", "y", None), ("b1", "z", 23820000)]


def test_archive_names_and_comments(spark):
    names = ["a/1350562779906.xml", "1350562779.xml", "x/20121018_121939.xml", "other.xml"]
    got = [r.t for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i").select(feed_xml.archive_time(c("n")).alias("t")).collect()]
    assert got == [1350562779906, 1350562779000, 1350562779000, None]
    comment = "URL=http://x/?a=b\nRequestTime=5\n\nContent-Type: text/xml\nServer: s"
    row = spark.range(1).select(feed_xml.archive_metadata(F.lit(comment)).alias("m"), feed_xml.archive_headers(F.lit(comment)).alias("h"), feed_xml.archive_metadata(F.lit("x")).alias("n")).first()
    assert row.m["RequestTime"] == "5" and row.h["Content-Type"] == "text/xml" and row.n is None
    kept = spark.range(1).select(feed_xml.with_comment(F.lit("<?xml version='1.0'?>\n<body/>"), F.create_map(F.lit("URL"), F.lit("http://x"), F.lit("T"), F.lit("5"))).alias("x")).first().x
    assert kept == "<?xml version='1.0'?>\n<!--\nT=5\nURL=http://x\n-->\n<body/>"
    same = spark.range(1).select(catalog.equal_configs(F.lit("<a><!-- 1 --><b/></a>"), F.lit("<a>\n <b/></a>")).alias("x"), catalog.equal_configs(F.lit("a 1"), F.lit("a  1")).alias("y")).first()
    assert same.x and not same.y
    pairs = [('<a x="1" y="2>"><b/></a>', "<a y='2>' x = '1'><b></b></a>", True), ('<a x="1"/>', '<a x="2"/>', False), ("<a>t  u</a>", "<a>t u</a>", False), ('<a x="1" y="2"/>', '<a x="1"/>', False)]
    for one_, two, want in pairs:
        assert spark.range(1).select(catalog.equal_configs(F.lit(one_), F.lit(two)).alias("x")).first().x is want


def test_csv_round_trip(spark, tmp_path):
    rows = [(1350562779906, "0199", "70", "d", 268, 42.25, -71.5), (1350518400000, "1", "71", "", -1, 42.0, -71.0), (1350518400001, "1", "71", "", 0, 42.0, -71.0)]
    df = spark.createDataFrame(rows, "unix_ms long, vehicle_id string, route_tag string, dir_tag string, heading int, lat double, lon double")
    csv_rows.write_days(df, str(tmp_path / "days"))
    files = [p for p in (tmp_path / "days").rglob("*.csv.gz")]
    assert len(files) == 2 and {p.parent.name for p in files} == {"day=17", "day=18"}
    (tmp_path / "days/logs").mkdir()
    (tmp_path / "days/logs/x.csv").write_text("1,2\n")
    (tmp_path / "days/bad.csv").write_text(csv_rows.HEADER + "\n946684799999,x,v,r,d,1,42,-71\n1350562779906,x,v,r,d,1,142,-71\n1350562779906,x,v\n")
    got = csv_rows.parse(csv_rows.read(spark, str(tmp_path / "days")))
    assert sorted(r.error for r in got.collect() if r.error) == ["fields", "location", "time"]
    assert sorted(tuple(r)[:7] for r in got.filter("error IS NULL").select("unix_ms", "vehicle_id", "route_tag", F.coalesce("dir_tag", F.lit("")).alias("dir_tag"), "heading", "lat", "lon").collect()) == sorted(rows)


def test_archive_entries(spark, tmp_path):
    with tarfile.open(tmp_path / "raw-2014-11-05.tar.gz", "w:gz") as t:
        for name in ("a.xml", "b.xml"):
            info = tarfile.TarInfo(name)
            info.size = 3
            t.addfile(info, io.BytesIO(name[:3].encode()))
    with zipfile.ZipFile(tmp_path / "z20141106.zip", "w") as z:
        z.writestr("c.xml", "<c/>")
    got = sorted((r.name, r.size, bytes(r.body)) for r in archives.entries(spark, str(tmp_path)).collect())
    assert got == [("a.xml", 3, b"a.x"), ("b.xml", 3, b"b.x"), ("c.xml", 4, b"<c/>")]
    listing = archives.files(spark, str(tmp_path))
    assert [r.file_date for r in archives.ordered(listing).collect()] == ["20141106", "20141105"]
    assert archives.raw_archives(listing).count() == 1
    rows = spark.createDataFrame([("d1", "n2", bytearray(b"xy"), 2000), ("d1", "n1", bytearray(b"z"), 1000), ("d2", "n3", bytearray(b""), 1)], "day string, name string, body binary, mtime_ms long")
    assert sorted((r.day, r.entries) for r in archives.write_tars(rows, str(tmp_path / "out")).collect()) == [("d1", 2), ("d2", 1)]
    back = archives.entries(spark, str(tmp_path / "out")).collect()
    assert [r.name for r in back if "d1" in r.archive] == ["n1", "n2"]
    kinds = spark.createDataFrame([("<?xml?><a/>",), ("<!DOCTYPE html><html>",), ("x",)], "b string").select(archives.kind_of(c("b")).alias("k"))
    assert [r.k for r in kinds.collect()] == ["xml", "html", "unknown"]


def test_serial_numbers_before_a_date_are_no_dates(spark):
    names = {
        "raw/001901-2014-05-01.csv": "20140501", "raw/002014-2014-05-01.csv": "20140501", "raw/190105-2014-05-01.csv": "20140501", "raw/20150301-2014-05-02.csv": "20140502",
        "raw/2014-11-05/20141106123000.csv": "20141106", "raw/2014-11-05/1415232000000.xml": "", "raw/x_20141106.tgz": "20141106", "raw/20141399.csv": "",
    }
    found = spark.createDataFrame([(n,) for n in names], "path string").select("path", archives.file_date(c("path")).alias("date")).collect()
    assert {r.path: r.date for r in found} == names


def test_file_order_of_ids_that_read_as_years(spark, tmp_path):
    ids = [*range(1895, 2105), *range(190_100, 190_110), *range(201_201, 201_210), 1_000_000, 100_000, 20_140_501]
    spark.createDataFrame([(i,) for i in ids], "doc_id long").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["s08_file_order"](spark, str(tmp_path)).orderBy("place").select("doc_id", "place").collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == con.execute(f"SELECT doc_id, place FROM ({ORACLES['s08_file_order']}) ORDER BY place").fetchall()


def test_replayed_responses(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"in/day{i % 2}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/day{i % 2}/{1350562779900 + i}.xml").write_text(f"<body><lastTime time='{i}'/></body>")
    spark.dataSource.register(replay.ReplaySource)
    assert spark.read.format("replay").load(str(tmp_path / "in")).count() == 7
    stream = spark.readStream.format("replay").option("per_batch", "3").load(str(tmp_path / "in"))
    sizes = []
    query = stream.writeStream.foreachBatch(lambda b, i: sizes.append([r.xml for r in b.collect()])).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert [len(x) for x in sizes if x] == [3, 3, 1] and [x for b in sizes for x in b] == [f"<body><lastTime time='{i}'/></body>" for i in range(7)]


def test_token_bucket():
    use = vehicle_merge.token_bucket(100, 100)
    steps = [((1, 1), (100 - 0, 0)), ((1, 0), (99, 0))]
    available = 100.0
    for (used, elapsed), _ in steps:
        available, wait = use(available, used, elapsed)
        assert wait == 0
    assert use(0, 1, 0) == (-1, 1.0) and use(100, 1, 10_000) == (99, 0.0) and use(-50, 10, 20) == (-40, 40.0)


def test_stream_equals_batch(spark, tmp_path):
    r = repeated_reports(spark, "/root/testdata/sf0.001").withColumn("arrival", c("arrival.t") * 1000 + c("arrival.event_id") % 300 * 3 + c("arrival.k"))
    last = r.agg(F.max("unix_ms")).first()[0]
    # A late report of another vehicle moves the watermark on, so that all others are released.
    closing = r.limit(1).withColumn("vehicle_id", F.lit("closing")).withColumn("unix_ms", F.lit(last + 10_000_000)).withColumn("arrival", F.lit(1 << 60).cast("long"))
    r.write.parquet(str(tmp_path / "in"))
    closing.write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(r.schema).parquet(str(tmp_path / "in"))
    query = vehicle_merge.write_days(vehicle_merge.merge_stream(source), str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "raw"))
    assert query.awaitTermination(180) and query.exception() is None
    columns = ["vehicle_id", "unix_ms", "route_tag", "dir_tag"]
    batch = {tuple(x) for x in merge.merge_reports(r, "arrival").select(columns).collect()}
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {tuple(x) for x in out.select(columns).collect()} == batch
    day = str(out.select(F.max("day")).first()[0])
    closed = vehicle_merge.close_day(spark, str(tmp_path / "out"), day).collect()
    assert closed == sorted(closed, key=lambda x: (x.unix_ms, x.vehicle_id)) and spark.read.parquet(str(tmp_path / "raw")).count() == len(batch)


def test_released_stream_equals_batch(spark, tmp_path):
    rows = [("f", i // 5, f"v{i % 5}", 1_000_000 + i // 5 * 2_500 + i % 5 * 300, "1", "d", i // 10 % 7, 1.0, 2.0) for i in range(150) if i % 11]
    schema = "feed string, response long, vehicle_id string, unix_ms long, route_tag string, dir_tag string, heading int, lat double, lon double"
    df = spark.createDataFrame(rows, schema)
    want = [tuple(r) for r in release.release_reports(df, "response").orderBy("place").collect()]
    for k in range(3):
        df.filter(c("response").between(10 * k, 10 * k + 9)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    # A feed that reports much later lets the first one close.
    spark.createDataFrame([("later", 1, "x", 9_000_000, "1", "d", 1, 1.0, 2.0)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", vehicle_merge.ROCKSDB)
    stream = release.release_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert query.awaitTermination(180) and query.exception() is None
    got = [tuple(r) for r in spark.read.schema(release.OUTPUT).parquet(str(tmp_path / "out")).filter("feed = 'f'").orderBy("place").collect()]
    assert got == want and [r[4] for r in got] == sorted(r[4] for r in got)


def test_steps_of_the_stream():
    s, out = vehicle_merge.step(None, (1000, "1", "a", 1, 2.0, 3.0))
    s, none = vehicle_merge.step(s, (1500, "1", "b", 1, 2.0, 3.0))
    assert out is None and none is None
    assert vehicle_merge.merged_rows("v", s) == [("v", 1250, "1", "a", 1, 2.0, 3.0), ("v", 1251, "1", "b", 1, 2.0, 3.0)]
    assert vehicle_merge.step(s, (500, "1", "a", 9, 2.0, 3.0)) == (s, None)
