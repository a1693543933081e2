"""Location archives as CSV: eight fields, header lines start with a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, when

COLUMNS = ("unix_ms", "date_time", "vehicle_id", "route_tag", "dir_tag", "heading", "latitude", "longitude")
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS) + ", _corrupt_record string"
#: Times are accepted from 2000-01-01 on.
EARLIEST_MS = 946_684_800_000
HEADER = "# unix_ms,date time,vehicle id,route tag,direction tag,heading,latitude,longitude"


def kept_path(path: Column, excluded: tuple[str, ...] = ("config", "logs")) -> Column:
    """Whether a file lies in none of the excluded directories."""
    return ~path.rlike(f"/({'|'.join(excluded)})/")


def read(spark: SparkSession, paths: str | list[str], glob: str = "*.csv*") -> DataFrame:
    """Raw string rows, with _corrupt_record where a line hasn't eight fields. Gzip is read by its extension; directories named
    config or logs are left out."""
    # A line of the wrong length shows only while all its fields are parsed.
    rows = spark.read.schema(SCHEMA).option("columnPruning", "false").csv(paths, comment="#", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", recursiveFileLookup=True, pathGlobFilter=glob)
    return rows.withColumn("file", F.input_file_name()).filter(kept_path(F.col("file")))


def newest_files(rows: DataFrame, file: str, newest: str, n: int) -> DataFrame:
    """The rows of whole files, newest first, until there are n: every file that begins before the n-th row.

    One count for each file, and one order over the files, which are few beside their rows; the rows are read by a semi-join.
    """
    counts = rows.groupBy(file).agg(F.count("*").alias("_n"), F.max(newest).alias("_at"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("_at"), file).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(counts.withColumn("_before", before).filter(F.col("_before") < n).select(file), file, "left_semi")


def skip_done(df: DataFrame, day: Column, done: DataFrame) -> DataFrame:
    """Rows of days that have no output yet. done(day): the days that have."""
    return df.withColumn("_day", day).join(done.select(F.col("day").alias("_day")).distinct(), "_day", "left_anti").drop("_day")


def parse(raw: DataFrame, latest_ms: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Typed rows beside the raw ones: unix_ms, vehicle_id, route_tag, dir_tag, heading, lat, lon, error.

    error names the first reason to reject a row, whose values are then null: fields, time or location. A bad heading is no error; it becomes -1.
    """
    ms, lat, lon = F.col("unix_ms").try_cast("long"), F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double")
    late = F.lit(latest_ms) if latest_ms is not None else F.unix_millis(F.current_timestamp() + F.expr("INTERVAL 1 YEAR"))
    fields = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns else F.lit(False)
    error = (
        F.when(fields, "fields")
        .when(ms.isNull() | (ms < EARLIEST_MS) | (ms > late), "time")
        .when(~F.coalesce(geo.latitude_valid(lat) & geo.longitude_valid(lon), F.lit(False)), "location")
    )
    heading = F.coalesce(geo.heading_or_invalid(F.col("heading").try_cast("int")), F.lit(-1))
    typed = raw.select(*(keep or []), error.alias("error"), ms.alias("unix_ms"), "vehicle_id", "route_tag", "dir_tag", heading.alias("heading"), lat.alias("lat"), lon.alias("lon"))
    values = ("unix_ms", "vehicle_id", "route_tag", "dir_tag", "heading", "lat", "lon")
    return typed.select(*(keep or []), *(F.when(F.col("error").isNull(), F.col(v)).alias(v) for v in values), "error")


def to_fields(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """The eight fields as strings."""
    return df.select(
        F.col("unix_ms").cast("string").alias(COLUMNS[0]), when.stamp(F.col("unix_ms"), zone).alias(COLUMNS[1]), "vehicle_id", "route_tag", "dir_tag",
        F.col("heading").cast("string").alias("heading"), F.col("lat").cast("string").alias("latitude"), F.col("lon").cast("string").alias("longitude"),
    )


def write_days(df: DataFrame, path: str, zone: str = "UTC", mode: str = "overwrite") -> None:
    """Gzipped CSV under year=, month= and day=; a row exactly at midnight stays in the old day. Files hold ranges of time, so a
    full day is several tasks' work and files in the order of their names are in order of time. With mode overwrite only days in df are replaced."""
    day, ms = when.archive_day(F.col("unix_ms"), zone), F.col("unix_ms").cast("long")
    parts = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    out = parts.select(
        F.col("unix_ms").cast("string").alias(COLUMNS[0]), when.stamp(F.col("unix_ms"), zone).alias(COLUMNS[1]), "vehicle_id", "route_tag", "dir_tag", F.col("heading").cast("string").alias("heading"),
        F.col("lat").cast("string").alias("latitude"), F.col("lon").cast("string").alias("longitude"), "year", "month", "day",
    )
    out.repartitionByRange("year", "month", "day", ms).sortWithinPartitions("year", "month", "day", ms).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("year", "month", "day").csv(path)
