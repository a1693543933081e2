"""Archives of files: entries of tar and zip archives as rows, listings, incremental selection, and writing tar archives.

An archive is one task's work (its format has to be read in order), entries come out one by one.
"""

from __future__ import annotations

import io
import tarfile
import uuid
import zipfile
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import unquote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "archive string, name string, mtime timestamp, size long, body binary"
_BATCH = 8 << 20


def files(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """path, modificationTime, length of files, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths).select("path", "modificationTime", "length")


def _opened(path: str):
    """The file as a seekable stream, from the store that Spark names; nothing is read ahead."""
    scheme, colon, rest = path.partition(":")
    if scheme == "file" or not colon:
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if colon else path)
    if scheme == "dbfs":  # mounted on every node
        return pafs.LocalFileSystem().open_input_file("/dbfs/" + rest.lstrip("/"))
    fs, at = pafs.FileSystem.from_uri(f"{({'s3a': 's3', 's3n': 's3', 'abfss': 'abfs'}).get(scheme, scheme)}:{rest}")
    return fs.open_input_file(at)


def _tar_entries(stream) -> Iterator[tuple[str, float, bytes]]:
    with tarfile.open(fileobj=stream, mode="r|*") as tar:
        for m in tar:  # all entries, also after the first
            if m.isfile():
                yield m.name, m.mtime, tar.extractfile(m).read()


def _zip_entries(stream) -> Iterator[tuple[str, float, bytes]]:
    with zipfile.ZipFile(stream) as z:
        for i in z.infolist():
            if not i.is_dir():
                yield i.filename, datetime(*i.date_time, tzinfo=timezone.utc).timestamp(), z.read(i)


def entries(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """archive, name, mtime, size, body of each file in tar, tar.gz, tgz and zip archives; a broken archive fails its task.

    Archives are dealt out by name and streamed from their store, one entry at a time, so an archive may be larger than memory; an entry may not.
    """
    listing = files(spark, paths, glob).filter(F.col("path").rlike(r"\.(tar|tar\.gz|tgz|zip)$")).select("path")
    listing = listing.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path in (p for f in frames for p in f["path"]):
            rows, held = [], 0
            with _opened(unquote(path) if path.startswith("file:") else path) as stream:
                for name, mtime, body in _zip_entries(stream) if path.endswith(".zip") else _tar_entries(stream):
                    rows.append((path, name, pd.Timestamp(mtime, unit="s"), len(body), body))
                    held += len(body)
                    if held > _BATCH:
                        yield pd.DataFrame(rows, columns=["archive", "name", "mtime", "size", "body"])
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["archive", "name", "mtime", "size", "body"])

    return listing.mapInPandas(unpack, ENTRY)


def file_date(path: Column) -> Column:
    """yyyymmdd digits of the last date in a file name, with or without dashes; empty without one.

    A date begins no number in its middle and has a month and a day, so serial numbers before it are not read as parts of one.
    """
    date = r"(?:19|20)\d{2}-?(?:0[1-9]|1[0-2])-?(?:0[1-9]|[12]\d|3[01])"
    return F.regexp_replace(F.regexp_extract(path, rf"(?s)^.*(?<!\d)({date})[^/]*$", 1), "-", "")


def ordered(listing: DataFrame, newest_first: bool = True) -> DataFrame:
    """By the date in the name, else that of the last change, then by path."""
    date = F.coalesce(F.nullif(file_date(F.col("path")), F.lit("")), F.date_format("modificationTime", "yyyyMMdd"))
    d = listing.withColumn("file_date", date)
    return d.orderBy(F.desc("file_date") if newest_first else F.asc("file_date"), "path")


def raw_archives(listing: DataFrame) -> DataFrame:
    """tar.gz and tgz files whose path speaks of raw, location or fetch."""
    return listing.filter(F.col("path").rlike(r"(?i)(raw|location|fetch)") & F.col("path").rlike(r"\.(tar\.gz|tgz)$"))


def config_directories(listing: DataFrame) -> DataFrame:
    """directory and time of those that hold a routeList.xml, by time."""
    own = listing.filter(F.col("path").endswith("/routeList.xml"))
    return own.select(F.regexp_replace("path", "/routeList.xml$", "").alias("directory"), F.col("modificationTime").alias("time")).orderBy("time", "directory")


def is_newer(source_time: Column, target_time: Column) -> Column:
    """Whether an output has to be made again: it is missing or older than its source."""
    return target_time.isNull() | (source_time > target_time)


def kind_of(body: Column) -> Column:
    """xml, html or unknown, by the first element."""
    start = F.lower(F.ltrim(F.substring(body.cast("string"), 1, 200)))
    return F.when(start.rlike(r"^(<!doctype html|<html)"), "html").when(start.startswith("<"), "xml").otherwise("unknown")


def write_tars(df: DataFrame, path: str, group: str = "day") -> DataFrame:
    """A tar.gz for each group of rows (group, name, body, mtime_ms), entries in order of time; returns group, file, entries.

    Rows stream into their archive in order, so a group may be larger than memory. An archive is written under a name of its attempt and
    gets its final one when it is whole, so attempts of a task don't meet and a lost one leaves no archive.
    """
    rows = df.select(F.col(group).cast("string").alias("_g"), "name", F.col("body").cast("binary").alias("body"), F.col("mtime_ms").cast("long").alias("mtime_ms"))
    rows = rows.repartition("_g").sortWithinPartitions("_g", "mtime_ms", "name")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = pafs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        key = part = out = tar = None
        n = 0

        def done() -> pd.DataFrame:
            tar.close()
            out.close()
            fs.move(part, f"{folder}/{key}.tar.gz")
            return pd.DataFrame({"_g": [key], "file": [f"{key}.tar.gz"], "entries": [n]})

        try:
            for f in frames:
                for g, name, body, ms in zip(f["_g"], f["name"], f["body"], f["mtime_ms"], strict=True):
                    if tar is None or g != key:
                        if tar is not None:
                            yield done()
                        key, n, part = g, 0, f"{folder}/.{g}-{uuid.uuid4().hex}"
                        out = fs.open_output_stream(part, compression=None)
                        tar = tarfile.open(fileobj=out, mode="w|gz")
                    info = tarfile.TarInfo(name)
                    info.size, info.mtime = len(body), ms / 1000
                    tar.addfile(info, io.BytesIO(body))
                    n += 1
            if tar is not None:
                yield done()
                tar = None
        finally:
            if tar is not None and not out.closed:
                out.close()
                fs.delete_file(part)

    kind = dict(df.dtypes)[group]
    return rows.mapInPandas(pack, "_g string, file string, entries long").select(F.col("_g").cast(kind).alias(group), "file", "entries")
