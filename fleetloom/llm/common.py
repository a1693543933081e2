"""What the operators of this subpackage share: a shared folder for tables, code shipping, plain helpers."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch at most.
MAX_RECORDS, MAX_BYTES = 2_000, 16 << 20

_SHIPPED: set[str] = set()
_OWN_DIR: list[str] = []


def ship(spark: SparkSession) -> None:
    """Give every executor this package, whatever its working folder and search path are."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(), f"{root.name}_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(target)
    # Texts may be long: an Arrow batch is bounded by its bytes, so that a Python worker's memory is. It changes no result.
    for name, most in (("maxRecordsPerBatch", MAX_RECORDS), ("maxBytesPerBatch", MAX_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, str(most))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a folder of our own where it is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is unset: this cluster names no folder that its executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="fleetloom-"))
        spark.sparkContext.setCheckpointDir(_OWN_DIR[0])
    return _OWN_DIR[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark then deletes a write's shuffle files when the write ends, on all executors.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as the block runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._fleetloom_path = path
    return out


def materialise_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like materialise(), dealt into buckets by a key, so that later joins on it leave these rows where they are.

    df has to be dealt by the key into as many partitions as there are buckets, else each task writes a file for each bucket.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    with setting(spark, _CLEANUP, "true"):
        df.write.format("parquet").bucketBy(shuffle_partitions(spark), key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._fleetloom_path, out._fleetloom_table = path, table
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_table(df: DataFrame) -> None:
    """Delete a table of materialise() that nothing will read again."""
    if table := getattr(df, "_fleetloom_table", None):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if path := getattr(df, "_fleetloom_path", None):
        drop_path(df.sparkSession, path)


_WORKER: dict[Any, Any] = {}


def forget() -> None:
    """Give back what this Python worker remembers for other operators, and what its allocators hold unused."""
    _WORKER.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def worker_memory(key: Any, make: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task, for one operator at a time: an encoder or a memory of words.

    Tasks call this by name: what they close over would be a copy for each task.
    """
    if key not in _WORKER:
        forget()
        _WORKER[key] = make()
    return _WORKER[key]


#: What Hadoop calls a store and what Arrow does.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def arrow_uri(uri: str) -> str:
    """A folder that Spark names as Arrow names it."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme == "dbfs":  # mounted on every node
        return "/dbfs/" + rest.lstrip("/")
    return f"{_SCHEMES.get(scheme, scheme)}:{rest}"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder that Spark names, and the folder's path in it."""
    return pafs.FileSystem.from_uri(arrow_uri(uri))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns beside those of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
