"""Archived responses as a source, for batches and for streams that play them again in order."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, SimpleDataSourceStreamReader

#: Responses in a micro-batch.
A_BATCH = 100


def _listed(folder: str) -> list[str]:
    """Paths of the responses below a folder that every machine sees, in the order of their names."""
    found = [os.path.join(at, n) for at, _, names in os.walk(folder) for n in names if n.endswith(".xml")]
    return sorted(found, key=lambda p: (os.path.basename(p), p))


def _row(path: str) -> tuple[str, str]:
    with open(path, encoding="utf-8") as f:
        return path, f.read()


class ReplaySource(DataSource):
    """spark.read or readStream.format("replay").load(folder): path, xml. Option per_batch: responses in a micro-batch.

    A stream's offset is the number of responses that were read, so new files have to have later names, as archives do.
    """

    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        return "path string, xml string"

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options["path"])

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802  Spark's name
        return _Stream(self.options["path"], int(self.options.get("per_batch", A_BATCH)))


class _Batch(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def read(self, partition) -> Iterator[tuple]:
        yield from map(_row, _listed(self.folder))


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, folder: str, per_batch: int):
        self.folder, self.per_batch = folder, per_batch

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {"read": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        paths = _listed(self.folder)[start["read"] : start["read"] + self.per_batch]
        return iter([_row(p) for p in paths]), {"read": start["read"] + len(paths)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802  Spark's name
        return iter([_row(p) for p in _listed(self.folder)[start["read"] : end["read"]]])
