"""WARC archives, index first.

Writing gives archives and an index: for each record its file, offset, length, URL and digest. Reading starts from
index rows: those selected are dealt out by file and offset, neighbouring byte ranges are joined into one read, and each
record is unpacked from its own gzip member. Of pages with equal payloads of at least MIN_REVISIT bytes the one with
the smallest id is a response record and the others are revisit records that name it, without payload.

Defined results: null html is the empty payload; a null url becomes the record's own urn; a null page_id is never the
record that others revisit unless no other has the payload; rows that repeat the smallest id are all responses; an
empty table gives no record; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_system, fresh_path, materialise, ship, shuffle_partitions

#: Smaller payloads are always stored: a revisit record would save nothing.
MIN_REVISIT = 100
#: Ranges closer than GAP bytes are read at once, up to READ bytes.
GAP, READ = 1 << 16, 8 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "page_id long, url string, payload_digest string, record_type string, file string, offset long, length long"


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    own = urn.strip("<>").rpartition(":")[2]
    return None if own == "none" else int(own)


def pack_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = quote(url, safe="%:/?#[]@!$&'()*+,;=~-._") if url else _urn(page_id).strip("<>")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def unpack_record(member: bytes) -> dict:
    """The fields of one record, checked: lengths and the digest of a stored payload must agree."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, revisit = fields["WARC-Payload-Digest"].partition(":")[2], fields["WARC-Type"] == "revisit"
    if lines[0] != "WARC/1.1" or end != b"\r\n\r\n" or not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": _page_of(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload,
    }


def write_warc(pages: DataFrame, out_dir: str | None = None, date: str = "1970-01-01T00:00:00Z", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write a record for each row of pages(page_id, url, html); returns the index, itself a table in the shared folder."""
    spark = pages.sparkSession
    ship(spark)
    out_dir = out_dir or fresh_path(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Only ids and digests move to find the repeats; a digest that many rows share is summed up before the shuffle.
    small = rows.select("page_id", "digest", F.octet_length("payload").alias("size"))
    shared = small.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    repeats = (
        small.select("page_id", "digest").join(shared.select("digest", "refers_to"), "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(F.col("page_id").alias("own"), F.col("digest").alias("own_digest"), "refers_to").distinct()
    )
    on = F.col("page_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("own_digest"))
    dealt = rows.join(repeats, on, "left").select("page_id", "url", "payload", "digest", "refers_to", F.col("own_digest").isNotNull().alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, offset, file = None, 0, ""
        fs, folder = file_system(out_dir)
        try:
            for b in batches:
                if not b.num_rows:
                    continue
                if out is None:
                    fs.create_dir(folder, recursive=True)
                    file = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{folder}/{file}", compression=None)
                done = []
                for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    page_id, url, body, digest, refers_to, revisit = r
                    member = pack_record(page_id, url, body, digest, refers_to, revisit, date)
                    out.write(member)
                    done.append((page_id, url, digest, "revisit" if revisit else "response", file, offset, len(member)))
                    offset += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                    names=["page_id", "url", "payload_digest", "record_type", "file", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    index = materialise(dealt.mapInArrow(write, _INDEX), "warc-index")
    index._fleetloom_archives = out_dir
    return index


def read_warc(index: DataFrame, out_dir: str, with_payload: bool = False) -> DataFrame:
    """Read the records of the given index rows: sorted byte ranges, neighbours in one read."""
    ship(index.sparkSession)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = file_system(out_dir)
        for frame in frames:
            for file, own in frame.groupby("file", sort=True):
                own = own.sort_values("offset")
                ranges = list(zip(own["offset"].tolist(), own["length"].tolist(), strict=True))
                with fs.open_input_file(f"{folder}/{file}") as f:
                    at = 0
                    while at < len(ranges):
                        start, stop, upto = ranges[at][0], sum(ranges[at]), at + 1
                        while upto < len(ranges) and ranges[upto][0] - stop <= GAP and sum(ranges[upto]) - start <= READ:
                            stop, upto = max(stop, sum(ranges[upto])), upto + 1
                        f.seek(start)
                        chunk = f.read(stop - start)
                        found = [unpack_record(chunk[a - start : a - start + n]) for a, n in ranges[at:upto]]
                        out = pd.DataFrame(found, columns=names)
                        for c in ("page_id", "refers_to"):
                            out[c] = pd.array([r[c] for r in found], "Int64")
                        yield out
                        at = upto

    n = shuffle_partitions(index.sparkSession)
    return index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset").mapInPandas(read, schema)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as archives and read every record back."""
    index = write_warc(pages)
    return read_warc(index, index._fleetloom_archives)
