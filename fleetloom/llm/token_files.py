"""Token-ID output: flat unsigned integer files with 64-bit document offsets, read back through memory maps.

A folder of token files holds, for each part, `<name>.bin` (ids, little endian, 2 bytes each where the vocabulary
fits and 4 otherwise) and `<name>.idx` (64-bit little-endian numbers: the count n, n + 1 offsets into the ids, n
document ids). `manifest.json` lists the parts in document order with each one's base, the number of ids in all
parts before it: a prefix sum over one count for each part. A part's files carry a name of their own for each attempt, and
only names that reach the manifest count, so a task that runs twice after a lost executor leaves no trace in the result.

Defined results: null text is the empty text and gives the end id only; a null doc_id sorts first and reads back as
null; repeated ids keep one entry for each row, in the order of a text hash; an empty table gives no part and no row;
other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, fresh_path, ship, shuffle_partitions, worker_memory
from .wordclass import LETTERS, NUMBERS, SPACE, UNUSUAL, byte_symbols

END_ID = 2
NULL_ID = np.iinfo(np.int64).min
#: Distinct pieces that a worker remembers at most. A full memory is kept while it serves most pieces, else begun anew.
MAX_PIECES, STALE = 600_000, 0.5
#: Pieces that go to the library at once.
BATCH = 4_000

# The pattern of the byte-level pre-tokenizer, with its classes written out for the code points below U+0250.
_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACE}{LETTERS}{NUMBERS}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


class PieceEncoder:
    """Encodes whole texts with the tokenizers library, each distinct piece of the pre-tokenizer only once."""

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        blank = byte_symbols()[32]
        for token, i in self.tokenizer.get_vocab().items():
            self.begins[i] = token[0] == blank
        self.known: dict[str, bytes] = {}

    def _plain(self, text: str) -> bool:
        return self.by_piece and not UNUSUAL.search(text) and not (self.added and self.added.search(text))

    def _library(self, texts: list[str]) -> list[bytes]:
        pack, kind = np.array, self.dtype
        return [pack(e.ids, kind).tobytes() for at in range(0, len(texts), BATCH) for e in self.tokenizer.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)]

    def _spaced(self, pieces: list[str]) -> dict[str, bytes]:
        """The packed ids of pieces that begin with a space: the library gets many in a row, and such ids show where each begins."""
        done: dict[str, bytes] = {}
        size = self.dtype.itemsize
        for at in range(0, len(pieces), BATCH):
            own = pieces[at : at + BATCH]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(own)], add_special_tokens=False)[0].ids, self.dtype)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(own):
                packed, cuts = ids.tobytes(), [*(starts * size).tolist(), len(ids) * size]
                done.update(zip(own, [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        return done

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text, the end id last."""
        known, split = self.known, [_PIECES.findall(t) if self._plain(t) else None for t in texts]
        pieces = set().union(*(p for p in split if p is not None))
        fresh = pieces - known.keys()
        full = len(known) + len(fresh) > MAX_PIECES
        if full and len(fresh) > STALE * len(pieces):
            known.clear()
            fresh, full = pieces, False
        spaced = [p for p in fresh if p[0] == " " and len(p) > 1 and p[1] != " "]
        known.update(self._spaced(spaced))
        rest = [p for p in fresh if p not in known]
        known.update(zip(rest, self._library(rest), strict=True))
        other = iter(self._library([t for t, p in zip(texts, split, strict=True) if p is None]))
        out = [(b"".join(map(known.__getitem__, p)) if p is not None else next(other)) + self.end for p in split]
        if full:
            for p in fresh:
                del known[p]
        return out


def encoder_of(path: str, end_id: int) -> PieceEncoder:
    """This process's encoder."""
    return worker_memory(("pieces", path, end_id), lambda: PieceEncoder(path, end_id))


def _slices(texts: list[str], most: int = 4_000_000) -> Iterator[slice]:
    """Runs of texts of about so many characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


_PART = "part int, name string, width int, docs long, tokens long"


def write_token_files(docs: DataFrame, tokenizer_path: str, out_dir: str | None = None, end_id: int = END_ID) -> str:
    """Encode docs(doc_id, text) into token files in ascending doc_id order; returns the folder."""
    spark = docs.sparkSession
    ship(spark)
    out_dir = out_dir or fresh_path(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path, end_id)
        batches = (b for b in batches if b.num_rows)
        if (first := next(batches, None)) is None:
            return
        part = TaskContext.get().partitionId()
        fs, folder = file_system(out_dir)
        fs.create_dir(folder, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        ids, sizes = [], [np.zeros(1, "<i8")]
        with fs.open_output_stream(f"{folder}/{name}.bin") as out:
            for b in itertools.chain([first], batches):
                texts = b.column("text").to_pylist()
                ids.append(b.column("doc_id").fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).astype("<i8"))
                for s in _slices(texts):
                    packed = encoder.encode(texts[s])
                    sizes.append(np.array([len(p) // encoder.dtype.itemsize for p in packed], "<i8"))
                    out.write(b"".join(packed))
        offsets = np.cumsum(np.concatenate(sizes), dtype="<i8")
        with fs.open_output_stream(f"{folder}/{name}.idx") as out:
            for x in (np.array([len(offsets) - 1], "<i8"), offsets, *ids):
                out.write(x.tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "name": [name], "width": pa.array([encoder.dtype.itemsize], pa.int32()), "docs": [len(offsets) - 1], "tokens": [int(offsets[-1])]}
        )

    n = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # The text hash deals out the rows of a repeated id; rows that agree in both are equal in every output.
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(n, F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    # One row for each part: bounded by the number of partitions, not by the data in them.
    parts = sorted((r.asDict() for r in ordered.mapInArrow(write, _PART).collect()), key=lambda r: r["part"])
    base = first_doc = 0
    for p in parts:
        p |= {"base": base, "first_doc": first_doc}
        base, first_doc = base + p["tokens"], first_doc + p["docs"]
    fs, folder = file_system(out_dir)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/manifest.json") as out:
        out.write(json.dumps({"end_id": end_id, "tokens": base, "docs": first_doc, "parts": parts}).encode())
    return out_dir


def read_manifest(out_dir: str) -> dict:
    fs, folder = file_system(out_dir)
    with fs.open_input_stream(f"{folder}/manifest.json") as f:
        return json.loads(f.read())


def _mapped(fs: pafs.FileSystem, path: str) -> pa.Buffer:
    """The file as a memory map, or its bytes where the store has no maps."""
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def open_part(out_dir: str, part: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, doc_ids) of one part, without copying the ids of a local file."""
    fs, folder = file_system(out_dir)
    index = np.frombuffer(_mapped(fs, f"{folder}/{part['name']}.idx"), "<i8")
    n = int(index[0])
    tokens = np.frombuffer(_mapped(fs, f"{folder}/{part['name']}.bin"), f"<u{part['width']}") if part["tokens"] else np.zeros(0, f"<u{part['width']}")
    return tokens, index[1 : n + 2], index[n + 2 : 2 * n + 2]


def read_token_files(spark: SparkSession, out_dir: str, with_ids: bool = False) -> DataFrame:
    """One row for each document in the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids."""
    ship(spark)
    parts = read_manifest(out_dir)["parts"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    if not parts:
        return spark.createDataFrame([], schema)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for k in (int(k) for f in frames for k in f["id"]):
            tokens, offsets, doc_ids = open_part(out_dir, parts[k])
            for at in range(0, len(doc_ids), 5000):
                own = range(at, min(at + 5000, len(doc_ids)))
                spans = [tokens[offsets[i] : offsets[i + 1]] for i in own]
                frame = pd.DataFrame(
                    {
                        "doc_id": pd.array([None if doc_ids[i] == NULL_ID else int(doc_ids[i]) for i in own], "Int64"),
                        "start": parts[k]["base"] + offsets[at : own.stop],
                        "n_tokens": np.diff(offsets[at : own.stop + 1]),
                        "ids_crc32": [zlib.crc32(s.astype("<u4").tobytes()) for s in spans],
                    }
                )
                if with_ids:
                    frame["ids"] = [s.astype("int64") for s in spans]
                yield frame

    return spark.range(0, len(parts), 1, len(parts)).mapInPandas(read, schema)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write docs as token files and read them back."""
    return read_token_files(docs.sparkSession, write_token_files(docs, tokenizer_path, end_id=end_id))
