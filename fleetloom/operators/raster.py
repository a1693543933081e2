"""Lines, rectangles and histograms as cells of a picture; the cells are the product, a PNG of them is made by the driver for small pictures."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_cells(df: DataFrame, c1: Column, r1: Column, c2: Column, r2: Column) -> DataFrame:
    """df with pic_row and pic_col: a row for each cell of the line between two cells, one for each step of its longer axis.

    The other axis is rounded half up, so the cells are those of the classic integer walk, in closed form and without state.
    """
    n = F.greatest(F.abs(c2 - c1), F.abs(r2 - r1))
    out = df.withColumns({"_c1": c1, "_r1": r1, "_c2": c2, "_r2": r2, "_n": n}).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long"))))
    at = lambda a, b: F.when(F.col("_n") == 0, F.col(a)).otherwise(F.floor((2 * F.col(a) * F.col("_n") + 2 * F.col("_i") * (F.col(b) - F.col(a)) + F.col("_n")) / (2 * F.col("_n"))))
    return out.withColumns({"pic_row": at("_r1", "_r2").cast("long"), "pic_col": at("_c1", "_c2").cast("long")}).drop("_c1", "_r1", "_c2", "_r2", "_n", "_i")


def rectangle_cells(df: DataFrame, c1: Column, r1: Column, c2: Column, r2: Column) -> DataFrame:
    """The four sides of rectangles, corners once."""
    sides = [(c1, r1, c2, r1), (c1, r2, c2, r2), (c1, r1, c1, r2), (c2, r1, c2, r2)]
    out = None
    for s in sides:
        one = line_cells(df, *s)
        out = one if out is None else out.union(one)
    return out.distinct()


def png(cells: DataFrame, width: int, height: int, level: str = "level", most: int = 4_000_000) -> bytes:
    """A grey picture of cells (hist_row, hist_col, level 0 to 255), row 0 at the bottom. The picture's size bounds what the driver gets."""
    if width * height > most:
        raise ValueError("the picture is too large for the driver")
    rows = [bytearray(width) for _ in range(height)]
    for r in cells.select("hist_row", "hist_col", level).collect():
        rows[height - 1 - r[0]][r[1]] = int(r[2])
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    body = zlib.compress(b"".join(b"\0" + bytes(r) for r in rows))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b"")
