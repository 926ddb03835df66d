"""Fetching the rows of few ids from a wide table without moving the others.

A bitmap of hashed ids goes to every task; rows whose bit is unset stay where they
are, the rest is joined exactly.  The bitmap has 16 bits for each id, up to
``MOST``; beyond that more rows pass it and are moved by the join, with equal results.
Bitmaps are built by Spark's own aggregates, united before they reach the driver.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.textbuf import give_back

#: Bits of a bitmap: at least, and at most (a memory of 16 MB for each worker).
LEAST, MOST = 20, 27


class Bits:
    """A bitmap of 2^width cells."""

    def __init__(self, packed: bytes, width: int):
        self.packed, self.width = packed, width
        self.raw = np.frombuffer(zlib.decompress(packed), np.uint8)

    def __reduce__(self):
        return Bits, (self.packed, self.width)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether the cells of keys (uint64, well mixed) are set; of a key its upper bits count."""
        cell = (keys >> np.uint64(64 - self.width)).astype(np.int64)
        return (self.raw[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def width_for(n: int) -> int:
    return min(max(16 * n, 1).bit_length(), MOST) if 16 * n > 1 << LEAST else LEAST


def bits_of(rows: DataFrame, key: Column, width: int) -> Bits:
    """The bitmap of the upper bits of a column of 64-bit keys."""
    cell = F.shiftrightunsigned(key, 64 - width) + 1
    pieces = rows.select(cell.alias("c")).where("c is not null").groupBy(F.bitmap_bucket_number("c").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("bits"))
    size = 1 << 12  # bytes of a piece
    out = np.zeros(max(1 << (width - 3), size), np.uint8)
    for r in pieces.collect():
        out[(r["piece"] - 1) * size : r["piece"] * size] = np.frombuffer(r["bits"], np.uint8)
    return Bits(zlib.compress(out.tobytes(), 1), width)


def bitmap(ids: DataFrame, id_col: str = "id") -> Bits:
    """The bitmap of a table of ids, sized by their count."""
    return bits_of(ids, F.xxhash64(F.col(id_col).cast("long")), width_for(ids.count()))


def maybe(rows: DataFrame, bits: Bits, id_col: str, inside: bool = True) -> DataFrame:
    """Rows whose id may be in the bitmap, or those whose id certainly isn't; no shuffle."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            cells = batch.column(len(names))
            hit = bits.has(cells.to_numpy(zero_copy_only=False).view(np.uint64)) & batch.column(len(names) + 1).to_numpy(zero_copy_only=False)
            kept = batch.select(range(len(names))).filter(pa.array(hit if inside else ~hit))
            if kept.num_rows:
                yield kept
        give_back()

    i = F.col(f"`{id_col}`").cast("long")
    marked = rows.select(*(F.col(f"`{c}`") for c in names), F.xxhash64(i).alias("__cell"), i.isNotNull().alias("__known"))
    return marked.mapInArrow(run, rows.schema)
