"""Token-id output as wavelet matrices (operator 2).

A shard file holds the ids of consecutive documents (ascending ``doc_id``).
Layout, little-endian:

    magic "KFWM2\0"  u16 levels  u64 tokens  u64 documents  u32 block bytes
    documents  x (i64 doc_id, i64 tokens)            one zstd frame, length first
    for each level: u64 zeros, u32 blocks, (blocks+1) x u32 end of frame,
                    (blocks+1) x u32 ones before block, frames

Each level is one bit-plane in the order of the level (zeros before ones of the
level above), cut into blocks of ``BLOCK_BYTES`` that are separate zstd frames.
The ones before each block are stored, so access and rank decompress one block a
level (rank one more for its other end), and select one a level, found by binary
search over the stored ranks; ``WaveletFile.reads`` counts them.

``access(i)``, ``rank(token, i)``, ``select(token, k)``, ``count(token)`` and
``decode()`` work on the file's bytes alone.

Defined results: a null or empty text has only the end id; a null doc_id stands
first and is kept as null (its count is stored as its complement); repeated doc_ids
keep one entry per row, in (doc_id, text) order; an empty table has no shards;
other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.chunkenc import encoder
from kinfold.llm.shared import shared_dir
from kinfold.llm.textbuf import give_back, text_column

MAGIC = b"KFWM2\0"
HEAD = struct.Struct("<6sHQQI")
LEVELS = 16
BLOCK_BYTES = 1 << 12
SHARD_TOKENS = 1 << 19

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def build(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, levels: int = LEVELS) -> bytes:
    """A shard file of ``ids`` (below 2^levels), of which ``counts[i]``, or its complement for a null id, belong to ``doc_ids[i]``."""
    pack = zstandard.ZstdCompressor(level=1)
    table = pack.compress(np.stack([doc_ids.astype("<i8"), counts.astype("<i8")], axis=1).tobytes())
    out = [HEAD.pack(MAGIC, levels, len(ids), len(doc_ids), BLOCK_BYTES), struct.pack("<I", len(table)), table]
    level = ids.astype(np.uint32 if levels > 16 else np.uint16)
    for s in range(levels - 1, -1, -1):
        ones = (level & level.dtype.type(1 << s)) != 0
        plane = np.packbits(ones).tobytes()
        frames = [pack.compress(plane[i : i + BLOCK_BYTES]) for i in range(0, len(plane), BLOCK_BYTES)]
        ends = np.cumsum([0, *map(len, frames)])
        each = np.add.reduceat(ones, np.arange(0, len(ones), 8 * BLOCK_BYTES)) if len(ones) else np.zeros(0, int)
        before = np.concatenate([[0], np.cumsum(each)])
        upper = np.compress(ones, level)
        out += [struct.pack("<QI", len(level) - len(upper), len(frames)), ends.astype("<u4").tobytes(), before.astype("<u4").tobytes(), *frames]
        level = np.concatenate([np.compress(~ones, level), upper])
    return b"".join(out)


class _Plane:
    """One bit-plane with rank, over compressed blocks."""

    def __init__(self, file: WaveletFile, at: int, block: int):
        self.file, self.n, self.block = file, file.n, block
        self.zeros, frames = struct.unpack_from("<QI", file.data, at)
        at += 12
        self.ends = np.frombuffer(file.data, "<u4", frames + 1, at)
        self.before = np.frombuffer(file.data, "<u4", frames + 1, at + 4 * (frames + 1))
        self.at = at + 8 * (frames + 1)
        self.end = self.at + int(self.ends[-1])
        self._open: tuple[int, np.ndarray] | None = None

    def bytes_of(self, k: int) -> np.ndarray:
        """Block k; the last one read is kept."""
        if self._open is None or self._open[0] != k:
            self.file.reads += 1
            raw = zstandard.ZstdDecompressor().decompress(self.file.data[self.at + int(self.ends[k]) : self.at + int(self.ends[k + 1])], max_output_size=self.block)
            self._open = k, np.frombuffer(raw, np.uint8)
        return self._open[1]

    def bits(self) -> np.ndarray:
        """The whole plane as booleans."""
        raw = [self.bytes_of(k) for k in range(len(self.ends) - 1)]
        return np.unpackbits(np.concatenate(raw), count=self.n).view(bool) if raw else np.zeros(0, bool)

    def bit(self, i: int) -> int:
        k, r = divmod(i >> 3, self.block)
        return int(self.bytes_of(k)[r]) >> (7 - (i & 7)) & 1

    def ones(self, i: int) -> int:
        """Ones before position i: those before its block, as stored, and those before it within the block."""
        k, r = divmod(i >> 3, self.block)
        got = int(self.before[min(k, len(self.before) - 1)])
        if k < len(self.before) - 1 and (r or i & 7):
            data = self.bytes_of(k)
            got += int(_POPCOUNT[data[:r]].sum())
            if i & 7:
                got += bin(int(data[r]) >> (8 - (i & 7))).count("1")
        return got

    def find(self, which: int, k: int) -> int:
        """Position of the k-th (from 0) bit of value ``which``: its block by the stored ranks, then the bit."""
        size = 8 * self.block
        before = self.before.astype(np.int64)
        if not which:
            before = np.minimum(np.arange(len(before)) * size, self.n) - before
        b = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.bytes_of(b), count=min(size, self.n - b * size))
        return b * size + int(np.flatnonzero(bits == which)[k - before[b]])


class WaveletFile:
    """Queries on one shard file."""

    def __init__(self, data: bytes):
        self.data, self.reads = memoryview(data), 0
        magic, self.levels, self.n, self.n_docs, block = HEAD.unpack_from(self.data)
        if magic != MAGIC:
            raise ValueError("not a shard file")
        (size,) = struct.unpack_from("<I", self.data, HEAD.size)
        at = HEAD.size + 4
        raw = zstandard.ZstdDecompressor().decompress(self.data[at : at + size], max_output_size=16 * self.n_docs + 16)
        table = np.frombuffer(raw, "<i8").reshape(-1, 2)
        self.known = table[:, 1] >= 0  # whether a document's id is not null
        self.doc_ids, self.counts = table[:, 0], np.where(self.known, table[:, 1], ~table[:, 1])
        at += size
        self.planes = []
        for _ in range(self.levels):
            self.planes.append(_Plane(self, at, block))
            at = self.planes[-1].end

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for p in self.planes:
            b = p.bit(i)
            value = value << 1 | b
            i = p.zeros + p.ones(i) if b else i - p.ones(i)
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for s, p in zip(range(self.levels - 1, -1, -1), self.planes):
            if token >> s & 1:
                lo, hi = p.zeros + p.ones(lo), p.zeros + p.ones(hi)
            else:
                lo, hi = lo - p.ones(lo), hi - p.ones(hi)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before position i."""
        lo, hi = self._range(token, 0, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``, or -1."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for s, p in zip(range(self.levels), reversed(self.planes)):
            i = p.find(1, i - p.zeros) if token >> s & 1 else p.find(0, i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, by undoing the levels from the last to the first."""
        dtype = np.uint32 if self.levels > 16 else np.uint16
        level = np.zeros(self.n, dtype=dtype)
        for s, p in zip(range(self.levels), reversed(self.planes)):
            ones = p.bits()
            up = np.empty(self.n, dtype=dtype)
            up[np.flatnonzero(~ones)] = level[: p.zeros]
            up[np.flatnonzero(ones)] = level[p.zeros :] | dtype(1 << s)
            level = up
        return level

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in the order of the file."""
        ids, at = self.decode(), 0
        for d, known, n in zip(self.doc_ids.tolist(), self.known, self.counts.tolist()):
            yield d if known else None, ids[at : at + n]
            at += n


def _encode_shards(path: str, end_id: int, shard_tokens: int):
    def run(batches):
        from pyspark import TaskContext

        enc, pid = encoder(path), TaskContext.get().partitionId()
        docs: list = []
        counts: list = []
        parts: list = []
        held, seq = 0, 0

        def flush():
            nonlocal held, seq
            flat = np.concatenate(parts)
            d, c = np.concatenate(docs), np.concatenate(counts)
            row = {"shard": [(pid << 32) + seq], "n_tokens": [len(flat)], "payload": [build(d, c, flat)]}
            docs.clear(), counts.clear(), parts.clear()
            held, seq = 0, seq + 1
            return pa.RecordBatch.from_pydict(row, schema=SHARD_ARROW)

        for batch in batches:
            ids_of, unknown = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            buf, off = text_column(batch.column(1))
            for lo, ids, ends in enc.encode(buf, off):
                n = len(ends) - 1
                flat = np.insert(ids, ends[1:], np.uint16(end_id))
                parts.append(flat)
                docs.append(ids_of[lo : lo + n])
                size = np.diff(ends) + 1
                counts.append(np.where(unknown[lo : lo + n], ~size, size))
                held += len(flat)
                if held >= shard_tokens:
                    yield flush()
        if held:
            yield flush()
        give_back(but="encoder")

    return run


SHARD_ARROW = pa.schema([("shard", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])
SHARD_SCHEMA = "shard long, n_tokens long, payload binary"


def write_shards(docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write shard files of a table's whole texts, in ascending id order, below ``out``.

    Each row written is one shard file (``payload``) with its number; numbers
    ascend with ``id_col``.  One range exchange of (id, text); shards are cut by
    tokens while streaming, so memory is bounded by a shard and a document.
    """
    spark = docs.sparkSession
    few = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    ordered = few.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(_encode_shards(tokenizer, end_id, shard_tokens), SHARD_SCHEMA)
    shards.write.option("compression", "none").mode("overwrite").parquet(out)


def _decode_shards(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    for batch in batches:
        for base, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            f = WaveletFile(payload.as_buffer())
            raw = f.decode().astype("<u4")
            ends = np.cumsum(f.counts)
            starts = ends - f.counts
            for lo in range(0, f.n_docs, 2048):
                hi = min(lo + 2048, f.n_docs)
                off = np.concatenate([starts[lo:hi], ends[hi - 1 : hi]])
                part = raw[off[0] : off[-1]]
                body = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(((off - off[0]) * 4).astype(np.int32)), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids[lo:hi], mask=~f.known[lo:hi]), pa.array(starts[lo:hi] + base), pa.array(f.counts[lo:hi]), body], schema=schema)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all shards below ``path``; ids little-endian unsigned 32 bits.

    ``start`` is the number of ids of all documents before it.  A shard's number has
    the task that wrote it in its upper bits, so running sums are made in two steps:
    one row per task over all, then the shards of each task by themselves.
    """
    shards = spark.read.parquet(path)
    sizes = shards.select("shard", F.shiftright("shard", 32).alias("task"), "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = sizes.groupBy("task").agg(F.sum("n_tokens").alias("n_tokens")).select("task", before(Window.orderBy("task")).alias("first"))
    bases = sizes.join(tasks, "task").select("shard", (F.col("first") + before(Window.partitionBy("task").orderBy("shard"))).alias("base"))
    return shards.select("shard", "payload").join(bases, "shard").select("base", "payload").mapInArrow(_decode_shards, "doc_id long, start long, n_tokens long, ids binary")


def encode_to_shards(docs: DataFrame, tokenizer: str, end_id: int = 2, **kw) -> DataFrame:
    """Write a table's shards into the shared folder and read them back."""
    out = f"{shared_dir(docs.sparkSession)}/wavelet-{uuid.uuid4().hex}"
    write_shards(docs, tokenizer, out, end_id, **kw)
    return read_shards(docs.sparkSession, out)
