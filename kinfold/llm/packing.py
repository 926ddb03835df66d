"""Cost-balanced packing of token sequences (operator 6).

The cost of a piece of n tokens is estimated as ``LINEAR * n + QUADRATIC * n^2``
(projections and attention).  Documents are gathered, in the order of their
partition, into groups of ``group_tokens`` tokens; within a group whole
sequences are first cut from documents longer than a sequence, the remainders
are taken in descending cost, each going to the sequence of lowest cost with
room for it, and those without any such sequence are cut to fill the gaps, the
cheapest sequence first.  A group's capacity equals its tokens, so every
sequence is full but one per partition; what does not fill a sequence is carried
on to the next group.  No shuffle; memory is bounded by a group and a document.

Defined results: a null or empty text is its end id alone; repeated rows are
packed each; an empty table has no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.chunkenc import encoder
from kinfold.llm.textbuf import give_back, text_column

MAX_TOKENS = 4096
GROUP_TOKENS = 4096 * 192
LINEAR = 12.0 * 1024
QUADRATIC = 2.0

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
PIECES_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def cost(n, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Estimated cost of attending within one piece of n tokens."""
    return linear * n + quadratic * n * n


def pack(lengths: list[int], room: int, sequences: int, tail: int = 0) -> list[tuple[int, int, int, int]]:
    """(item, start, length, sequence) that fill ``sequences`` of ``room`` tokens and then one of ``tail``.

    The lengths sum to ``sequences * room + tail``; none exceeds ``room``.
    """
    n_seq = sequences + (tail > 0)
    left = np.full(n_seq, room, dtype=np.int64)
    if tail:
        left[-1] = tail
    load = np.zeros(n_seq)
    out: list[tuple[int, int, int, int]] = []
    uncut: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        s = int(np.argmin(np.where(left >= n, load, np.inf)))
        if left[s] < n:
            uncut.append(i)
            continue
        out.append((i, 0, n, s))
        left[s] -= n
        load[s] += cost(n)
    for i in uncut:
        at = 0
        while at < lengths[i]:
            s = int(np.argmin(np.where(left > 0, load, np.inf)))
            n = int(min(left[s], lengths[i] - at))
            out.append((i, at, n, s))
            left[s] -= n
            load[s] += cost(n)
            at += n
    return out


class Packer:
    """Groups of pieces of one partition; ``take`` documents, get batches of placed pieces."""

    def __init__(self, first_id: int, room: int = MAX_TOKENS, group_tokens: int = GROUP_TOKENS):
        self.room, self.group_tokens, self.next_id = room, group_tokens, first_id
        self.items: list[tuple[int, int, int, np.ndarray]] = []  # doc_id, start, doc_tokens, ids
        self.held = 0
        self.rows: list[tuple] = []

    def take(self, doc_id: int, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.room
        for at in range(0, whole, self.room):
            self.rows.append((doc_id, at, self.room, n, self.next_id, 0, ids[at : at + self.room]))
            self.next_id += 1
        if n > whole:
            self.items.append((doc_id, whole, n, ids[whole:]))
            self.held += n - whole

    def full(self) -> bool:
        return self.held >= self.group_tokens

    def place(self, last: bool) -> None:
        """Place what is held; unless ``last``, keep what does not fill a sequence."""
        sequences, tail = divmod(self.held, self.room)
        placed = pack([len(x[3]) for x in self.items], self.room, sequences, tail)
        offsets = [0] * (sequences + 1)
        kept = []
        for i, at, n, s in placed:
            doc, start, total, ids = self.items[i]
            if s == sequences and not last:
                kept.append((doc, start + at, total, ids[at : at + n]))
                continue
            self.rows.append((doc, start + at, n, total, self.next_id + s, offsets[s], ids[at : at + n]))
            offsets[s] += n
        self.next_id += sequences + 1
        self.items, self.held = kept, sum(len(x[3]) for x in kept)

    def drain(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows))
        self.rows = []
        flat = [x.astype("<u4").tobytes() for x in cols.pop()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(flat, pa.binary())], schema=PIECES)


def _pack_partition(path: str, end_id: int, room: int, group_tokens: int):
    def run(batches):
        from pyspark import TaskContext

        enc = encoder(path)
        packer = Packer(TaskContext.get().partitionId() << 40, room, group_tokens)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            buf, off = text_column(batch.column(1))
            for lo, ids, ends in enc.encode(buf, off):
                flat = np.insert(ids, ends[1:], np.uint16(end_id))
                ends = ends + np.arange(len(ends))
                for i in range(len(ends) - 1):
                    packer.take(docs[lo + i], flat[ends[i] : ends[i + 1]])
                    if packer.full():
                        packer.place(False)
                if len(packer.rows) >= 2000:
                    yield packer.drain()
        packer.place(True)
        if packer.rows:
            yield packer.drain()
        give_back(but="encoder")

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, room: int = MAX_TOKENS, group_tokens: int = GROUP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian u32).

    Sequence ids are unique, not dense: the partition's number is in their upper bits.
    """
    few = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return few.mapInArrow(_pack_partition(tokenizer, end_id, room, group_tokens), PIECES_SCHEMA)
