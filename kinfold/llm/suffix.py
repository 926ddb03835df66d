"""Removal of repeated byte strings by bucket-pointer refinement (operator 9).

All starts of ``length``-byte strings are sorted into buckets that are refined by
the bucket identifiers of longer and later parts of the strings; a bucket with a
single start is finished, as in bucket-pointer suffix sorting.  An identifier is
a key of 64 bits, so every task names buckets alike without a global sort; where
equal identifiers decide that bytes go, 31 bits modulo a prime must agree as well.
Only the counts of identifiers are exchanged, pre-aggregated, so a bucket of any
size costs each task one row.

Level 0  The q-gram of a start is the smallest (by hash) of the q-grams inside
         its string; neighbouring starts share it and form a node.  Nodes whose
         q-gram occurs once are finished.
Level 1  Each other node is split into ranges of ``WIDE`` starts; a range whose core
         (the intersection of its strings) occurs once is finished.  The starts of
         a node that is left all repeat if its whole hull (the union of its strings)
         occurs again; the node is closed.
Level 2  The rest is split into ranges of ``RANGE`` starts: one whose core occurs
         once is finished, one whose hull occurs again repeats as a whole.
Level 3  What is left, the ends of repeated passages, is refined to single starts.

Equal strings have equal q-grams, so from level 2 on the hulls of the nodes that are
left stand in a table and are refined in slices by the q-gram's key, one after the
other.  There are so many slices that the identifiers of one fit a bitmap, so what
a slice moves does not grow with the input.  In a slice the open nodes first name the
identifiers they ask for, and all nodes then count those.

Between levels every task gets bitmaps of identifiers, of 16 bits for each up to 2^27
bits.  A false hit only leaves a range to the next level, so results do not depend
on them; beyond that size levels 0 and 1 leave more to the table.  Level 3 is exact on
identifiers with their checks.

Defined results: a null or empty text, or one shorter than ``length``, loses
nothing; strings may overlap themselves; repeated rows repeat each other; null and
repeated ids are allowed; an empty table gives no rows; other columns are ignored, or
kept as they are by ``without_repeats``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import idfilter
from kinfold.llm.idfilter import Bits, bits_of, width_for
from kinfold.llm.shared import discard, release, saved
from kinfold.llm.textbuf import PrefixHash, blocks, expand, give_back, mix64, text_column, text_keys

LENGTH = 200
GRAM = 50
WIDE = 64
RANGE = 16
BLOCK = 128 << 10
SEGMENT = 512 << 10
#: Slices are cut from so many parts, for a bitmap at its most to have so many bits for each narrow range of a slice.
PARTS, SLICE_BITS = 1 << 16, 8

_U, _N, _S, _W, _V = (np.uint64(0x9E3779B97F4A7C15 * k % 2**64) for k in (3, 5, 7, 11, 13))
NO_ID = -(2**63)


def segments(off: np.ndarray, length: int):
    """(first byte, offsets) of blocks of documents; a long document is cut into segments.

    Segments overlap by length - 1 bytes, so each start belongs to one of them.
    """
    for lo, hi in blocks(off, BLOCK):
        if hi - lo > 1 or off[hi] - off[lo] <= SEGMENT:
            yield lo, int(off[lo]), off[lo : hi + 1] - off[lo]
            continue
        for at in range(int(off[lo]), max(int(off[lo]) + 1, int(off[hi]) - length + 1), SEGMENT):
            yield lo, at, np.array([0, min(SEGMENT + length - 1, int(off[hi]) - at)], dtype=np.int64)


class Nodes:
    """The nodes of one block: runs of starts lo..hi that share the q-gram at ``gram``."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, length: int, q: int):
        self.length, self.q = length, q
        n, w = len(buf), length - q + 1
        self.hash = PrefixHash(buf)
        self.lo = self.hi = self.gram = np.zeros(0, np.int64)
        if n < length:
            return
        order = mix64(self.hash.every(q))
        order &= np.uint64(2**64 - 2**24)
        order |= np.arange(n - q + 1, dtype=np.uint64)  # ties go to the first
        least, span = order, 1
        while span < w:  # minima of windows, twice as wide each time
            step = min(span, w - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        gram = (least & np.uint64(2**24 - 1)).astype(np.int64)
        size = np.maximum(np.diff(off) - length + 1, 0)
        p = expand(off[:-1], size)
        if not len(p):
            return
        g = gram[p]
        cut = np.concatenate([[0], np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1] + 1)) + 1])
        self.lo, self.hi, self.gram = p[cut], p[np.append(cut[1:], len(p)) - 1], g[cut]

    @classmethod
    def of_hulls(cls, buf: np.ndarray, off: np.ndarray, last: np.ndarray, gram: np.ndarray, length: int, q: int) -> Nodes:
        """Nodes from their concatenated hulls."""
        x = cls.__new__(cls)
        x.length, x.q, x.hash = length, q, PrefixHash(buf)
        x.lo, x.hi, x.gram = off[:-1], off[:-1] + last, off[:-1] + gram
        return x

    def keep(self, which: np.ndarray) -> None:
        self.lo, self.hi, self.gram = self.lo[which], self.hi[which], self.gram[which]

    def gram_keys(self) -> np.ndarray:
        # mixed once more than for their order: the smallest ones would crowd the lowest cells of a bitmap
        return mix64(mix64(self.hash.slices(self.gram, self.gram + self.q)) + _U)

    def hull_checks(self, lo=None, hi=None) -> np.ndarray:
        lo, hi = (self.lo, self.hi) if lo is None else (lo, hi)
        return self.hash.checks(lo, hi + self.length)

    def hull_keys(self, lo=None, hi=None, salt=_U) -> np.ndarray:
        lo, hi = (self.lo, self.hi) if lo is None else (lo, hi)
        return mix64(self.hash.slices(lo, hi + self.length) + salt * (hi - lo + 1).astype(np.uint64))

    def ranges(self, width: int = WIDE):
        """(node, range number, first start, last start) of all ranges of the nodes."""
        low, high = (self.gram - self.hi) // width, (self.gram - self.lo) // width
        count = high - low + 1
        node = np.repeat(np.arange(len(low)), count)
        return self.within(node, expand(low, count), width)

    def within(self, node: np.ndarray, s: np.ndarray, width: int):
        gram = self.gram[node]
        return node, s, np.maximum(gram - (s * width + width - 1), self.lo[node]), np.minimum(gram - s * width, self.hi[node])

    def split(self, node: np.ndarray, s: np.ndarray):
        """The narrow ranges of wide ones."""
        per = WIDE // RANGE
        node, s, lo, hi = self.within(np.repeat(node, per), np.repeat(s * per, per) + np.tile(np.arange(per), len(s)), RANGE)
        real = lo <= hi
        return node[real], s[real], lo[real], hi[real]

    def core_keys(self, node: np.ndarray, s: np.ndarray, width: int) -> np.ndarray:
        at = self.gram[node] - s * width
        return mix64(self.hash.slices(at, at + self.length - width + 1) + (_N if width == RANGE else _V) * (s + 1).astype(np.uint64))

    def start_keys(self, p: np.ndarray) -> np.ndarray:
        return mix64(self.hash.slices(p, p + self.length) + _W)

    def start_checks(self, p: np.ndarray) -> np.ndarray:
        return self.hash.checks(p, p + self.length)


def _table(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in cols.values()], names=list(cols))


def _texts(batches):
    for batch in batches:
        buf, off = text_column(batch.column(batch.num_columns - 1))
        yield batch, buf, off
    give_back()


def _gram_counts(length: int, q: int):
    def run(batches):
        for _, buf, off in _texts(batches):
            for _, at, o in segments(off, length):
                keys, n = np.unique(Nodes(buf[at : at + o[-1]], o, length, q).gram_keys(), return_counts=True)
                yield _table(key=keys.view(np.int64), n=n)

    return run


COUNTS = "key long, check int, n int"
NARROW_COUNTS = f"{COUNTS}, kind int"


def _distinct(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, checks, counts) of distinct pairs."""
    order = np.lexsort((checks, keys))
    keys, checks = keys[order], checks[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    at = np.flatnonzero(new)
    return keys[at], checks[at], np.diff(np.append(at, len(keys)))


def _counted(*kinds) -> pa.RecordBatch:
    """Rows (key, check, n, kind) of distinct identifiers by kind; those without checks have 0."""
    each = [(k, *_distinct(keys, np.zeros(len(keys), np.int32) if checks is None else checks)) for k, keys, checks in kinds]
    return _table(
        key=np.concatenate([x[1] for x in each]).view(np.int64),
        check=np.concatenate([x[2] for x in each]),
        n=np.concatenate([x[3] for x in each]).astype(np.int32),
        kind=np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in each]),
    )


def _wide_counts(length: int, q: int, grams: Bits):
    """Identifiers of the cores of wide ranges."""

    def run(batches):
        for _, buf, off in _texts(batches):
            for _, at, o in segments(off, length):
                x = Nodes(buf[at : at + o[-1]], o, length, q)
                x.keep(grams.has(x.gram_keys()))
                node, s, _, _ = x.ranges()
                keys, n = np.unique(x.core_keys(node, s, WIDE), return_counts=True)
                yield _table(key=keys.view(np.int64), n=n)

    return run


class Levels:
    """What is known of the texts, as bitmaps.

    grams: repeated q-grams; wide: repeated cores of wide ranges; hulls: unrepeated
    hulls of nodes with such a range.
    """

    def __init__(self, grams: Bits, wide: Bits, hulls: Bits | None = None):
        self.grams, self.wide, self.hulls = grams, wide, hulls

    def candidates(self, x: Nodes) -> None:
        """Keep the nodes with a repeated q-gram and a wide range with a repeated core."""
        x.keep(self.grams.has(x.gram_keys()))
        node, s, _, _ = x.ranges()
        left = np.zeros(len(x.lo), bool)
        left[node[self.wide.has(x.core_keys(node, s, WIDE))]] = True
        x.keep(left)


def _hull_counts(length: int, q: int, known: Levels):
    """Identifiers of the hulls of nodes that are left."""

    def run(batches):
        for _, buf, off in _texts(batches):
            for _, at, o in segments(off, length):
                x = Nodes(buf[at : at + o[-1]], o, length, q)
                known.candidates(x)
                keys, checks, n = _distinct(x.hull_keys(), x.hull_checks())
                yield _table(key=keys.view(np.int64), check=checks, n=n.astype(np.int32))

    return run


NODES = "part int, open boolean, id long, print long, at long, last int, gram int, hull binary"


def _nodes(length: int, q: int, known: Levels):
    """The nodes that are left, with their hulls: each open one, and one closed of each hull in a block."""

    def run(batches):
        for batch, buf, off in _texts(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            prints = text_keys(buf, off).view(np.int64)
            for doc, at, o in segments(off, length):
                text = buf[at : at + o[-1]]
                x = Nodes(text, o, length, q)
                known.candidates(x)
                keys, checks = x.hull_keys(), x.hull_checks()
                is_open = known.hulls.has(keys)
                order = np.lexsort((checks, keys))
                keys, checks = keys[order], checks[order]
                again = np.zeros(len(order), bool)
                again[order[1:]] = (keys[1:] == keys[:-1]) & (checks[1:] == checks[:-1])
                left = is_open | ~again
                x.keep(left)
                if not len(x.lo):
                    continue
                place = doc + np.searchsorted(o, x.lo, side="right") - 1
                size = x.hi - x.lo + length
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                hulls = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(text[expand(x.lo, size)])])
                part = (x.gram_keys() >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int32)
                yield _table(
                    part=part, open=is_open[left], id=ids[place], print=prints[place], at=at + x.lo - off[place],
                    last=(x.hi - x.lo).astype(np.int32), gram=(x.gram - x.lo).astype(np.int32), hull=hulls,
                )

    return run


class Slice:
    """Levels 2 and 3 on the nodes of one slice; rows (open, id, print, at, last, gram, hull).

    wide: as in Levels; cores, parts: repeated cores and unrepeated hulls of narrow ranges.
    """

    def __init__(self, length: int, q: int, wide: Bits, cores: Bits | None = None, parts: Bits | None = None):
        self.length, self.q, self.wide, self.cores, self.parts = length, q, wide, cores, parts

    def stored(self, batches):
        """(columns open, id, print, at; nodes) of blocks of rows."""
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:6]]
            buf, off = text_column(batch.column(6))
            for lo, hi in blocks(off, BLOCK):
                *which, last, gram = (c[lo:hi] for c in cols)
                yield which, Nodes.of_hulls(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], last, gram, self.length, self.q)
        give_back()

    def narrow(self, x: Nodes):
        """Narrow ranges in the wide ones with a repeated core."""
        node, s, _, _ = x.ranges()
        again = self.wide.has(x.core_keys(node, s, WIDE))
        return x.split(node[again], s[again])

    def settle(self, x: Nodes, is_open: np.ndarray):
        """(node, first, last, whether all starts repeat, whether they may) of ranges whose core repeats; of open nodes."""
        node, s, lo, hi = self.narrow(x)
        again = self.cores.has(x.core_keys(node, s, RANGE))
        node, lo, hi = node[again], lo[again], hi[again]
        mine = is_open[node]
        unsure = np.zeros(len(lo), bool)
        unsure[mine] = self.parts.has(x.hull_keys(lo[mine], hi[mine], _S))
        return node, lo, hi, mine & ~unsure, unsure

    def asked(self, batches):
        """Identifiers that the open nodes ask for at level 2."""
        for (is_open, *_), x in self.stored(batches):
            node, s, lo, hi = self.narrow(x)
            mine = is_open[node]
            keys = np.concatenate([x.core_keys(node[mine], s[mine], RANGE), x.hull_keys(lo[mine], hi[mine], _S)])
            yield _table(key=np.unique(keys).view(np.int64))

    def counts(self, asked: Bits):
        """Counts, over all nodes, of the asked identifiers: cores (kind 1) and hulls (2) of narrow ranges."""

        def run(batches):
            for _, x in self.stored(batches):
                node, s, lo, hi = self.narrow(x)
                cores, hulls = x.core_keys(node, s, RANGE), x.hull_keys(lo, hi, _S)
                hit = asked.has(hulls)
                yield _counted((1, cores[asked.has(cores)], None), (2, hulls[hit], x.hull_checks(lo[hit], hi[hit])))

        return run

    def sure_runs(self, batches):
        """Runs of starts that repeat by level 2."""
        for (is_open, ids, prints, at), x in self.stored(batches):
            node, lo, hi, sure, _ = self.settle(x, is_open)
            node, lo, hi = node[sure], lo[sure], hi[sure]
            first = at[node] + lo - x.lo[node]
            yield _table(id=ids[node], print=prints[node], first=first, last=first + hi - lo)

    def open_starts(self, batches):
        for (is_open, *_), x in self.stored(batches):
            _, lo, hi, _, unsure = self.settle(x, is_open)
            p = expand(lo[unsure], (hi - lo + 1)[unsure])
            yield _table(key=np.unique(x.start_keys(p)).view(np.int64))

    def start_counts(self, wanted: Bits):
        """Counts, over all ranges with a repeated core, of the wanted starts."""

        def run(batches):
            for (is_open, *_), x in self.stored(batches):
                _, lo, hi, _, _ = self.settle(x, is_open)
                p = expand(lo, hi - lo + 1)
                keys = x.start_keys(p)
                hit = wanted.has(keys)
                keys, checks, n = _distinct(keys[hit], x.start_checks(p[hit]))
                yield _table(key=keys.view(np.int64), check=checks, n=n.astype(np.int32))

        return run

    def start_places(self, again: Bits):
        """Places of the open starts that may repeat."""

        def run(batches):
            for (is_open, ids, prints, at), x in self.stored(batches):
                node, lo, hi, _, unsure = self.settle(x, is_open)
                size = (hi - lo + 1)[unsure]
                p, node = expand(lo[unsure], size), np.repeat(node[unsure], size)
                keys = x.start_keys(p)
                hit = again.has(keys)
                p, keys, node = p[hit], keys[hit], node[hit]
                yield _table(key=keys.view(np.int64), check=x.start_checks(p), id=ids[node], print=prints[node], first=at[node] + p - x.lo[node])

        return run


RUNS = "id long, print long, first long, last long"


def _refined(nodes: DataFrame, length: int, q: int, wide: Bits, width: int) -> DataFrame:
    """Levels 2 and 3 on a slice: runs of starts of its open nodes that repeat."""
    key, at = F.col("key"), Slice(length, q, wide)
    rows = nodes.select("open", "id", "print", "at", "last", "gram", "hull")
    open_rows = rows.where("open")
    asked = bits_of(open_rows.mapInArrow(at.asked, "key long"), key, width)
    found = rows.mapInArrow(at.counts(asked), NARROW_COUNTS).groupBy("kind", "key", "check").agg(F.sum("n").alias("n"))
    found = saved(found.where("(kind = 1 and n > 1) or (kind = 2 and n = 1)").select("kind", "key"))
    at = Slice(length, q, wide, *(bits_of(found.where(F.col("kind") == k), key, width) for k in (1, 2)))
    discard(found)
    wanted = bits_of(open_rows.mapInArrow(at.open_starts, "key long"), key, width)
    starts = rows.mapInArrow(at.start_counts(wanted), COUNTS).groupBy("key", "check").agg(F.sum("n").alias("n"))
    again = saved(starts.where("n > 1").select("key", "check"))
    places = open_rows.mapInArrow(at.start_places(bits_of(again, key, width)), "key long, check int, id long, print long, first long")
    hits = places.join(again, ["key", "check"]).select("id", "print", "first", F.col("first").alias("last"))
    got = saved(hits.unionAll(open_rows.mapInArrow(at.sure_runs, RUNS)))
    discard(again)
    return got


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
EMIT = 8 << 20


def cut(text: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[list[tuple[int, int]], bytes]:
    """(maximal removed runs, remaining bytes) for runs of repeated starts."""
    spans: list[tuple[int, int]] = []
    for a, b in sorted(zip(first.tolist(), (last + length).tolist())):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    keep, at = [], 0
    for a, b in spans:
        keep.append(text[at:a].tobytes())
        at = b
    keep.append(text[at:].tobytes())
    return spans, b"".join(keep)


def _results(batch, more, length, q, known, as_text):
    """The rows of a batch (.., text) with n_bytes, n_removed, spans, kept for the text; more: further runs of starts of each."""
    buf, off = text_column(batch.column(batch.num_columns - 1))
    n = len(off) - 1
    found: list[list] = [[] for _ in range(n)]
    for doc, at, o in segments(off, length):
        x = Nodes(buf[at : at + o[-1]], o, length, q)
        known.candidates(x)
        closed = ~known.hulls.has(x.hull_keys())
        first, last = x.lo[closed], x.hi[closed]
        place = doc + np.searchsorted(o, first, side="right") - 1
        shift = at - off[place]
        for d, a, b in zip(place.tolist(), (first + shift).tolist(), (last + shift).tolist()):
            found[d].append((a, b))
    for lo, hi in blocks(off, EMIT):
        removed, all_spans, all_kept = [], [], []
        for i in range(lo, hi):
            runs = np.array(found[i], dtype=np.int64).reshape(-1, 2)
            if more:
                runs = np.concatenate([runs, more[i]])
            spans, kept = cut(buf[off[i] : off[i + 1]], runs[:, 0], runs[:, 1], length)
            removed.append(sum(b - a for a, b in spans))
            all_spans.append([{"start": a, "end": b} for a, b in spans])
            all_kept.append(kept.decode("utf-8", "ignore") if as_text else kept)
        new = [pa.array(np.diff(off[lo : hi + 1])), pa.array(removed, pa.int64()), pa.array(all_spans, SPANS), pa.array(all_kept, pa.string() if as_text else pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *new], names=["row", "n_bytes", "n_removed", "spans", "kept"])


def _finish_sure(length, q, known, touched, as_text):
    """Documents without starts from level 2; rows (row, text)."""

    def run(batches):
        for batch, buf, off in _texts(batches):
            sure = pa.array(~touched.has(text_keys(buf, off)))
            yield from _results(batch.filter(sure), None, length, q, known, as_text)

    return run


def _maybe_touched(touched):
    """Rows (id, row, text), and the text's fingerprint, of documents that may have starts from level 2."""

    def run(batches):
        for batch, buf, off in _texts(batches):
            prints = text_keys(buf, off)
            hit = pa.array(touched.has(prints))
            cols = [batch.column(0), pa.array(prints.view(np.int64)), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays([c.filter(hit) for c in cols], names=["i", "print", "row", "text"])

    return run


def _finish_touched(length, q, known, as_text):
    """Rows (row, more, text)."""

    def run(batches):
        for batch in batches:
            col = batch.column(1)
            runs = np.stack([col.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False))
            yield from _results(batch.select([0, 2]), np.split(runs, ends[:-1]), length, q, known, as_text)

    return run


def _repeats(docs: DataFrame, length: int, gram: int, id_col: str, text_col: str, carry: list[str], as_text: bool) -> DataFrame:
    """(row, n_bytes, n_removed, spans, kept): row is a struct of the columns ``carry``, by position."""
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry))) if carry else F.struct(F.lit(0).alias("c"))
    full = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), row.alias("row"), F.col(text_col).cast("string").alias("text"))
    texts = full.select("id", "text")
    only = full.select("text")
    key = F.col("key")
    counted = lambda rows, keep: saved(rows.groupBy(*[c for c in rows.columns if c != "n"]).agg(F.sum("n").alias("n")).where(keep).select("key"))

    def bits(ids: DataFrame) -> Bits:
        got = bits_of(ids, key, width_for(ids.count()))
        discard(ids)
        return got

    grams = bits(counted(only.mapInArrow(_gram_counts(length, gram), "key long, n long"), "n > 1"))
    known = Levels(grams, bits(counted(only.mapInArrow(_wide_counts(length, gram, grams), "key long, n long"), "n > 1")))
    known.hulls = bits(counted(only.mapInArrow(_hull_counts(length, gram, known), COUNTS), "n = 1"))

    nodes = saved(texts.mapInArrow(_nodes(length, gram, known), NODES).sortWithinPartitions("part"))
    release(docs.sparkSession)
    ranges = nodes.agg(F.coalesce(F.sum(F.expr(f"if(open, last div {RANGE} + 2, 0)")), F.lit(0)).alias("n")).first()["n"]
    slices = min(max(1, -(-ranges * SLICE_BITS >> idfilter.MOST)), PARTS)
    runs = None
    for k in range(slices):
        lo, hi = k * PARTS // slices, (k + 1) * PARTS // slices
        got = _refined(nodes.where(f"part >= {lo} and part < {hi}"), length, gram, known.wide, width_for(ranges // (2 * slices)))
        if runs is None:
            runs = got
        else:
            got.write.mode("append").parquet(runs._kinfold_path)
            discard(got)
            release(docs.sparkSession)
    discard(nodes)
    runs = docs.sparkSession.read.schema(RUNS).parquet(runs._kinfold_path) if slices > 1 else runs
    hits = saved(runs.groupBy("id", "print").agg(F.collect_set(F.struct("first", "last")).alias("more")))
    touched = bits_of(hits, F.col("print"), width_for(hits.count()))
    hits = hits.withColumnRenamed("id", "i")

    kind = full.schema["row"].dataType.simpleString()
    result = f"row {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}"
    sure = full.select("row", "text").mapInArrow(_finish_sure(length, gram, known, touched, as_text), result)
    rest = full.mapInArrow(_maybe_touched(touched), f"i long, print long, row {kind}, text string").join(hits, ["i", "print"], "left")
    return sure.unionAll(rest.select("row", "more", "text").mapInArrow(_finish_touched(length, gram, known, as_text), result))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) for every row: bytes covered by a repeated string are removed.

    ``spans`` are the maximal removed runs, as byte offsets; ``kept`` the remaining bytes.
    """
    got = _repeats(docs, length, gram, id_col, text_col, [id_col], False)
    return got.select(F.col("row.c0").cast("long").alias("id"), "n_bytes", "n_removed", "spans", "kept")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without its repeated strings.

    A character that a cut leaves incomplete goes as well; a null text becomes empty.
    """
    carry = [c for c in docs.columns if c != text_col]
    got = _repeats(docs, length, gram, id_col, text_col, carry, True)
    place = {c: F.col(f"row.c{i}") for i, c in enumerate(carry)}
    return got.select(*(F.col("kept").alias(c) if c == text_col else place[c].alias(c) for c in docs.columns))
