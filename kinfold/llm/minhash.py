"""Near-duplicate documents by SuperMinHash (operator 1).

1. Each document's set of distinct word shingles gives a size, a fingerprint of
   128 bits, a SuperMinHash signature and band keys; no text moves.
2. Documents of equal sets are folded into one, which gets a number of its own.
3. Within each band bucket one member, drawn by hash, is the pivot; every other
   member keeps its most similar pivot (by signature) and the pair is confirmed
   on full sets.  That unites large groups with one pair per document.
4. Buckets that still hold several components are compared in full: blocks of
   signatures first, then full sets of members with a similar one in another
   component, each pair in the first bucket that it shares.  No pair is emitted but the links found, and no bucket is capped:
   large ones are spread over pairs of blocks.
5. Links are united into components, named by their smallest doc_id.

Signatures only choose what is compared; links are decided on full sets.  A pair
at the threshold escapes all ``bands`` buckets with probability
(1 - t^rows)^bands, 3e-6 at t = 0.8; its signature falls short of the threshold by
``MARGIN``, four standard errors of 160 slots, with probability 6e-5 (fewer for
SuperMinHash, whose variance is lower).

Defined results: a null or empty text, or one without words, has an empty set and
links with nothing; a text of fewer than k words is one shingle; a null id is
its own component and kept; repeated ids are each a row of the result, linked by
the text of that row; an empty table gives no rows; other columns are ignored, or
kept as they are by ``drop_near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.idfilter import bitmap, maybe
from kinfold.llm.shared import discard, saved
from kinfold.llm.superminhash import band_keys, shingle_sets, signatures
from kinfold.llm.textbuf import blocks, give_back, mix64, text_column
from kinfold.operators.components import connected_components

WORDS, PERCENT = 5, 80
BANDS, ROWS = 32, 5
MARGIN = 0.12  # signature estimates below the threshold by more are not confirmed: four standard errors
BLOCK = 256 << 10
#: Members of a cell of step 4, and the shingles that they hold together.
BUCKET, SHINGLES = 2048, 1 << 20

SKETCH = "doc_id long, mark long, n long, fp1 long, fp2 long, keys array<long>, sig binary"


def _sketch(k: int, bands: int, rows: int):
    m = bands * rows

    def run(batches):
        for batch in batches:
            buf, off = text_column(batch.column(2))
            for lo, hi in blocks(off, BLOCK):
                h, first = shingle_sets(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], k)
                sig = signatures(h, first, m)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (h, mix64(h))]
                fps = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
                keys = band_keys(sig, bands, rows).view(np.int64)
                low = np.ascontiguousarray((sig & np.uint64(255)).astype(np.uint8))
                n = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, n),
                        batch.column(1).slice(lo, n),
                        pa.array(np.diff(first)),
                        pa.array(fps[0]),
                        pa.array(fps[1]),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), pa.array(keys.ravel())),
                        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * m + 1, m, dtype=np.int32)), pa.py_buffer(low)]),
                    ],
                    names=["doc_id", "mark", "n", "fp1", "fp2", "keys", "sig"],
                )
        give_back()

    return run


def _bytes2d(col: pa.Array, m: int) -> np.ndarray:
    buf, _ = text_column(col)
    return buf.reshape(-1, m)


def _alike(m: int, least: float):
    """(a, b, est) of pairs whose signatures agree in a share of at least ``least``."""

    def run(batches):
        for batch in batches:
            x, y = _bytes2d(batch.column(2), m), _bytes2d(batch.column(3), m)
            est = (x == y).mean(axis=1) if len(x) else np.zeros(0)
            keep = pa.array(est >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(est[est >= least])], names=["a", "b", "est"])

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(col: pa.Array, k: int) -> list[np.ndarray]:
    buf, off = text_column(col)
    out: list[np.ndarray] = []
    for lo, hi in blocks(off, BLOCK):
        h, first = shingle_sets(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], k)
        out += [h[a:b] for a, b in zip(first[:-1], first[1:])]
    return out


def _confirm(k: int, percent: int):
    """(src, dst) of the pairs that are linked on full sets."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                one, two = _sets(part.column(2), k), _sets(part.column(3), k)
                good = pa.array([_linked(x, y, percent) for x, y in zip(one, two)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(good), part.column(1).filter(good)], names=["src", "dst"])

    return run


def _runs(batches, keys: int, change=None):
    """Rows grouped by their first columns, for sorted batches; each as a list of tuples.

    ``change`` makes something smaller of the last column of some rows at a time.
    """
    key, held = None, []
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            cols = [part.column(i).to_pylist() if change is None or i < part.num_columns - 1 else change(part.column(i)) for i in range(part.num_columns)]
            for row in zip(*cols):
                if row[:keys] != key:
                    if held:
                        yield key, held
                    key, held = row[:keys], []
                held.append(row[keys:])
    if held:
        yield key, held


def _first_band(equal: np.ndarray, rows: int) -> np.ndarray:
    """The first band in which pairs agree, given where their signatures do."""
    return equal.reshape(len(equal), equal.shape[1] // rows, rows).all(axis=2).argmax(axis=1)


def _near(sig: np.ndarray, x: int, others: np.ndarray, least: float, rows: int, band: int) -> np.ndarray:
    """Those of ``others`` with a signature similar to x's, of pairs whose first common band is this one: a pair has one cell."""
    out = []
    for lo in range(0, len(others), 4096):
        y = others[lo : lo + 4096]
        equal = sig[y] == sig[x]
        some = equal.mean(axis=1) >= least
        y, equal = y[some], equal[some]
        out.append(y[_first_band(equal, rows) == band])
    return np.concatenate(out) if out else others


def _similar_members(m: int, least: float, rows_of: int):
    """Members of a cell with a similar member in another component, each once; rows (key, i, j, band, rep, comp, side, sig)."""

    def run(batches):
        out: list[tuple] = []
        for key, rows in _runs(batches, 4):
            comp = np.array([r[1] for r in rows])
            side = np.array([r[2] for r in rows])
            sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), m)
            hit = np.zeros(len(rows), bool)
            left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
            values, inverse, size = np.unique(comp[left], return_inverse=True, return_counts=True)
            # members of the largest component on the left are reached from the others when both sides are the same
            skip = values[size.argmax()] if key[1] == key[2] and len(values) else None
            for x in left[comp[left] != skip] if skip is not None else left:
                near = _near(sig, x, right[comp[right] != comp[x]], least, rows_of, key[3])
                if len(near):
                    hit[x] = True
                    hit[near] = True
            out += [(*key, rows[i][0], rows[i][1], rows[i][2]) for i in np.flatnonzero(hit)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["key", "i", "j", "band", "rep", "comp", "side"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["key", "i", "j", "band", "rep", "comp", "side"])
        give_back()

    return run


def _cell_links(k: int, percent: int, m: int, least: float, rows_of: int):
    """Links between components within a cell, on full sets; rows (key, i, j, band, rep, comp, side, sig, text)."""

    def run(batches):
        out: list[tuple] = []
        for key, rows in _runs(batches, 4, lambda texts: _sets(texts, k)):
            sets = [r[4] for r in rows]
            sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), m)
            up: dict[int, int] = {}

            def top(x):
                while up.get(x, x) != x:
                    x = up[x]
                return x

            right = np.array([i for i, r in enumerate(rows) if r[2] & 2], dtype=np.int64)
            for x, r in enumerate(rows):
                if not r[2] & 1:
                    continue
                others = right[right > x] if key[1] == key[2] else right
                for y in _near(sig, x, others, least, rows_of, key[3]).tolist():
                    a, b = top(r[1]), top(rows[y][1])
                    if a != b and _linked(sets[x], sets[y], percent):
                        up[max(a, b)] = min(a, b)
                        out.append((r[1], rows[y][1]))
        src, dst = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])
        give_back()

    return run


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Documents are linked if 100 * intersection >= percent * union of their sets.
    """
    return _judged(docs, k, percent, bands, rows, id_col, text_col).drop("mark")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, text): the mark tells rows of one id apart by their texts."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, text) of rows (rep, doc_id, mark); only rows that pass a bitmap of ids are moved."""
    found = maybe(texts, bitmap(wanted, "doc_id"), "doc_id").join(wanted, ["doc_id", "mark"]).select("rep", "text")
    return found.dropDuplicates(["rep"])


def _judged(docs: DataFrame, k: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    m, least = bands * rows, percent / 100 - MARGIN
    texts = _marked(docs, id_col, text_col)
    sketch = saved(texts.mapInArrow(_sketch(k, bands, rows), SKETCH))

    some = sketch.where("n > 0 and doc_id is not null")
    lowest = F.min(F.struct("doc_id", "mark"))
    folded = some.groupBy("n", "fp1", "fp2").agg(lowest.alias("low"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
    reps = saved(folded.select(F.monotonically_increasing_id().alias("rep"), "n", "fp1", "fp2", F.col("low.doc_id").alias("doc_id"), F.col("low.mark").alias("mark"), "keys", "sig"))

    spread = reps.select("rep", "n", F.posexplode("keys").alias("band", "key"))
    draw = F.struct(F.xxhash64("rep", "key").alias("h"), F.col("rep"))
    stats = spread.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("all"), F.min(draw)["rep"].alias("pivot")).where("size > 1")
    members = saved(spread.join(stats, "key").select("key", F.col("band").cast("long").alias("band"), "rep", "pivot", "size", "all"))

    signs = reps.select("rep", "sig")
    pairs = members.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = pairs.join(signs.toDF("a", "s"), "a").join(signs.toDF("b", "t"), "b").select("a", "b", "s", "t")
    pairs = pairs.mapInArrow(_alike(m, least), "a long, b long, est double")
    pairs = saved(pairs.groupBy("a").agg(F.max(F.struct("est", "b"))["b"].alias("b")))

    places = reps.select("rep", "doc_id", "mark")
    involved = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select("b")).distinct()
    found = _texts_of(texts, saved(places.join(involved, "rep")))
    both = pairs.join(found.toDF("a", "s"), "a").join(found.toDF("b", "t"), "b").select("a", "b", "s", "t")
    links = saved(both.mapInArrow(_confirm(k, percent), "src long, dst long"))
    discard(pairs)
    first = saved(connected_components(links)).toDF("rep", "c")

    located = members.select("key", "band", "rep", "size", "all").join(first, "rep", "left").select("key", "band", "rep", "size", "all", F.coalesce("c", "rep").alias("comp"))
    mixed = located.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    blocks_of = F.greatest(F.ceil(F.col("size") / BUCKET), F.least(F.ceil(F.col("all") / SHINGLES), "size")).cast("long")
    open_rows = located.join(mixed, "key").withColumn("nb", blocks_of)
    open_rows = saved(open_rows.withColumn("i", F.pmod(F.xxhash64("rep"), F.col("nb"))))
    discard(members)
    small = open_rows.where("nb = 1").select("key", "i", F.lit(0).cast("long").alias("j"), "band", "rep", "comp", F.lit(3).cast("long").alias("side"))
    # cell (i, j), i <= j: block i on the left, block j on the right
    large = open_rows.where("nb > 1").withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    side = F.when(F.col("i") == F.col("o"), 3).when(F.col("i") < F.col("o"), 1).otherwise(2).cast("long")
    large = large.select("key", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"), "band", "rep", "comp", side.alias("side"))
    cells = small.unionAll(large).join(signs, "rep").select("key", "i", "j", "band", "rep", "comp", "side", "sig")
    cells = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "comp", "rep")
    alike = saved(cells.mapInArrow(_similar_members(m, least, rows), "key long, i long, j long, band long, rep long, comp long, side long"))
    discard(open_rows)

    found = _texts_of(texts, saved(places.join(alike.select("rep").distinct(), "rep")))
    full = alike.join(signs, "rep").join(found, "rep").select("key", "i", "j", "band", "rep", "comp", "side", "sig", "text")
    full = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "comp", "rep")
    more = saved(full.mapInArrow(_cell_links(k, percent, m, least, rows), "src long, dst long"))
    second = connected_components(more).toDF("comp", "c2")

    label = reps.select("n", "fp1", "fp2", "rep", "doc_id").join(first, "rep", "left").select("n", "fp1", "fp2", "doc_id", F.coalesce("c", "rep").alias("comp"))
    label = saved(label.join(second, "comp", "left").select("n", "fp1", "fp2", "doc_id", F.coalesce("c2", "comp").alias("comp")))
    names = label.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    label = label.join(names, "comp").select("n", "fp1", "fp2", "component_id")
    linked = some.select("doc_id", "mark", "n", "fp1", "fp2").join(label, ["n", "fp1", "fp2"]).select("doc_id", "mark", "n", "component_id")
    alone = sketch.where("n = 0 or doc_id is null").select("doc_id", "mark", "n", F.col("doc_id").alias("component_id"))
    got = linked.unionAll(alone)
    return got.select("doc_id", "mark", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were; only possible copies are moved."""
    gone = saved(_judged(docs, k, percent, bands, rows, id_col, text_col).where("not kept").select("doc_id", "mark").distinct())
    bits = bitmap(gone, "doc_id")
    inside = maybe(docs, bits, id_col)
    left = inside.join(gone, (inside[id_col].cast("long") == gone["doc_id"]) & (F.xxhash64(inside[text_col].cast("string")) == gone["mark"]), "left_anti")
    return maybe(docs, bits, id_col, inside=False).unionByName(left)
