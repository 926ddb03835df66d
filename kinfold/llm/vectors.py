"""Near-duplicate vectors by sorted projection passes (operator 7).

Exact copies are folded first.  In each pass the distinct vectors are ordered
lexicographically by a concatenation of random sign hashes, and every vector is
compared, in double precision, with its neighbours in a bounded window of that
order; verified pairs of all passes are united into components.  An order is cut
into parts that overlap by more than a window, by a sample.  A pass misses a pair
only if its order separates the two, independently of other passes, so the chance
to miss a pair falls exponentially in the passes.  Rounds of ``passes`` new orders
are made until one adds no link between components.  Links are counted
exactly afterwards: both ends of a link share a component, so each component is
compared with itself in blocks.  Nothing is capped: components beyond a block
are spread over the pairs of their blocks.

Vectors are told apart by a number of their own, not by vec_id.

Defined results: null, zero, or non-finite vectors and such with null components
link with nothing; vectors of different lengths never link; repeated vec_ids are
each a row of the result, linked by the vector of that row, and each counts as one
other vector; a null vec_id takes part, names no component unless all of it is
null, and is kept only then; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import saved
from kinfold.operators.components import connected_components

PASSES = 16
WINDOW = 1024
BITS = 30
BLOCK = 2048
SEED = 7


def _matrix(col: pa.Array) -> list[np.ndarray]:
    """Rows of a list column as double arrays."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    off = col.offsets.to_numpy() - col.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(off[:-1], off[1:])]


def _unit(rows: list[np.ndarray]) -> np.ndarray:
    x = np.stack(rows)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow, no underflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(passes: int, bits: int, seed: int, cuts: dict[int, list[tuple[np.ndarray, np.ndarray]]] | None = None):
    """The rows' keys; with ``cuts``, one row per pass and part that a vector is in."""
    planes: dict[int, np.ndarray] = {}

    def emit(batch, size, out):
        if cuts is None:
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, passes, dtype=np.int32)), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), keys], names=["dim", "keys"])
            return
        for turn in range(passes):
            rows, parts = [], []
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                begin, early = cuts.get(int(dim), [(np.zeros(0, np.int64),) * 2] * passes)[turn]
                own, last = np.searchsorted(begin, out[at, turn], "right"), np.searchsorted(early, out[at, turn], "right")
                for more in range(int((last - own).max()) + 1):  # the parts from its own to the last whose overlap it is in
                    inside = own + more <= last
                    rows.append(at[inside])
                    parts.append((own + more)[inside])
            take = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            n = len(take)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, turn), pa.int32()), pa.array(size[take], pa.int32()), pa.array(np.concatenate(parts) if rows else take, pa.int32()), pa.array(out[take, turn], pa.int64()), batch.column(0).take(pa.array(take)), batch.column(1).take(pa.array(take))],
                names=["pass", "dim", "part", "key", "rep", "vec"],
            )

    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column(1))
            out = np.zeros((len(rows), passes), dtype=np.int64)
            size = np.array([len(r) for r in rows])
            for dim in np.unique(size):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), passes * bits))
                at = np.flatnonzero(size == dim)
                for lo in range(0, len(at), 4096):
                    part = at[lo : lo + 4096]
                    signs = (_unit([rows[i] for i in part]) @ planes[dim] >= 0).reshape(len(part), passes, bits)
                    out[part] = signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
            yield from emit(batch, size, out)

    return run


class _Forest:
    """Union-find over the ids that have links in one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _cuts(reps: DataFrame, total: int, parts: int, passes: int, bits: int, seed: int, window: int) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """By length and pass: the keys at which parts begin, and the earlier ones at which their overlaps do.

    The overlap is as long as two windows and five draws of the sample, so that it
    holds a window in spite of the sample's chance.
    """
    wanted = 100 * max(1, -(-parts // passes))
    few = reps if total <= wanted else reps.sample(min(1.0, wanted / total), seed=seed)
    by: dict[int, list] = {}
    for r in few.select("rep", "vec").mapInArrow(_keys(passes, bits, seed), "dim int, keys array<long>").collect():
        by.setdefault(r["dim"], []).append(r["keys"])
    drawn = sum(map(len, by.values()))
    out = {}
    for dim, rows in by.items():
        keys = np.sort(np.array(rows, np.int64), axis=0)
        back = int(2 * window * drawn / max(1, total)) + 5
        n = min(max(1, round(parts / passes * len(keys) / drawn)), max(1, len(keys) // (3 * back)))
        at = np.array([len(keys) * k // n for k in range(1, n)], np.int64)
        out[dim] = [(keys[at, i], keys[np.maximum(at - back, 0), i]) for i in range(passes)]
    return out


def _window_links(window: int, least: float):
    """Spanning links of each pass's order, for rows sorted by (pass, length, part, key)."""

    def run(batches):
        forest = _Forest()
        last, ids, mat = None, np.zeros(0, np.int64), None
        a: list[int] = []
        b: list[int] = []

        def links(x_ids, x, y_ids, y, own):
            near = x @ y.T >= least
            if own:
                near = np.triu(near, 1)
            for i, j in zip(*np.nonzero(near)):
                u, v = int(x_ids[i]), int(y_ids[j])
                if forest.join(u, v):
                    a.append(u)
                    b.append(v)

        for batch in batches:
            where = batch.column(0).to_numpy(zero_copy_only=False)
            part = batch.column(1).to_numpy(zero_copy_only=False)
            all_ids = batch.column(2).to_numpy(zero_copy_only=False)
            rows = _matrix(batch.column(3))
            group = np.array([(p, len(r), k) for p, r, k in zip(where, rows, part)], dtype=np.int64).reshape(-1, 3)
            cut = np.flatnonzero(np.any(group[1:] != group[:-1], axis=1)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(rows)]):
                if lo == hi:
                    continue
                if last is None or tuple(group[lo]) != last:
                    last, ids, mat = tuple(group[lo]), np.zeros(0, np.int64), None
                    forest = _Forest()
                for at in range(lo, hi, window):
                    new_ids, new = all_ids[at : min(at + window, hi)], _unit(rows[at : min(at + window, hi)])
                    links(new_ids, new, new_ids, new, True)
                    if mat is not None:
                        links(new_ids, new, ids, mat, False)
                        new_ids, new = np.concatenate([ids, new_ids]), np.concatenate([mat, new])
                    ids, mat = new_ids[-window:], new[-window:]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])
                a, b = [], []

    return run


def _block_counts(least: float):
    """Links of the left rows with the right rows of each (component, i, j); rows sorted by these."""

    def count(rows):
        left = [r for r in rows if r[0] & 1]
        right = [r for r in rows if r[0] & 2]
        by: dict[int, tuple[list, list]] = {}
        for which, side in ((0, left), (1, right)):
            for r in side:
                by.setdefault(len(r[3]), ([], []))[which].append(r)
        ids, n = [], []
        for one, two in by.values():
            if not one or not two:
                continue
            y, weight, y_ids = _unit([r[3] for r in two]), np.array([r[2] for r in two]), np.array([r[1] for r in two])
            for lo in range(0, len(one), 1024):
                part = one[lo : lo + 1024]
                x_ids = np.array([r[1] for r in part])
                near = (_unit([r[3] for r in part]) @ y.T >= least) & (x_ids[:, None] != y_ids[None, :])
                ids.append(x_ids)
                n.append(near @ weight)
        return ids, n

    def run(batches):
        held, key = [], None
        ids: list = []
        n: list = []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2))))
            rows = list(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), _matrix(batch.column(6))))
            for k, r in zip(keys, rows):
                if k != key and held:
                    got = count(held)
                    ids += got[0]
                    n += got[1]
                    held = []
                key = k
                held.append(r)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(n), pa.int64())], names=["rep", "n"])
                ids, n = [], []
        if held:
            ids, n = count(held)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(n), pa.int64())], names=["rep", "n"])

    return run


def near_vectors(vectors: DataFrame, least: float = 0.95, passes: int = PASSES, window: int = WINDOW, bits: int = BITS, block: int = BLOCK, seed: int = SEED, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    ``passes`` are made in a round: at cosine 0.95 a sign agrees with probability
    0.90, and a pass finds a pair whose keys agree in the first log2(rows / window)
    signs at least; the rounds grow with what the orders still separate.
    """
    kind = "array<float>" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(kind).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    fine = F.coalesce(F.col("vec").isNotNull() & ~bad & some, F.lit(False))
    rows = rows.withColumn("k", F.when(fine, F.struct(F.xxhash64("vec").alias("k1"), F.hash("vec", F.size("vec")).alias("k2"))))
    rows = rows.withColumns({"k1": F.col("k.k1"), "k2": F.col("k.k2")}).drop("k")
    reps = rows.where("k1 is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    reps = saved(reps.select(F.monotonically_increasing_id().alias("rep"), "k1", "k2", "low", "copies", "vec"))

    total = reps.count()
    n = max(passes, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    comp, joined, turn = None, 0, 0
    while True:
        own = seed + turn  # the first round has the given seed
        cuts = _cuts(reps, total, n, passes, bits, own, window)
        spread = reps.select("rep", "vec").mapInArrow(_keys(passes, bits, own, cuts), f"pass int, dim int, part int, key long, rep long, vec {kind}")
        sorted_rows = spread.repartition(n, "pass", "dim", "part").sortWithinPartitions("pass", "dim", "part", "key", "rep")
        links = sorted_rows.select("pass", "part", "rep", "vec").mapInArrow(_window_links(window, least), "src long, dst long")
        if comp is not None:
            links = links.unionAll(comp.select(F.col("rep").alias("src"), F.col("component").alias("dst")))
        comp = saved(connected_components(links).select(F.col("id").alias("rep"), "component"))
        sizes = comp.agg(F.count("*").alias("n"), F.count_distinct("component").alias("c")).first()
        before, joined, turn = joined, sizes["n"] - sizes["c"], turn + 1
        if joined == before:
            break

    size = comp.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nb"))
    member = comp.join(size, "component").join(reps.select("rep", "copies", "vec"), "rep")
    i = F.pmod(F.xxhash64("rep", F.lit(seed)), F.col("nb")).cast("int")
    member = member.withColumn("i", i)
    own = member.where("nb = 1").select("component", "i", F.lit(0).alias("j"), F.lit(3).alias("side"), "rep", "copies", "vec")
    many = member.where("nb > 1").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    left = many.select("component", "i", F.col("o").alias("j"), F.lit(1).alias("side"), "rep", "copies", "vec")
    right = many.select("component", F.col("o").alias("i"), F.col("i").alias("j"), F.lit(2).alias("side"), "rep", "copies", "vec")
    cells = own.unionAll(left).unionAll(right).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "rep", "side")
    counts = cells.mapInArrow(_block_counts(least), "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n"))

    done = reps.select("k1", "k2", "rep", "low", "copies").join(comp, "rep", "left").join(counts, "rep", "left")
    done = saved(done.select("k1", "k2", "low", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    names = done.groupBy("component").agg(F.min("low").alias("component_id"))
    done = done.join(names, "component").select("k1", "k2", "n_links", "component_id")
    linked = rows.where("k1 is not null").select("vec_id", "k1", "k2").join(done, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("k1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
