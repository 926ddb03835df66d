"""Copies of images by local descriptors (operator 4).

Each image gives corners over several scales (Harris response in a pyramid,
strongest first): ``KEYPOINTS`` of them, or ``DENSITY`` for each pixel if that is
more.  A corner's orientation is that of its patch's centroid; its descriptor are
``TESTS`` binary comparisons of smoothed pixels at places turned by the orientation.
Descriptors go into ``TABLES`` Hamming tables, each of a random choice of their bits;
the choice is so long that a cell holds few images by chance, whatever their number.
A shared cell counts by its rarity, log2 of all images over those of the cell, as
plain corners stand in most images.  First all pairs within cells of up to ``CROWD``
images are counted, and those with ``NEAR_EVIDENCE`` bits verified.  Then, over all
cells, one image of each, drawn by hash, is the pivot, so a cell of any size gives one
pair per image; those with ``EVIDENCE`` bits are verified, and rounds with newly drawn
pivots are made until one joins nothing.  A pair is verified on all its descriptors: it
is linked if ``INLIERS`` matches agree on one similarity transform.
Images themselves never move.

A table of w bits holds two descriptors that differ in d of 128 bits in one cell with
probability (1 - d/128)^w: 0.10 at d = 10 and w = 28.

Images are binary PGM or PPM (P5, P6); another decoder can be given.

Defined results: a null, empty or unreadable image has no corners and links with
nothing, nor has one without texture; a null id is its own component; rows of one id
are one image; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.shared import discard, saved
from kinfold.llm.textbuf import give_back, mix64
from kinfold.operators.components import connected_components

KEYPOINTS, DENSITY = 96, 96 / 128**2
SCALES = (1.0, 0.7, 0.5, 0.35, 0.25)
TESTS = 128
TABLES = 4
#: Bits of a table's key beyond those that give each descriptor a cell of its own; and the least.
SPARE, LEAST_BITS = 4, 30
PATCH = 10
#: Bits that the cells of a candidate pair tell together: log2 of all images (and RARE more) over those of a cell.
EVIDENCE, RARE = 32.0, 1024
#: Cells of so many images give all their pairs; the bits that these cells alone must tell of one.
CROWD, NEAR_EVIDENCE = 32, 20.0
HAMMING = 24
INLIERS = 12
TOLERANCE = 4.0

_rng = np.random.default_rng(5)
#: Places of the tests, as offsets within the patch.
PLACES = np.clip(_rng.normal(0, PATCH / 2.2, (TESTS, 2, 2)), -PATCH + 2, PATCH - 2)
_HEAD = re.compile(rb"(P[56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s")


def decode_pnm(data: bytes | None) -> np.ndarray | None:
    """Grey values of a binary PGM or PPM, or None."""
    m = _HEAD.match(data or b"")
    if not m:
        return None
    w, h, channels = int(m[2]), int(m[3]), 3 if m[1] == b"P6" else 1
    raw = np.frombuffer(data, np.uint8, offset=m.end())
    if raw.size < w * h * channels or not w * h:
        return None
    grey = raw[: w * h * channels].reshape(h, w, channels).astype(np.float32)
    return grey.mean(axis=2)


def encode_pgm(grey: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % grey.shape[::-1] + np.clip(grey, 0, 255).astype(np.uint8).tobytes()


def _smooth(x: np.ndarray, r: int) -> np.ndarray:
    """Means over squares of side 2r+1, edges repeated."""
    p = np.pad(x, ((r + 1, r), (r + 1, r)), mode="edge").cumsum(0).cumsum(1)
    k = 2 * r + 1
    return (p[k:, k:] - p[:-k, k:] - p[k:, :-k] + p[:-k, :-k]) / (k * k)


def _resize(x: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return x
    h, w = max(1, int(x.shape[0] * scale)), max(1, int(x.shape[1] * scale))
    y, z = (np.arange(h) + 0.5) / scale - 0.5, (np.arange(w) + 0.5) / scale - 0.5
    return _sample(_smooth(x, 1), y[:, None] + 0 * z[None, :], z[None, :] + 0 * y[:, None])


def _sample(x: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Bilinear values at real places."""
    r, c = np.clip(row, 0, x.shape[0] - 1.001), np.clip(col, 0, x.shape[1] - 1.001)
    i, j = r.astype(int), c.astype(int)
    i2, j2 = np.minimum(i + 1, x.shape[0] - 1), np.minimum(j + 1, x.shape[1] - 1)
    a, b = r - i, c - j
    return (x[i, j] * (1 - a) + x[i2, j] * a) * (1 - b) + (x[i, j2] * (1 - a) + x[i2, j2] * a) * b


def _highest(x: np.ndarray) -> np.ndarray:
    """Maxima over squares of side 5, without the two outermost rows and columns."""
    h, w = x.shape[0] - 4, x.shape[1] - 4
    rows = x[:h]
    for k in range(1, 5):
        rows = np.maximum(rows, x[k : k + h])
    out = rows[:, :w]
    for k in range(1, 5):
        out = np.maximum(out, rows[:, k : k + w])
    return out


def describe(grey: np.ndarray | None, keypoints: int = KEYPOINTS, density: float = DENSITY) -> tuple[np.ndarray, np.ndarray]:
    """(corners as rows x, y, size, angle; packed descriptors) of an image, strongest first."""
    none = np.zeros((0, 4), np.float32), np.zeros((0, TESTS // 8), np.uint8)
    if grey is None or min(grey.shape) < 2 * PATCH + 5:
        return none
    keypoints = max(keypoints, int(density * grey.size))
    found = []
    for scale in SCALES:
        x = _resize(grey, scale)
        if min(x.shape) < 2 * PATCH + 5:
            continue
        s = _smooth(x, 1)
        gy, gx = np.gradient(s)
        a, b, c = _smooth(gx * gx, 2), _smooth(gy * gy, 2), _smooth(gx * gy, 2)
        corner = a * b - c * c - 0.05 * (a + b) ** 2
        edge = PATCH + 1
        inner = corner[edge:-edge, edge:-edge]
        row, col = np.nonzero((inner >= _highest(corner[edge - 2 : 2 - edge, edge - 2 : 2 - edge])) & (inner > 50.0))
        if len(row):
            found.append((inner[row, col], row + edge, col + edge, scale, s))
    if not found:
        return none
    strength = np.concatenate([f[0] for f in found])
    cut = np.sort(strength)[::-1][min(keypoints, len(strength)) - 1]
    span = np.arange(-PATCH, PATCH + 1)
    disc = (span[:, None] ** 2 + span[None, :] ** 2) <= PATCH**2
    points, bits, order = [], [], []
    for power, row, col, scale, s in found:
        keep = power >= cut
        power, row, col = power[keep], row[keep], col[keep]
        if not len(row):
            continue
        patch = s[row[:, None, None] + span[None, :, None], col[:, None, None] + span[None, None, :]] * disc
        angle = np.arctan2((patch * span[None, :, None]).sum((1, 2)), (patch * span[None, None, :]).sum((1, 2)))
        cos, sin = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        dx, dy = PLACES[None, :, :, 0], PLACES[None, :, :, 1]
        at_row, at_col = row[:, None, None] + sin * dx + cos * dy, col[:, None, None] + cos * dx - sin * dy
        value = _sample(s, at_row, at_col)
        bits.append(np.packbits(value[:, :, 0] < value[:, :, 1], axis=1))
        points.append(np.stack([(col + 0.5) / scale, (row + 0.5) / scale, np.full(len(row), 1 / scale), angle], axis=1))
        order.append(power)
    at = np.argsort(-np.concatenate(order), kind="stable")[:keypoints]
    return np.concatenate(points)[at].astype(np.float32), np.concatenate(bits)[at]


def distances(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hamming distances of packed descriptors."""
    one, two = d.view(np.uint64), e.view(np.uint64)
    out = np.bitwise_count(one[:, None, 0] ^ two[None, :, 0])
    for k in range(1, one.shape[1]):  # a sum over so short an axis costs more than the counts
        out += np.bitwise_count(one[:, None, k] ^ two[None, :, k])
    return out


def consensus(p: np.ndarray, d: np.ndarray, q: np.ndarray, e: np.ndarray, far: np.ndarray | None = None) -> int:
    """Most matches between two images that agree on one similarity transform; ``far`` are the distances if known."""
    if not len(p) or not len(q):
        return 0
    far = distances(d, e) if far is None else far
    near = far.argmin(axis=1)
    good = far[np.arange(len(p)), near] <= HAMMING
    near = near[good]
    if len(near) < INLIERS or np.count_nonzero(np.bincount(near)) < INLIERS:  # too few places, whatever agrees
        return 0
    a, b = p[good], q[near]
    # each match alone proposes a transform: its scale and turn from the corners' sizes and angles
    scale, turn = b[:, 2] / a[:, 2], b[:, 3] - a[:, 3]
    z, w = a[:, 0] + 1j * a[:, 1], b[:, 0] + 1j * b[:, 1]
    m = scale * np.exp(1j * turn)
    error = m[:, None] * (z[None, :] - z[:, None]) + w[:, None] - w[None, :]
    fits = error.real**2 + error.imag**2 <= (TOLERANCE * np.maximum(1.0, scale)[:, None]) ** 2
    first = np.argmax(fits.sum(axis=1))
    # one refinement by least squares on the best proposal's matches
    zi, wi = z[fits[first]], w[fits[first]]
    zm, wm = (zi.mean(), wi.mean()) if len(zi) else (0, 0)
    zc, wc = zi - zm, wi - wm
    if len(zi) >= 2 and np.abs(zc).max() > 1:
        k = (wc * zc.conj()).sum() / (np.abs(zc) ** 2).sum()
        refined = np.abs(k * (z - zm) + wm - w) <= TOLERANCE * max(1.0, abs(k))
    else:
        refined = fits[first]
    if np.count_nonzero(refined) < INLIERS:
        return 0
    # matches of one place count once
    return min(len(np.unique(np.round(z[refined]))), len(np.unique(np.round(w[refined]))))


FEATURES = "id long, n int, points binary, bits binary"


def _features(decoder: Callable, keypoints: int, density: float):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for i, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    points, bits = describe(decoder(raw), keypoints, density)
                    rows.append((i, len(points), points.tobytes(), bits.tobytes()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["id", "n", "points", "bits"])
        give_back()

    return run


def choices(tables: int, width: int) -> np.ndarray:
    """(tables, width): the bits that each table's keys are made of."""
    rng = np.random.default_rng(11)
    return np.stack([np.sort(rng.choice(TESTS, width, replace=False)) for _ in range(tables)])


def cell_keys(bits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The distinct cells of packed descriptors, over all tables."""
    each = np.unpackbits(bits, axis=1)
    place = np.uint64(1) << np.arange(chosen.shape[1], dtype=np.uint64)
    found = [mix64((each[:, c].astype(np.uint64) * place).sum(axis=1, dtype=np.uint64) * np.uint64(64) + np.uint64(t)) for t, c in enumerate(chosen)]
    return np.unique(np.concatenate(found))


def _cells(chosen: np.ndarray):
    """(id, key): the cells of images, each once."""

    def run(batches):
        for batch in batches:
            ids, keys = [], []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = cell_keys(np.frombuffer(raw, np.uint8).reshape(-1, TESTS // 8), chosen)
                ids.append(np.full(len(found), i, np.int64))
                keys.append(found.view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))], names=["id", "key"])
        give_back()

    return run


def _verified(least: int):
    def run(batches):
        for batch in batches:
            out = []
            for a, b, p, d, q, e in (row for lo in range(0, batch.num_rows, 256) for row in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns))):
                x, y = (np.frombuffer(v, np.float32).reshape(-1, 4) for v in (p, q))
                one, two = (np.frombuffer(v, np.uint8).reshape(-1, TESTS // 8) for v in (d, e))
                far = distances(one, two)
                if consensus(x, one, y, two, far) >= least or consensus(y, two, x, one, far.T) >= least:
                    out.append((a, b))
            src, dst = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])
        give_back()

    return run


@contextmanager
def _batches_of(spark: SparkSession, rows: int):
    """Rows of a pair hold 6 KB and more, so Spark's 10,000 of them are too much for a worker and its JVM."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links, found from these alone."""
    one, two = comp.toDF("src", "x"), comp.toDF("dst", "y")
    ends = links.join(one, "src", "left").join(two, "dst", "left").select(F.coalesce("x", "src").alias("src"), F.coalesce("y", "dst").alias("dst"))
    roots = saved(connected_components(ends))
    moved = comp.join(roots.toDF("component", "to"), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return moved.unionAll(roots.join(comp.select("id"), "id", "left_anti"))


def image_copies(images: DataFrame, id_col: str = "id", image_col: str = "image", decoder: Callable = decode_pnm, keypoints: int = KEYPOINTS, density: float = DENSITY, tables: int = TABLES, least: int = INLIERS) -> DataFrame:
    """(id, n_keypoints, component_id, kept) for every row."""
    rows = images.select(F.col(id_col).cast("long").alias("id"), F.col(image_col).alias("image"))
    feats = saved(rows.mapInArrow(_features(decoder, keypoints, density), FEATURES))
    side = feats.where("id is not null and n > 0").select("id", "points", "bits")
    many = feats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    chosen = choices(tables, min(max(LEAST_BITS, int(many).bit_length() + SPARE), 56))

    cells = side.select("id", "bits").mapInArrow(_cells(chosen), "id long, key long")
    total = side.count() + RARE
    shared = cells.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y")
    cells = saved(cells.join(shared.select("key", "size", F.log2(F.lit(float(total)) / F.col("size")).alias("bits")), "key"))

    def linked(pairs: DataFrame) -> DataFrame:
        both = pairs.join(side.toDF("a", "p", "d"), "a").join(side.toDF("b", "q", "e"), "b").select("a", "b", "p", "d", "q", "e")
        with _batches_of(images.sparkSession, 1024):
            return saved(both.mapInArrow(_verified(least), "src long, dst long"))

    few = cells.where(F.col("size") <= CROWD)
    pairs = few.select("key", F.col("id").alias("a"), "bits").join(few.select("key", F.col("id").alias("b")), "key").where("a < b")
    pairs = saved(pairs.groupBy("a", "b").agg(F.sum("bits").alias("bits")).where(F.col("bits") >= NEAR_EVIDENCE).select("a", "b"))
    links = linked(pairs)
    comp = saved(connected_components(links))
    discard(pairs, links)
    turn = 0
    while True:
        draw = F.struct(F.xxhash64("id", F.lit(turn)).alias("x"), F.col("id"))  # the same in all cells of a group
        pivots = cells.groupBy("key").agg(F.min(draw)["id"].alias("pivot"))
        pairs = cells.join(pivots, "key").where("id <> pivot").groupBy(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).agg(F.sum("bits").alias("bits"))
        pairs = pairs.where(F.col("bits") >= EVIDENCE).select("a", "b")
        one, two = comp.toDF("a", "x"), comp.toDF("b", "y")  # those that are united need no look
        pairs = saved(pairs.join(one, "a", "left").join(two, "b", "left").where("not coalesce(x = y, false)").select("a", "b"))
        links = linked(pairs)
        more = not links.isEmpty()  # each joins images that were not united
        if more:
            comp = saved(_joined(comp, links))
        discard(pairs, links)
        turn += 1
        if not more:
            break
    discard(cells)

    got = feats.select("id", F.col("n").alias("n_keypoints")).join(comp, "id", "left").select("id", "n_keypoints", F.coalesce("component", "id").alias("component_id"))
    return got.select(F.col("id").alias(id_col), "n_keypoints", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def draw(seed: int, size: int = 128) -> np.ndarray:
    """A picture of overlapping shapes, as test material."""
    rng = np.random.default_rng(seed)
    span = np.arange(size)
    out = np.full((size, size), rng.uniform(60, 200))
    for _ in range(26):
        a, b = rng.uniform(0, size, 2)
        w, h, t, v = rng.uniform(5, 24), rng.uniform(5, 24), rng.uniform(0, np.pi), rng.uniform(0, 255)
        cos, sin = np.cos(t), np.sin(t)
        wide, high = w * abs(cos) + h * sin + 1, w * sin + h * abs(cos) + 1  # nothing of the shape lies beyond
        row, col = (slice(max(0, int(at - far)), int(at + far) + 2) for at, far in ((b, high), (a, wide)))
        x, y = span[None, col] - a, span[row, None] - b
        u, s = x * cos + y * sin, y * cos - x * sin
        out[row, col][(np.abs(u) < w) & (np.abs(s) < h)] = v
    return out


def edited(picture: np.ndarray, how: int, seed: int) -> np.ndarray:
    """The picture itself (0), cropped (1), with other brightness, contrast and noise (2), or turned and cropped (3)."""
    rng = np.random.default_rng(seed)
    if how == 1:
        a, b = rng.integers(4, 20, 2)
        return picture[a : a + 100, b : b + 104]
    if how == 2:
        return picture * 0.8 + 25 + rng.normal(0, 2, picture.shape)
    return np.rot90(picture)[6:120, 3:118] if how == 3 else picture
