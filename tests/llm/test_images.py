"""Operator 4 on drawn pictures with known copies."""

import numpy as np

from kinfold.llm import images as module
from kinfold.llm.images import INLIERS, _resize, consensus, decode_pnm, describe, distances, draw, edited, encode_pgm, image_copies


def test_decoding():
    grey = np.arange(12, dtype=float).reshape(3, 4)
    assert (decode_pnm(encode_pgm(grey)) == grey).all()
    colour = b"P6 # made by hand\n2 1 255\n" + bytes([1, 2, 3, 10, 20, 30])
    assert decode_pnm(colour).tolist() == [[2.0, 20.0]]
    for bad in (None, b"", b"P5 4 4 255\nshort", b"GIF89a", b"P5 0 4 255\n"):
        assert decode_pnm(bad) is None


def test_consensus_tells_copies():
    for i in range(6):
        plain = describe(draw(i))
        for how in (1, 2, 3):
            assert consensus(*plain, *describe(edited(draw(i), how, i))) >= INLIERS
        assert consensus(*plain, *describe(draw(i + 100))) < INLIERS
    assert len(describe(np.full((64, 64), 9.0))[0]) == 0 and len(describe(None)[0]) == 0


def test_distances():
    """Of all descriptors of two images, a byte each: a pair's verification is most of the work."""
    rng = np.random.default_rng(3)
    d, e = (rng.integers(0, 256, (n, 16), np.uint8) for n in (40, 30))
    far = distances(d, e)
    assert far.dtype == np.uint8 and distances(d, ~d).max() == 128
    assert (far == (np.unpackbits(d, axis=1)[:, None] != np.unpackbits(e, axis=1)[None]).sum(axis=2)).all()


def test_image_copies(spark):
    rows = [(i, bytearray(encode_pgm(edited(draw(i // 4), i % 4, i)))) for i in range(24)]
    flat = bytearray(encode_pgm(np.full((64, 64), 9.0)))
    rows += [(30, rows[5][1]), (31, rows[5][1]), (40, None), (41, bytearray()), (42, flat), (43, flat), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, image binary").selectExpr("*", "1 as id", "2 as h", "3 as key", "4 as n")
    got = {r.vec_id: (r.component_id, r.kept, r.n_keypoints > 0) for r in image_copies(df, id_col="vec_id").collect()}
    want = {i: (i // 4 * 4, i % 4 == 0, True) for i in range(24)} | {30: (4, False, True), 31: (4, False, True)}
    want |= {i: (i, True, False) for i in (40, 41, 42, 43)}
    assert got.pop(None)[:2] == (None, True)
    assert got == want
    assert image_copies(df.limit(0), id_col="vec_id").count() == 0


def test_recall_by_edit(spark):
    """All links that comparing every pair finds are found, for each kind of edit."""
    kinds = {"crop": lambda p, i: edited(p, 1, i), "light": lambda p, i: edited(p, 2, i), "turn": lambda p, i: edited(p, 3, i)}
    kinds |= {f"scale {x}": (lambda p, i, x=x: _resize(p, x)) for x in (0.9, 0.75, 0.6, 0.5)}
    pictures = 8
    images = [draw(i) for i in range(pictures)] + [f(draw(i), i) for f in kinds.values() for i in range(pictures)]
    found = [describe(x) for x in images]
    rows = [(i, bytearray(encode_pgm(x))) for i, x in enumerate(images)]
    comp = {r.id: r.component_id for r in image_copies(spark.createDataFrame(rows, "id long, image binary")).collect()}
    for k, kind in enumerate(kinds, 1):
        true = [i for i in range(pictures) if max(consensus(*found[i], *found[k * pictures + i]), consensus(*found[k * pictures + i], *found[i])) >= INLIERS]
        caught = [i for i in true if comp[k * pictures + i] == comp[i]]
        assert len(true) >= 0.8 * pictures and len(caught) >= 0.9 * len(true), kind
    far = [(a, b) for a in range(len(images)) for b in range(a) if a % pictures != b % pictures]
    assert not any(comp[a] == comp[b] for a, b in far)


def test_pairs_of_small_cells_need_no_pivot(spark, monkeypatch):
    """Copies are united within cells of few images; rounds of pivots, which each cost a pass over all cells, have nothing to join."""
    rows = [(i, bytearray(encode_pgm(edited(draw(i // 4), i % 4, i)))) for i in range(160)]
    joins = []
    monkeypatch.setattr(module, "_joined", lambda comp, links, real=module._joined: joins.append(1) or real(comp, links))
    got = {r.id: r.component_id for r in image_copies(spark.createDataFrame(rows, "id long, image binary")).collect()}
    assert got == {i: i // 4 * 4 for i in range(160)} and not joins
    monkeypatch.setattr(module, "EVIDENCE", float("inf"))  # no pair of a pivot has so much
    alone = {r.id: r.component_id for r in image_copies(spark.createDataFrame(rows[:80], "id long, image binary")).collect()}
    assert alone == {i: i // 4 * 4 for i in range(80)}


def test_more_copies_than_a_small_cell(spark):
    """Cells of more images than ``CROWD`` are searched by pivots."""
    many = module.CROWD + 16
    rows = [(i, bytearray(encode_pgm(edited(draw(0), i % 3, i)))) for i in range(many)]
    rows += [(many + i, bytearray(encode_pgm(draw(1 + i)))) for i in range(8)]
    got = {r.id: r.component_id for r in image_copies(spark.createDataFrame(rows, "id long, image binary")).collect()}
    assert got == {i: 0 if i < many else i for i in range(many + 8)}


def test_drawing_and_corners_by_plain_forms():
    for seed, size in ((0, 128), (1, 40), (2, 300)):
        rng, (y, x) = np.random.default_rng(seed), np.mgrid[:size, :size]
        out = np.full((size, size), rng.uniform(60, 200))
        for _ in range(26):
            a, b = rng.uniform(0, size, 2)
            w, h, t, v = rng.uniform(5, 24), rng.uniform(5, 24), rng.uniform(0, np.pi), rng.uniform(0, 255)
            u, s = (x - a) * np.cos(t) + (y - b) * np.sin(t), (y - b) * np.cos(t) - (x - a) * np.sin(t)
            out[(np.abs(u) < w) & (np.abs(s) < h)] = v
        assert (draw(seed, size) == out).all()
    grid = np.random.default_rng(4).random((9, 12))
    assert (module._highest(grid) == np.lib.stride_tricks.sliding_window_view(grid, (5, 5)).max(axis=(2, 3))).all()
