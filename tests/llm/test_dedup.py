"""Operators 1, 7 and 9 against brute force."""

import re

import numpy as np
import pytest

from kinfold.llm import idfilter, minhash, suffix, vectors
from kinfold.llm.minhash import drop_near_duplicates, near_duplicates
from kinfold.llm.superminhash import signatures
from kinfold.llm.suffix import remove_repeats, without_repeats
from kinfold.llm.vectors import near_vectors


def components(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def shingle_set(text, k):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("k, bucket", [(2, 2048), (5, 2)])
def test_near_duplicates(docs, no_docs, texts, k, bucket, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET", bucket)  # with 2, all buckets are spread over cells
    sets = [shingle_set(t, k) for t in texts]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components(len(sets), links)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, k=k).collect()}
    assert got == {i: (len(s), comp[i], comp[i] == i) for i, s in enumerate(sets)}
    if k == 5:
        kept = drop_near_duplicates(docs, k=5)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(sets)) if comp[i] == i]
        assert near_duplicates(no_docs).count() == 0


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text + " x")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.component_id or 0, r.kept) for r in near_duplicates(df, k=2).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_superminhash_estimates_jaccard():
    rnd = np.random.default_rng(0)
    errors = []
    for _ in range(30):
        both, one, two = (rnd.integers(0, 2**63, n).astype(np.uint64) for n in (rnd.integers(1, 200), rnd.integers(0, 60), rnd.integers(0, 60)))
        a, b = np.unique(np.concatenate([both, one])), np.unique(np.concatenate([both, two]))
        s = signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 160)
        errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.15


def repeated(texts, length):
    seen, again = set(), set()
    for t in texts:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            (again if s in seen else seen).add(s)
    out = []
    for t in texts:
        mark = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if t[p : p + length] in again:
                mark[p : p + length] = True
        runs = np.flatnonzero(np.diff(np.concatenate([[False], mark]).astype(int)))
        out.append(([tuple(x) for x in runs.reshape(-1, 2).tolist()], bytes(np.frombuffer(t, np.uint8)[~mark[:-1]])))
    return out


def test_repeats(docs, no_docs, texts, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 4096)  # the long texts are cut into segments
    monkeypatch.setattr(suffix, "BLOCK", 2048)
    raw = [(t or "").encode() for t in texts]
    want = repeated(raw, 200)
    rows = {r.id: r for r in remove_repeats(docs).collect()}
    for i, (spans, kept) in enumerate(want):
        assert [(s.start, s.end) for s in rows[i].spans] == spans and bytes(rows[i].kept) == kept
        assert rows[i].n_bytes == len(raw[i]) and rows[i].n_removed == len(raw[i]) - len(kept)
    clean = without_repeats(docs)
    assert clean.columns == docs.columns
    got = {r.doc_id: r for r in clean.collect()}
    assert all(got[i].text == kept.decode("utf-8", "ignore") and got[i].lang == "en" and got[i].kept == "x" for i, (_, kept) in enumerate(want))
    assert remove_repeats(no_docs).count() == 0


def test_repeats_beyond_the_bitmaps(spark, monkeypatch):
    """With more identifiers than bitmaps hold, as at 6 GB, little is moved and the results are the same."""
    rnd = np.random.default_rng(9)
    draw = lambda n: bytes(rnd.integers(97, 123, n, np.uint8)).decode()
    shared = [draw(1500) for _ in range(60)]
    texts = [draw(1200) + shared[i % 60][i % 7 * 40 :] + draw(1300) for i in range(180)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id").cache()
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    df.count()
    for name, bits in (("LEAST", 13), ("MOST", 13)):
        monkeypatch.setattr(idfilter, name, bits)
    before = written()
    rows = {r.id: r for r in remove_repeats(df).collect()}
    moved = written() - before
    for i, (spans, kept) in enumerate(repeated([t.encode() for t in texts], 200)):
        assert [(s.start, s.end) for s in rows[i].spans] == spans and bytes(rows[i].kept) == kept
    assert moved < 4 * sum(map(len, texts)), moved / sum(map(len, texts))


def test_vectors(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    base = rnd.standard_normal((60, 16))
    near = base[:20] + rnd.standard_normal((20, 16)) * 0.08
    dense = base[0] + rnd.standard_normal((30, 16)) * 0.12
    rows = [x.astype(np.float32).tolist() for x in np.concatenate([base, near, dense, base[:5], base[:5], base[5:8] * 7])]
    rows += [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0] * 8, [2.0] * 8]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").selectExpr("*", "1 as rep", "2 as key", "3 as label")
    good = [r is not None and len(r) > 0 and all(x is not None and np.isfinite(x) for x in r) and any(r) for r in rows]
    unit = [np.array(r, float) / np.linalg.norm(np.array(r, float)) if g else None for r, g in zip(rows, good)]
    links = [(a, b) for b in range(len(rows)) for a in range(b) if good[a] and good[b] and len(rows[a]) == len(rows[b]) and unit[a] @ unit[b] >= 0.95]
    comp = components(len(rows), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(rows))
    want = {i: (int(n[i]), comp[i], comp[i] == i) for i in range(len(rows))}
    for block in (vectors.BLOCK, 4):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, block=block).collect()}
        assert got == want
    assert near_vectors(df.limit(0)).count() == 0


def test_windows_reach_over_parts(spark):
    """One pass whose window holds all rows finds all links, whatever the number of partitions."""
    rnd = np.random.default_rng(8)
    base = rnd.standard_normal((150, 16))
    both = np.concatenate([base, base + 0.18 * rnd.standard_normal(base.shape)])
    unit = both / np.linalg.norm(both, axis=1, keepdims=True)
    want = {i: int(n) - 1 for i, n in enumerate((unit @ unit.T >= 0.95).sum(axis=1))}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        got = {r.vec_id: r.n_links for r in near_vectors(df, passes=1).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == want and sum(want.values()) > 200


def test_repeated_ids_on_other_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a), (1, b), (2, a + " x"), (3, b + " x"), (3, "quite another text of a few words")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k=2).collect())
    assert got == [(1, 29, 1, True), (1, 29, 1, True), (2, 30, 1, False), (3, 6, 1, False), (3, 30, 1, False)] or got == [(1, 29, 1, True), (1, 29, 1, True), (2, 30, 1, False), (3, 6, 3, True), (3, 30, 1, False)]
    assert sorted(r.text for r in drop_near_duplicates(df, k=2).collect()) == sorted([a, b, "quite another text of a few words"])


def test_colliding_words_do_not_link(spark):
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - x for x in bits]
    one, two = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    df = spark.createDataFrame([(1, one), (2, two), (3, f"{one} x"), (4, f"{two} x")], "doc_id long, text string")
    assert all(r.component_id == r.doc_id for r in near_duplicates(df, k=2).collect())
    assert all(r.n_removed == (1024 if r.id < 5 else 0) for r in remove_repeats(df.unionAll(df.selectExpr("doc_id + 10", "'unlike'"))).collect() if r.id in (1, 2, 11))


def test_vectors_with_repeated_and_null_ids(spark):
    """One id on two vectors: each row is linked by its own; a null id takes part but names nothing."""
    rnd = np.random.default_rng(5)
    x, y = rnd.standard_normal((2, 16))
    near = lambda v: (v + rnd.standard_normal(16) * 0.01).tolist()
    rows = [(1, x.tolist()), (1, y.tolist()), (2, near(x)), (3, near(x)), (3, near(y)), (None, near(y)), (None, rnd.standard_normal(16).tolist())]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (3, 2, 1, False), (0, 2, 1, False), (0, 0, 0, True)])
