"""Operators 5, 8 and 10, the pipeline, and the registry."""

import itertools
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import html as H
from kinfold.llm import urls as U
from kinfold.llm.toxicity import Crf, drop_toxic, score_documents, train, training_rows


def test_marginals_against_all_paths():
    rnd = np.random.default_rng(4)
    net = Crf(np.zeros(0, np.uint64), np.zeros(0), -1.3, rnd.standard_normal((2, 2)))
    n, at, w = 9, np.array([1, 2, 6]), np.array([2.5, -0.5, 1.7])
    score = np.full(n, net.bias)
    score[at] += w
    total, mass = 0.0, np.zeros(n)
    for path in itertools.product((0, 1), repeat=n):
        e = np.exp(sum(score[t] for t in range(n) if path[t]) + sum(net.moves[a, b] for a, b in zip(path, path[1:])))
        total += e
        mass += e * np.array(path)
    assert np.allclose(net.marginals(n, at, w), mass[at] / total)


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(9)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 6))) for _ in range(300)]
    bad = ["idiota", "scumbag", "wretchen", "wretchos"]
    rows = []
    for i in range(600):
        w = [rnd.choice(plain) for _ in range(rnd.randrange(3, 60))]
        if i % 4 == 0:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    rows += [(1000, None, None), (1001, "", 0), (1002, "Wretchen!", None)]
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return docs, labels, rows


def plain_score(net, text):
    """The score by forward and backward sums over every token."""
    from kinfold.llm.textbuf import Words, mix64

    weight = dict(zip(net.keys.tolist(), net.weights.tolist()))

    def key(part, salt):
        return int(mix64(Words(np.frombuffer(part, np.uint8)).keys(np.array([0]), np.array([len(part)])) + np.uint64(salt))[0])

    words = re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower())
    found = [[weight[k] for k in [key(w, 1), *(key(w[:n], 2 * n + 2) for n in (3, 4, 5, 6, 7, 8) if len(w) > n)] if k in weight] for w in words]
    scores = np.array([[0.0, net.bias + sum(x)] for x in found]).reshape(-1, 2)
    n, ahead, back = len(words), [], [np.zeros(2)]
    for t in range(n):
        ahead.append(scores[t] + (np.logaddexp.reduce(ahead[-1][:, None] + net.moves, axis=0) if t else 0.0))
    for t in range(n - 1, 0, -1):
        back.append(np.logaddexp.reduce(net.moves + scores[t] + back[-1], axis=1))
    p = [float(np.exp(a[1] + b[1] - np.logaddexp.reduce(a + b))) for a, b in zip(ahead, back[::-1])]
    evidence = 1 - np.prod([1 - x for x, f in zip(p, found) if f])
    return 1 / (1 + np.exp(-(net.scale[0] + net.scale[1] * evidence)))


def test_toxicity(labelled):
    docs, labels, rows = labelled
    net = train(training_rows(docs, labels, usable=F.col("id") % 3 != 1, per_class=(300, 120)))
    got = {r.doc_id: r for r in score_documents(docs, net).collect()}
    held = [(y, got[i].score >= 0.7) for i, _, y in rows if y is not None and i % 3 == 1]
    assert sum(y == p for y, p in held) / len(held) > 0.98
    assert got[1000].score == got[1001].score < 0.1 and got[1002].score >= 0.7
    assert [(s.start, s.end) for s in got[1002].spans] == [(0, 8)]
    for i, text, _ in rows[::40] + rows[-3:]:
        assert np.isclose(got[i].score, plain_score(net, text), atol=1e-6)
    kept = drop_toxic(docs, net)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].score < 0.7}
    assert score_documents(docs.limit(0), net).count() == 0
    none = train(training_rows(docs, labels.where("toxic = 0")))
    assert {r.score for r in score_documents(docs.limit(5), none).collect()} == {none.score(0.0)} and none.score(0.0) < 1e-9


def test_lcs_positions():
    rnd = random.Random(1)

    def size(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(200):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(10))] for _ in "ab")
        at = sorted(H.common(a, b))
        it = iter(b)
        assert len(at) == size(a, b) and all(any(y == a[i] for y in it) for i in at)


def test_lcs_of_very_long_pages():
    rnd = random.Random(2)
    a, b = ([str(rnd.randrange(400)) for _ in range(8000)] for _ in "ab")
    assert len(H.common(a, b)) > 400 and len(H.common(a, a)) == 8000


def test_blocks_of_a_page():
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header>Top</header><nav><ul><li>Menu</ul></nav>
    <div class="ad">Buy</div><aside>Side</aside><article><h1>Head &amp; line</h1><p><b>First <i>part</i><br>second   <p>Third&nbsp;x<!-- <p>c</p> -->
    <div class="comments"><p>Said</p></div><ul><li>a<li>b</ul><form><p>Name</p></form></article><p>Open line</p><footer>&copy; F</footer>"""
    assert H.lines(page) == [
        (0, "Top"), (0, "Menu"), (0, "Buy"), (0, "Side"), (2, "Head & line"), (2, "First part second"), (2, "Third x"), (0, "Said"), (2, "a"), (2, "b"), (0, "Name"), (1, "Open line"), (0, "© F"),
    ]
    got = lambda html: [t for k, t in H.lines(html) if k]
    story = "<article><h2 id='related-work'>Related work</h2><section id='search'><p>In <script>x('<p>')</script>one <span class='ad'>buy</span>line</p></section><div class='comment-list'>Said</div></article>"
    for page in (story, f"<div class='site has-sidebar'>{story}</div>", f"<div class='sidebar'><article>Teaser</article></div><div class='promo'>{story}</div>"):
        assert got(page) == ["Related work", "In one line"]
    assert got("<div class='site-footer'>f</div><div class='ad-12'>a</div><div id='sidebar'>s</div><p>t</p><button>b</button> u") == ["t", "u"]
    assert H.lines("") == [] and H.lines("plain") == [(1, "plain")] and H.lines("<p") == []


def test_differencing_between_neighbours(spark):
    rows = [(i, f"http://h.org/a/{i}", f"<div>Site name</div><p>Story {i}</p><p>All rights</p>") for i in range(4)]
    rows += [(10, "http://other.org/x", "<div>Site name</div><p>Alone</p>"), (11, None, None), (12, "nonsense", ""), (13, "http://h.org/b", "<article><p>All rights</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as text")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.page_id: r.text for r in H.extract(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {0: "Story 0", 1: "Story 1", 2: "Story 2", 3: "Story 3", 10: "Site name\n\nAlone", 11: "", 12: "", 13: "All rights"}
    assert H.extract(df.limit(0)).count() == 0


def extracted(spark, rows, partitions):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        return {r.page_id: r.text for r in H.extract(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_copies_do_not_delete_each_other(spark):
    story = "a long story of its own that nobody else tells, told at some length, with a turn and an end " * 4

    def page(i, more=""):
        return f"<div>Site name</div><p>{i} {story}</p><p>{i} second {story}</p><p>All rights{more}</p>"

    rows = [(i, f"http://h.org/{i // 3}", page(i // 3)) for i in range(9)]  # each crawled three times
    rows += [(20 + i, f"http://m.org/{'ab'[i]}", page(7)) for i in range(2)]  # mirrored, nothing else there
    rows += [(30 + i, f"http://n.org/{i}", page(7, f" {i}")) for i in range(2)]  # copies with changes
    got = extracted(spark, rows, 1)
    own = [f"{i} {story}".strip() + "\n\n" + f"{i} second {story}".strip() for i in range(9)]
    assert {i: got[i] for i in range(9)} == {i: own[i // 3] for i in range(9)}
    assert got[20] == got[21] == f"Site name\n\n{own[7]}\n\nAll rights"
    assert got[30] == f"Site name\n\n{own[7]}\n\nAll rights 0"


def test_text_does_not_depend_on_parts(spark):
    """Pages look over the borders of parts, through parts of copies, and not into other hosts."""
    rows = [(i, f"http://h.org/a/{i:02d}", f"<div>Site name</div><p>Story {i}</p><p>All rights</p>") for i in range(14)]
    rows += [(20 + i, "http://h.org/a/05", "<div>Site name</div><p>Story 5</p><p>All rights</p>") for i in range(10)]
    rows += [(40, "http://i.org/x", "<div>Site name</div><p>Alone</p>"), (None, "http://h.org/a/07", "<p>Site name</p><p>No id</p>")]
    want = {i: f"Story {i}" for i in range(14)} | {20 + i: "Story 5" for i in range(10)} | {40: "Site name\n\nAlone", None: "No id"}
    for n in (1, 3, 40):
        assert extracted(spark, rows, n) == want


def test_segmentation():
    counts = np.zeros(U.BUCKETS)
    for w, n in (("ththen", 500), ("www", 900), ("example", 900)):
        counts[U.bucket(w)] += n
    s = U.Segmenter(counts, U.DICTIONARY)
    assert s.split("cheappills") == ["cheap", "pills"] and s.split("casinobonus") == ["casino", "bonus"]
    assert s.split("ththen") == ["ththen"] and s.split("") == [] and s.split("newsletterx")[0] != ""
    assert U.names("Cheap-Pills.example2") == ["cheap", "-", "pills", "example", "0"]


def test_url_filter(spark):
    hosts = ["news.example.org"] * 30 + ["cheap-pills.example.org", "casinobonus.example.net", "WWW.Example.com", "m.example.com"] * 3
    rows = [(i, f"https://{h}/en/{i}?q=1#f") for i, h in enumerate(hosts)] + [(100, None), (101, "no host"), (102, "x://Ä.COM"), (103, "http://a.net/es/x"), (104, "http://a.com")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
    got = {r.page_id: r for r in U.filter_urls(df, rules).collect()}
    for i, h in enumerate(hosts):
        r = got[i]
        low = h.lower()
        assert (r.host, r.path) == (low, f"/en/{i}")
        rule = {"www.example.com": ("www.example.com/en/", "allow"), "m.example.com": ("example.com/en/", "block")}.get(low)
        assert (r.rule, r.verdict) == (rule or (None, "block" if "pills" in low or "bonus" in low else "allow"))
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(100, 105)] == [("", "", None), ("", "", None), ("Ä.com", "", None), ("a.net", "/es/x", "net/es/"), ("a.com", "", None)]
    assert U.filter_urls(df.limit(0), rules).count() == 0


def plain_split(name, cost):
    """Cheapest words of a name, over all ways to cut it."""
    ways = [[]] if not name else [[name[:k], *rest] for k in range(1, len(name) + 1) for rest in plain_split(name[k:], cost)]
    best = min(sum(map(cost, w)) for w in ways)
    return [w for w in ways if sum(map(cost, w)) == best][:1] if name else ways


def test_viterbi_and_bayes_against_plain_ones():
    rnd = random.Random(6)
    counts = np.zeros(U.BUCKETS)
    for w in ("th", "the", "re", "casino", "win", "here"):
        counts[U.bucket(w)] += rnd.randrange(2, 900)
    s = U.Segmenter(counts, U.DICTIONARY)
    cost = lambda w: s.costs([w])[0]
    for _ in range(40):
        name = "".join(rnd.choice(["th", "e", "re", "win", "x", "he"]) for _ in range(rnd.randrange(1, 5)))[:9]
        assert np.isclose(sum(map(cost, s.split(name))), sum(map(cost, plain_split(name, cost)[0])))
    net = U.UrlModel(counts)
    examples = U.example_counts(net.segmenter)
    size = [sum(v[k] for v in examples.values()) for k in (0, 1)]
    for host in ("casino-win", "cheappills.org", "cityschool", "free.library", "unknown"):
        x = 0.0
        for t in net.segmenter.tokens(host, ""):
            n = examples.get(t, [0, 0])
            like = [np.log((n[k] + U.ALPHA) / (size[k] + U.ALPHA * len(examples))) for k in (0, 1)]
            x += like[1] - like[0]
        assert np.isclose(net.blocked(host, ""), 1 / (1 + np.exp(-x)))
    assert net.blocked("cryptography.org", "") < 0.5 < net.blocked("cryptobonus.org", "")
    assert len(s.split("q" * 60)) == 1


def test_names_split_among_many_words(spark):
    """Host names are split however many distinct words the paths hold (65,536 cells before)."""
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("bcdfghjklmnpqrstvwxz") + rnd.choice("aeiou") for _ in range(4)) for _ in range(150_000)]
    rows = [(i, "http://site.org/" + "/".join(vocabulary[i * 50 : i * 50 + 50] * 2)) for i in range(3000)]
    bad = ["freepoker.org", "casinobonus.net", "cheappills.org", "nakedpayday.com"]
    rows += [(10_000 + i, f"http://{h}/a") for i, h in enumerate(bad)]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    got = {r.page_id: r.verdict for r in U.filter_urls(df, []).collect()}
    assert [got[10_000 + i] for i in range(len(bad))] == ["block"] * len(bad)
    assert got[0] == got[2999] == "allow"


def test_dictionary_among_many_counts():
    counts = np.zeros(U.BUCKETS)
    counts[U.bucket("www")] += 50_000_000
    s = U.Segmenter(counts, U.DICTIONARY)
    assert s.split("freepoker") == ["free", "poker"] and s.split("zqvxkjwpt") == ["zqvxkjwpt"]


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline as C

    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "repeats", "packing"]
    folder = tmp_path / "sf"
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet((folder / "documents.parquet").as_uri())
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet((folder / "labels.parquet").as_uri())
    rows = C.run(spark, folder.as_uri()).collect()
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())
    ids = {r.doc_id for r in rows}
    assert 40 in ids and 50 not in ids  # the first of two equal texts stays


def test_registry():
    import __spark_entry__ as E

    names = list(E.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 11)]
    assert "pipeline" in names and os.path.exists(E.__file__)
