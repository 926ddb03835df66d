"""Blocking, matching, splitting, merging, deltas and exports."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from kinfold.config import ResolverOptions, Settings
from kinfold.operators import blocking as B
from kinfold.operators.components import connected_components
from kinfold.operators.matching import match_edges
from kinfold.operators.split import fold, representative
from kinfold.plans.jobs import Registry, orchestrate, run_sources
from kinfold.plans.resolve import run_folder
from kinfold.service import BadManifest, ExportService, NotFound, iso_to_ms
from kinfold.sources.exports import export_name, file_sha256
from kinfold.sources.files import Files
from kinfold.sources.profiles import load_profiles


def test_components_against_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(300, 300), (None, 1)]
    up = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    want = {x: top(x) for e in edges for x in e if e[0] is not None}
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {r.id: r.component for r in connected_components(df).collect()} == want
    assert connected_components(df.limit(0)).count() == 0


def profiles(spark, rows):
    """rows of (full_name, dobs, nats, aliases)"""
    data = [(i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "idx long, full_name string, dobs array<string>, nats array<string>, name_aliases array<string>")


def keys_of(spark, *row):
    coded = B.with_codes(B.features(profiles(spark, [row])))
    return {r.key for r in B.blocking_keys(coded).collect()}


def test_blocking_keys(spark):
    assert keys_of(spark, "John Thompson", ["1970-01-01"], [], ["Jon Q Thompson"]) == {
        "fp:john thompson", "ph:JN:1970", "phl:TMPSN:1970", "tail2:john_thompson:1970", "tok:thompson",
        "afp:jon q thompson", "aph:JN:1970", "aphl:TMPSN:1970",
    }
    assert keys_of(spark, "John Thompson", [], [], ["short"]) == {"fp:john thompson"}
    assert keys_of(spark, "Alexander Thompson", None, None, None) == {"fp:alexander thompson", "tok:alexander", "tok:thompson"}
    assert keys_of(spark, "bin saleh", ["1970"], [], []) == {"fp:bin saleh", "ph:SL:1970", "phl:SL:1970"}
    assert keys_of(spark, "  ", ["1970"], [], ["Some Alias"]) == set()
    assert keys_of(spark, None, ["1970"], [], ["Some Alias"]) == set()


def test_block_caps(spark):
    rows = [("Same Name", [f"{1970 + i % 2}"], [], []) for i in range(6)] + [("Other One", [], [], [])]
    coded = B.with_codes(B.features(profiles(spark, rows)))
    keys = B.blocking_keys(coded)
    refined = {(r.key, r.idx) for r in B.refined_keys(keys, coded, 4).collect()}
    names = {k for k, _ in refined}
    assert "fp:name same|y:1970|phl:NM" in names and "fp:name same" not in names
    assert "ph:SM:1970" in names  # three rows, below the cap
    assert B.downblocked(keys, 4) == 1
    pairs = {(r.a, r.b) for r in B.candidate_pairs(B.refined_keys(keys, coded, 4)).collect()}
    assert pairs == {(a, b) for a in range(6) for b in range(6) if a < b and (a - b) % 2 == 0}
    assert B.refined_keys(keys, coded, 2).count() == 0


@pytest.mark.parametrize(
    "dated, nat, alias, score, match",
    [
        (True, False, True, 92.0, False), (True, False, False, 92.1, True), (True, True, False, 90.0, False), (True, True, False, 90.1, True),
        (False, False, False, 97.0, True), (False, False, False, 96.9, False), (False, True, False, 96.0, True), (False, True, False, 95.9, False),
        (False, False, True, 93.0, True), (False, False, True, 92.9, False), (False, True, True, 92.0, True), (False, True, True, 91.9, False),
    ],
)
def test_match_rule(spark, dated, nat, alias, score, match):
    df = spark.createDataFrame([(1, 2, dated, nat, alias, score)], "a long, b long, dated boolean, nat boolean, alias boolean, score double")
    assert (match_edges(df).count() == 1) is match


def test_split_fold():
    years = [{"1970"}, {"1980"}, {"1970", "1980"}, {"1980"}]
    assert fold([("n", y, set()) for y in years]) == [0, 1, 0, 0]
    assert fold([("n", set(), set())] * 3) == [0, 0, 0]
    rows = [("John Smith", {"1970"}, {"john smith"}), ("john smith", set(), set()), ("Jane", set(), set()), (None, set(), set())]
    assert fold(rows) == [0, 0, 1, 1]
    # 95 to 98 needs a shared alias
    near = [("abcdefghijklmnopqrst", {"1970"}, {"x"}), ("abcdefghijklmnopqrs", set(), {"x"}), ("abcdefghijklmnopqrs", set(), {"y"})]
    assert fold(near) == [0, 0, 1]
    assert representative(["a", "bb", "a  ", "bb", None]) == "bb"


PEOPLE = [
    {"data": {"fullName": "John Thompson", "datesOfBirthIso": ["1970-01-02"], "nationality": "Pakistan", "gender": "M", "notes": [{"b": 1, "a": 2}]}, "datasets": ["sdn", " eu "]},
    {"data": {"fullName": "john  thompson", "datesOfBirthIso": ["1970"], "gender": "F", "isDeleted": True, "addresses": "x", "sanEntries": {"current": [1], "former": []}}, "datasets": ["sdn", 5]},
    {"data": {"fullName": "Someone Different", "nameAliases": ["Alias One", {"fullName": "Alias Two"}]}, "datasets": []},
]


def write(folder, people, name="a/b.jsonl"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "".join(json.dumps(p, ensure_ascii=False) + "\n" for p in people)
    (gzip.open(path, "wt", encoding="utf-8") if name.endswith("gz") else path.open("w", encoding="utf-8")).write(text)


def test_load(spark, tmp_path):
    write(tmp_path, PEOPLE[:1], "a-x/one.jsonl")
    write(tmp_path, PEOPLE[1:2], "a/two.jsonl.gz")
    (tmp_path / "a" / "z.jsonl").write_text('\r\n  \nnot json\n[1]\n{"data":null}\n{"data":3}\n{"datasets":["x"]}\r\n{"data":{"fullName":"Last"}}\n', encoding="utf-8")
    (tmp_path / "a" / "other.txt").write_text("{}")
    got = load_profiles(spark, str(tmp_path))
    rows = got.profiles.orderBy("idx").collect()
    assert [(r.idx, r.full_name) for r in rows] == [(0, "john  thompson"), (1, None), (2, "Last"), (3, "John Thompson")]  # by path parts: a, then a-x
    assert rows[0].is_deleted and rows[0].bag_addresses == ['"x"'] and rows[0].bag_sanEntries_current == ["1"] and rows[0].datasets == ["sdn"]
    assert rows[3].nats == ["PK"] and rows[3].bag_notes == ['{"a":2,"b":1}'] and rows[3].dobs == ["1970-01-02"]
    assert got.rejected.count() == 4


def test_run_and_delta(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    assert run_folder(spark, str(source), out, ResolverOptions()) is None and not out.exists()
    write(source, PEOPLE)
    first = run_folder(spark, str(source), out, ResolverOptions(provider="P"))
    assert first["full"]["records"] == 2 and first["delta"]["new_records"] == 2 and first["full"]["datasets"] == ["eu", "sdn"]
    with gzip.open(out / first["full"]["file"], "rt", encoding="utf-8") as f:
        records = [json.loads(line) for line in f]
    one = records[0]["data"]
    assert one["fullName"] == "John Thompson" or one["fullName"] == "john thompson"
    assert records[0]["debug_trace"]["conflicts"] == {"gender_values": ["F", "M"]} and "debug_trace" not in records[1]
    assert records[1]["data"]["gender"] is None and records[1]["data"]["nameAliases"] == [{"fullName": "Alias One"}, {"fullName": "Alias Two"}]
    assert list(one)[:4] == ["qrCode", "resourceUri", "resourceId", "firstName"] and len(one) == 36
    again = run_folder(spark, str(source), out, ResolverOptions(provider="P"))
    assert again["delta"]["records"] == 0
    changed = json.loads(json.dumps(PEOPLE))
    changed[0]["data"]["notes"] = ["only notes"]
    changed[2]["data"]["isDeceased"] = True
    (source / "a" / "b.jsonl").unlink()
    write(source, changed)
    third = run_folder(spark, str(source), out, ResolverOptions(provider="P"))
    assert third["delta"]["updated_records"] == 1 and third["delta"]["new_records"] == 0
    (out / "P_state.json").write_text("{broken")
    assert run_folder(spark, str(source), out, ResolverOptions(provider="P"))["delta"]["new_records"] == 2
    service = ExportService(out, "P")
    assert service.health() == {"ok": True, "provider": "P"}
    assert service.full_manifest()["records"] == 2 and service.delta_manifest()["new_records"] == 2
    assert service.full_file().exists() and service.delta_file().exists()
    (out / "P_meta.json").write_text("{}")
    with pytest.raises(BadManifest):
        service.full_manifest()
    with pytest.raises(NotFound):
        ExportService(out, "none").full_manifest()
    off = run_folder(spark, str(source), tmp_path / "off", ResolverOptions(provider="P", enable_delta=False))
    assert off["delta"] is None and not (tmp_path / "off" / "P_state.json").exists()


def test_export_as_parts(spark, tmp_path):
    write(tmp_path / "in", PEOPLE)
    out = (tmp_path / "out").as_uri()
    got = run_folder(spark, (tmp_path / "in").as_uri(), out, ResolverOptions(provider="P"), single=False)
    folder = tmp_path / "out" / got["full"]["file"]
    lines = [x for p in sorted(folder.glob("part-*")) for x in gzip.open(p, "rt", encoding="utf-8").read().splitlines()]
    assert len(lines) == got["full"]["records"] == 2 and got["stats"]["seconds"] > 0
    assert Files(spark, out).sha256(got["full"]["file"]) == got["full"]["sha256"] == file_sha256(folder)
    assert run_folder(spark, (tmp_path / "in").as_uri(), out, ResolverOptions(provider="P"))["delta"]["records"] == 0


def test_representative_changes_as_names_join():
    rows = [("John Smith", {"1970"}, {"a"}), ("john smith", set(), {"a"}), ("john smith", set(), {"a"}), ("John Smith", set(), {"b"})]
    assert fold(rows) == [0, 0, 0, 0]


def test_delta_collisions(spark):
    from kinfold.operators import delta as D

    rows = [("a", i, h) for i, h in enumerate("ABA")] + [("b", 0, "X"), ("c", 0, "Y")]
    golden = spark.createDataFrame(rows, "resource_id string, seq long, golden_hash string")
    assert D.collisions(golden).count() == 2
    assert {r.resource_id: r.golden_hash for r in D.current_state(golden).collect()} == {"a": "A", "b": "X", "c": "Y"}
    old = spark.createDataFrame([("a", "Z"), ("b", "X"), ("gone", "Q")], "resource_id string, golden_hash string")
    got = sorted((r.resource_id, r.change) for r in D.classify(golden, old).collect())
    assert got == [("a", "UPDATED")] * 3 + [("b", "SAME"), ("c", "NEW")]


def test_jobs_and_settings():
    def bad():
        raise ValueError("x")

    assert run_sources({"a": lambda: 1, "b": bad}, 2) == {"a": "OK", "b": "FAIL: x"}
    registry = Registry({"a": bad}, {"m": {"region": "EU"}}, bad)
    got = orchestrate(registry, lambda: "done")
    assert got["sanctions"] == "OK" and got["media"] == "FAIL: x" and got["resolver"] == "OK"
    broken = orchestrate(registry, lambda: "done", run=lambda *_: bad())
    assert broken["resolver"] == "SKIP" and broken["sanctions"] == "FAIL: x"
    assert [r["kind"] for r in registry.rows()] == ["sanctions", "media"] and len(registry.rows(media=True)) == 1
    s = Settings.from_env({"SANCTION_SANCTIONS_CONCURRENCY": "7", "sanction_LOG_LEVEL": "x"})
    assert s.SANCTIONS_CONCURRENCY == 7 and s.LOG_LEVEL == "INFO"
    assert iso_to_ms("1970-01-01T00:00:01") == 1000 and iso_to_ms("1970-01-01T01:00:01+01:00") == 1000 and iso_to_ms(None) is None
    from datetime import datetime

    assert export_name("v1.2", "FULL", datetime(2020, 1, 2, 3)) == "v1.jsonl.gz"
    assert ResolverOptions(excluded_data_fields=()).excluded_data_fields == ("provider_version", "evidences", "notes")


def test_stream_detects_files_once(spark, tmp_path):
    from kinfold.streaming.detect import on_new_files

    write(tmp_path / "in", PEOPLE)
    seen = []
    act = lambda files, _: seen.append([r.path.rsplit("/", 1)[-1] for r in files.collect()])
    run = lambda: on_new_files(spark, (tmp_path / "in").as_uri(), str(tmp_path / "check"), act)
    assert run() == 1 and run() == 0
    write(tmp_path / "in", PEOPLE, "c/new.jsonl")
    assert run() == 1 and seen == [["b.jsonl"], ["new.jsonl"]]


def test_cli(capsys):
    from kinfold.cli import main

    assert main(["version"])["version"]
    assert main(["pipeline", "--no-sanctions", "--no-media"], Registry(), Settings(), lambda: "ok")["resolver"] == "OK"
    assert main(["sources", "--media"], Registry(media={"m": {}}))[0]["kind"] == "media"


def test_http(tmp_path):
    import threading
    import urllib.error
    import urllib.request

    from kinfold.service import server

    (tmp_path / "P_1.jsonl.gz").write_bytes(b"data")
    (tmp_path / "P_meta.json").write_text(json.dumps({"file": "P_1.jsonl.gz", "records": 1, "exported_at_iso": "1970-01-01T00:00:01"}))
    web = server(ExportService(tmp_path, "P"), "127.0.0.1", 0, "/x")
    threading.Thread(target=web.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{web.server_address[1]}"
    get = lambda p: urllib.request.urlopen(base + p).read()
    assert json.loads(get("/")) == {"ok": True, "provider": "P"}
    assert json.loads(get("/x/meta"))["timestamp"] == 1000 and get("/x/file") == b"data"
    with pytest.raises(urllib.error.HTTPError):
        get("/x/delta/meta")
    web.shutdown()


def test_split_without_union(spark):
    from kinfold.operators.split import split_components

    rows = [(0, 0, "A", ["1970"], ["a"]), (1, 0, "A", ["1980"], ["a"]), (2, 0, "A", [], ["a"]), (3, 3, "B", ["1970"], ["b"]), (4, 3, "B", ["1970"], ["b"]), (5, 5, "C", [], ["c"])]
    got = split_components(spark.createDataFrame(rows, "idx long, component long, full_name string, years array<string>, aliases array<string>"))
    assert {r.idx: (r.component, r.sub_no, r.pos.late) for r in got.collect()} == {0: (0, 0, 0), 1: (0, 1, 0), 2: (0, 0, 1), 3: (3, 0, 0), 4: (3, 0, 0), 5: (5, 0, 1)}
    assert "Union" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["-1", "2k"])
def test_refined_keys_joined_without_zip(spark, threshold):
    n = 6000
    ids = spark.range(n).withColumnRenamed("id", "idx")
    keys = ids.select("idx", F.explode(F.array(F.concat(F.lit("fp:"), (F.col("idx") % 50).cast("string")), F.concat(F.lit("ph:"), F.floor(F.col("idx") / 3).cast("string")))).alias("key"))
    coded = ids.select("idx", F.array(F.floor(F.col("idx") / 100).cast("string")).alias("years"), F.lit("X").alias("code_last"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        # 2,000 blocks of three; each block of 120 by years into 60 of two
        assert B.candidate_pairs(B.refined_keys(keys, coded, 12)).count() == n + n // 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def crowd(spark, seed):
    """Profiles of few names, so that many are alike, some without a name or only with signs."""
    rnd = random.Random(seed)
    names = ["John Thompson", "john  thompson", "Jon Thompson", "Thompson, John", "Anna Petrov", "Ana Petrov", "", "!!", None]
    rows = [(rnd.choice(names), rnd.choice([["1970-01-01"], ["1971", "1970"], [], None]), rnd.choice([["GB"], [], None]), rnd.choice([["Jon Thompson Jr"], ["Anna Maria Petrov", "x"], [], None])) for _ in range(150)]
    return B.features(profiles(spark, rows))


@pytest.mark.parametrize("cap", [6, 20, 500])
def test_kinds_have_the_pairs_of_profiles(spark, cap):
    from itertools import combinations

    from kinfold.operators import kinds as K

    feats = crowd(spark, cap)
    coded = B.with_codes(feats)
    keys = B.blocking_keys(coded)
    blocks = {}
    for r in B.refined_keys(keys, coded, cap).collect():
        blocks.setdefault(r.key, []).append(r.idx)
    want = {p for ids in blocks.values() for p in combinations(sorted(ids), 2)}
    kinds = K.find(feats, cap)
    got = [(r.a, r.b) for r in K.expanded(kinds.pairs("list")).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert kinds.pairs().count() < len(want)  # alike profiles are compared once
    assert K.count_pairs(kinds.pairs()).first()["actual"] == len(want)
    assert B.downblocked(kinds.keys, cap) == B.downblocked(keys, cap)
    assert "HashAggregate" not in B.paired(kinds.rows)._jdf.queryExecution().executedPlan().toString()  # no pair is moved to be made once


def test_load_numbers_blocks_of_files(spark, tmp_path):
    from kinfold.operators.components import shared_dir

    person = lambda n: json.dumps({"data": {"fullName": n}})
    lines = {name: [person(f"{name} {i}") if i % 7 else "not json" for i in range(60)] for name in ("a/b.jsonl", "a/c.jsonl.gz", "a-x/d.jsonl")}
    for name, text in lines.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        (gzip.open(path, "wt") if name.endswith("gz") else path.open("w")).write("\n".join(text))
    tables = Files(spark, shared_dir(spark))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        before = tables.names()
        got = load_profiles(spark, tmp_path.as_uri())
        assert got.rejected.count() == 27 and tables.names() == before  # no profile is made for that
        rows = got.profiles.select("idx", "full_name").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [f"{name} {i}" for name in lines for i in range(60) if i % 7]
    assert [r.full_name for r in sorted(rows)] == want and [r.idx for r in sorted(rows)] == list(range(len(want)))


def test_kind_edges_and_components(spark):
    from kinfold.functions.similarity import token_sort_ratio
    from kinfold.operators import kinds as K
    from kinfold.operators.matching import COMPARED, scored_pairs

    feats = crowd(spark, 7)
    coded = B.with_codes(feats)
    rows = B.block_rows(B.refined_keys(B.blocking_keys(coded), coded, 500))
    want = {(r.a, r.b): r.score for r in match_edges(scored_pairs(B.paired(rows, coded.select("idx", *COMPARED)).where("a < b"))).collect()}
    norm = {r.idx: r.norm for r in feats.collect()}
    assert want and all(abs(s - token_sort_ratio(norm[a], norm[b])) < 1e-9 for (a, b), s in want.items())
    kinds = K.find(feats, 500)
    few = match_edges(scored_pairs(kinds.pairs("list", *COMPARED)), "list_a", "list_b")
    assert few.count() < len(want)
    assert {(r.a, r.b): r.score for r in K.expanded(few, "score").collect()} == want
    up = list(range(150))
    for _ in range(150):
        for a, b in want:
            up[a] = up[b] = min(up[a], up[b])
    got = {r.idx: r.component for r in kinds.components(match_edges(scored_pairs(kinds.pairs(*COMPARED)))).collect()}
    assert got == {i: up[i] for p in want for i in p}


@pytest.mark.parametrize("threshold", ["-1", "2k"])
def test_whole_run_without_zip(spark, threshold):
    from kinfold.plans.resolve import comparison_stats, resolve

    rows = [(f"{a} {b}", [f"{1970 + i % 3}"] if i % 4 else [], ["GB"], []) for i in range(8) for a in ("John", "Jon", "Anna") for b in ("Thompson", "Petrov")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        run = resolve(profiles(spark, rows), 6)
        stats = comparison_stats(run, 6)
        clusters = {r.idx for r in run.clusters.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert clusters == set(range(len(rows))) and stats["naive"] == len(rows) * (len(rows) - 1) // 2
    assert stats["downblocked"] > 0 and 0 < stats["actual"] < stats["naive"]
