"""Driver queries of whole runs: loading, resolving, splitting, exports, state, service and jobs.

Profiles come from ``kinfold.queries.PEOPLE``; files are written below the shared
folder, by date of the run, and read back by the library itself.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kinfold import queries as Q
from kinfold.config import ResolverOptions, Settings
from kinfold.operators import delta as D
from kinfold.operators import golden as G
from kinfold.operators.components import saved, shared_dir
from kinfold.plans.jobs import Registry, orchestrate, run_sources
from kinfold.plans.resolve import comparison_stats, golden_records, resolve
from kinfold.service import BadManifest, ExportService, NotFound
from kinfold.sources.exports import export, load_state
from kinfold.sources.files import Files
from kinfold.sources.profiles import load_profiles

VERSION_MS = Q.VERSION_MS


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _some(*cols):
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


def _written(spark: SparkSession, d: str) -> str:
    """Profiles as JSON lines, plain and gzipped, in folders whose order by parts differs from that by text.

    All tasks write: a folder has ordered files, as many as its size asks for.
    With them go lines that must be rejected, blank ones, values where lists are usual,
    nested lists, and a file of another kind.
    """
    v = Q._view(spark, d).repartition("idx")  # the table can be one small file
    nested = F.struct(_some("note").alias("current"), F.col("note").alias("former"))
    data = F.struct(
        F.col("full_name").alias("fullName"),
        _some("alias1", "alias2").alias("nameAliases"),
        _some("dob1", "dob2").alias("datesOfBirthIso"),
        F.col("nat").alias("nationality"),
        F.array(F.lit("FR"), F.lit(None).cast("string")).alias("nationalitiesIsoCodes"),
        "gender",
        nested.alias("sanEntries"),
        F.array("note", "note").alias("relEntries"),
        F.col("note").alias("individualLinks"),
        F.array(F.struct(F.lit(2).alias("b"), F.lit("x").alias("a"))).alias("addresses"),
    )
    line = F.to_json(F.struct(data.alias("data"), F.array("dataset").alias("datasets")))
    bad = F.when(F.col("idx") % 10 == 0, "not json").when(F.col("idx") % 10 == 1, '[{"data":{}}]').when(F.col("idx") % 10 == 2, '{"data":3}').when(F.col("idx") % 10 == 3, " \t")
    rows = v.select("idx", F.explode(F.array(F.struct(F.lit(0).alias("n"), bad.alias("value")), F.struct(F.lit(1).alias("n"), line.alias("value")))).alias("x"))
    rows = saved(rows.select("idx", "x.n", "x.value").where("value is not null"))
    out = _folder(spark, "profiles")
    for k, (where, codec) in enumerate((("a/deep", "gzip"), ("a-x", "none"), ("b", "gzip"))):
        part = rows.where(F.col("idx") % 3 == k).orderBy("idx", "n").select("value")
        part.write.option("compression", codec).text(f"{out}/{where}")
    files = Files(spark, out)
    for where in ("a/deep", "a-x", "b"):
        for name in files.names(where):
            if name.startswith("part-"):
                files.move(f"{where}/{name}", f"{where}/{name.split('-')[1]}.jsonl" + (".gz" if name.endswith("gz") else ""))
    files.write("notes.txt", "not a profile")
    return out


def load_order(spark, d):
    """Numbers of loaded profiles by path parts and line, with what was read of each."""
    p = load_profiles(spark, _written(spark, d)).profiles
    bar = Q._bar
    return p.select("idx", "full_name", "gender", bar("name_aliases").alias("name_aliases"), bar("dobs").alias("dobs"), bar("nats").alias("nats"), bar("datasets").alias("datasets"))


def load_rejects(spark, d):
    """Lines that no profile is made of, by reason."""
    return load_profiles(spark, _written(spark, d)).rejected.groupBy("reason").agg(F.count("*").alias("n"))


def load_bags(spark, d):
    """Nested lists, and values in place of lists, through loading and merging by name."""
    p = load_profiles(spark, _written(spark, d)).profiles
    p = p.withColumns({"component": F.xxhash64("full_name"), "sub_no": F.lit(0), "pos": F.struct(F.lit(0).alias("late"), F.col("idx").alias("idx"))})
    g = G.merge(p)
    names = {"san_current": "sanEntries_current", "san_former": "sanEntries_former", "pep_current": "pepEntries_current", "rel": "relEntries", "links": "individualLinks", "addresses": "addresses"}
    return g.select("full_name", "n_profiles", *(Q._bar(f"bag_{b}").alias(a) for a, b in names.items()))


def comparison_statistics(spark, d):
    """The counters of a run but its seconds."""
    got = comparison_stats(resolve(Q.people(spark, d), Q.SMALL), Q.SMALL)
    return spark.createDataFrame([(got["naive"], got["actual"], round(got["saved_percent"], 6), got["downblocked"])], "naive long, actual long, saved_percent double, downblocked long")


def _exported(spark, d, options: ResolverOptions, single: bool | None = None):
    """Two runs into one folder: the persons divisible by three, then all with other flags for some."""
    out = _folder(spark, "export")
    clustered = saved(Q._clustered(spark, d))
    first = clustered.where("person % 3 = 0")
    second = clustered.withColumn("is_deceased", F.col("is_deceased") | (F.col("person") % 9 == 0))
    made = lambda p: saved(G.with_json(G.merge(p), options.provider, VERSION_MS, options.excluded_data_fields))
    return out, export(made(first), out, options, single), export(made(second), out, options, single)


def export_full(spark, d):
    """The FULL file's lines in their order."""
    out, _, got = _exported(spark, d, ResolverOptions(source_dir="here"))
    lines = spark.read.text(f"{out}/{got['full']['file']}")
    return lines.select(F.monotonically_increasing_id().alias("n"), F.sha2("value", 256).alias("line_sha256"))


def export_parts(spark, d):
    """The same export as part files of several tasks."""
    out, _, got = _exported(spark, d, ResolverOptions(source_dir="here"), single=False)
    lines = spark.read.text(f"{out}/{got['full']['file']}")
    return lines.select(F.sha2("value", 256).alias("line_sha256"))


def export_delta(spark, d):
    """The DELTA file's ids after a second run."""
    out, _, got = _exported(spark, d, ResolverOptions())
    lines = spark.read.text(f"{out}/{got['delta']['file']}")
    return lines.select(F.get_json_object("value", "$.data.resourceId").alias("resource_id"))


def export_manifests(spark, d):
    """Fields of both manifests as they stand in their files; digests are made anew."""
    out, first, _ = _exported(spark, d, ResolverOptions(source_dir="here", max_block_size=77))
    files = Files(spark, out)
    rows = []
    for name in ("kinfold_meta.json", "kinfold_delta_meta.json"):
        m = json.loads(files.read(name))
        same = files.sha256(m["file"]) == m["sha256"]
        more = m.get("collisions", {}).get("count", -1), m.get("new_records", -1), m.get("updated_records", -1), m.get("max_block_size", -1), m.get("source_dir", ""), m.get("state_file", "")
        rows.append((name, m["format"], m["records"], "|".join(m["datasets"]), "|".join(m["hashing"]["excluded_data_fields"]), same, *more))
    rows.append(("first run", "", first["full"]["records"], "", "", True, -1, first["delta"]["new_records"], first["delta"]["updated_records"], -1, "", ""))
    return spark.createDataFrame(rows, "manifest string, format string, records long, datasets string, excluded string, sha_ok boolean, collisions long, new_records long, updated_records long, max_block_size long, source_dir string, state_file string")


def export_state(spark, d):
    """The state's hashes after the second run."""
    out, _, _ = _exported(spark, d, ResolverOptions())
    _, hashes = load_state(spark, Files(spark, out), "kinfold_state.json")
    return hashes


def export_switches(spark, d):
    """What a run leaves: without delta, on an empty input, and of a broken state."""
    out = _folder(spark, "switch")
    golden = saved(G.with_json(G.merge(Q._clustered(spark, d).where("person < 5")), "kinfold", VERSION_MS))
    got = export(golden, out, ResolverOptions(enable_delta=False))
    files = Files(spark, out)
    rows = [("no delta manifest", got["delta"] is None and not files.exists("kinfold_delta_meta.json")), ("no state", not files.exists("kinfold_state.json"))]
    files.write("kinfold_state.json", "{broken")
    rows.append(("broken state is empty", load_state(spark, files, "kinfold_state.json")[1].isEmpty()))
    from kinfold.plans.resolve import run_folder

    nothing = _folder(spark, "nothing")
    rows.append(("nothing written", run_folder(spark, _folder(spark, "missing"), nothing, ResolverOptions()) is None and not Files(spark, nothing).exists()))
    return spark.createDataFrame(rows, "what string, holds boolean")


def service_answers(spark, d):
    """Status and main fields of each route, over an export that the service can open."""
    import tempfile
    from pathlib import Path

    rows = []
    with tempfile.TemporaryDirectory() as folder:  # the service serves local files of its own host
        (Path(folder) / "P_1.jsonl.gz").write_bytes(b"data")
        (Path(folder) / "P_meta.json").write_text(json.dumps({"file": "P_1.jsonl.gz", "records": 3, "datasets": ["x"], "exported_at_iso": "1970-01-01T00:00:01Z"}))
        (Path(folder) / "P_delta_meta.json").write_text(json.dumps({"records": 1}))
        service = ExportService(folder, "P")
        for route, ask in (("/", service.health), ("/meta", service.full_manifest), ("/file", service.full_file), ("/delta/meta", service.delta_manifest), ("/none", ExportService(folder, "Q").full_manifest)):
            try:
                body = ask()
                rows.append((route, 200, body.get("records", -1), body.get("sha256", "")) if isinstance(body, dict) else (route, 200, body.stat().st_size, ""))
            except (NotFound, BadManifest) as e:
                rows.append((route, 404 if isinstance(e, NotFound) else 500, -1, ""))
    return spark.createDataFrame(rows, "route string, status int, records long, sha256 string")


def job_gating(spark, d):
    """Which phases run: failing sources and media don't stop the resolver, a failing phase of sanctions does."""

    def bad():
        raise ValueError("x")

    registry = Registry({"a": bad, "b": lambda: 1}, {"m": {"region": "EU"}}, bad)
    cases = {"sources fail": orchestrate(registry, lambda: "done"), "phase fails": orchestrate(registry, lambda: "done", run=lambda *_: bad()), "resolver off": orchestrate(registry, bad, media=False, resolve=False), "resolver fails": orchestrate(Registry(), bad)}
    rows = [(k, *(got[x].split(":")[0] for x in ("sanctions", "media", "resolver"))) for k, got in cases.items()]
    one = run_sources(registry.sanctions, 1)
    rows.append(("single sources", one["a"].split(":")[0], one["b"], str(len(registry.rows()))))
    s = Settings.from_env({"SANCTION_DATA_LAKE_DIR": "s3a://lake/", "SANCTION_SANCTIONS_CONCURRENCY": "7"})
    rows.append(("settings", s.processed, s.output, str(s.SANCTIONS_CONCURRENCY)))
    return spark.createDataFrame(rows, "case string, first string, second string, third string")


def dob_split(spark, d):
    run = resolve(Q.people(spark, d))
    return run.clusters.select("idx", "component", "sub_no")


def resolve_golden(spark, d):
    """The whole resolver: one row per golden record."""
    options = ResolverOptions()
    got = golden_records(resolve(Q.people(spark, d), options.max_block_size), options, VERSION_MS)
    return got.select("component", "sub_no", "resource_id", "full_name", "n_profiles", "golden_hash")


def resolve_delta(spark, d):
    """Changes of a whole run against a state without every third id."""
    options = ResolverOptions()
    golden = saved(golden_records(resolve(Q.people(spark, d), options.max_block_size), options, VERSION_MS).withColumn("seq", F.struct("component", "sub_no")))
    old = D.current_state(golden).where(F.substring("resource_id", 1, 1) < "a")
    return D.classify(golden, old).groupBy("change").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ DuckDB

_ORDERED = "ordered AS (SELECT f.*, row_number() OVER (ORDER BY idx % 3, idx) - 1 AS place FROM f)"
_CODES_WITH_FR = Q._CODE_OF.replace("list_sort(list_distinct(", "((")


def _ratio(x: str, y: str) -> str:
    return f"CASE WHEN {x} = {y} THEN 100.0 ELSE 100.0 * (1.0 - (length({x}) + length({y}) - 2 * {Q._lcs(x, y)}) / CAST(length({x}) + length({y}) AS DOUBLE)) END"


def _words_sorted(x: str) -> str:
    return rf"array_to_string(list_sort(list_filter(regexp_split_to_array(lower({x}), '\s+'), lambda t: t <> '')), ' ')"


#: The clusters of a run: components, then the fold over dated members, then over undated ones, in order of idx.
_SPLIT = f"""both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT idx AS a, idx AS b FROM f UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
comp AS (SELECT a AS idx, min(b) AS component FROM reach GROUP BY a),
m AS (SELECT f.idx, component, f.years, f.aliases, {Q._squeeze('full_name')} AS name FROM f JOIN comp USING (idx)),
dated AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY idx) AS k FROM m WHERE len(years) > 0),
fold(component, k, spot, sets, names, als) AS (
 SELECT component, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS VARCHAR[][]), CAST([] AS VARCHAR[][]), CAST([] AS VARCHAR[][]) FROM (SELECT DISTINCT component FROM dated)
 UNION ALL
 SELECT component, k, list_append(spot, CASE WHEN home IS NULL THEN len(sets) + 1 ELSE home END),
  CASE WHEN home IS NULL THEN list_append(sets, years) ELSE list_transform(sets, lambda s, i: CASE WHEN i = home THEN list_concat(s, years) ELSE s END) END,
  CASE WHEN home IS NULL THEN list_append(names, [name]) ELSE list_transform(names, lambda s, i: CASE WHEN i = home THEN list_append(s, name) ELSE s END) END,
  CASE WHEN home IS NULL THEN list_append(als, aliases) ELSE list_transform(als, lambda s, i: CASE WHEN i = home THEN list_concat(s, aliases) ELSE s END) END
 FROM (SELECT fold.component, dated.k, fold.spot, fold.sets, fold.names, fold.als, dated.years, dated.name, dated.aliases,
  nullif(list_position(list_transform(fold.sets, lambda s: list_has_any(s, dated.years)), true), 0) AS home
  FROM fold JOIN dated ON dated.component = fold.component AND dated.k = fold.k + 1)),
folded AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY component ORDER BY k DESC) = 1),
undated AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY idx) AS j FROM m WHERE len(years) = 0 AND name <> '' AND component IN (SELECT component FROM folded)),
alike AS (SELECT u.idx, map(list(v.name), list(CASE WHEN x = y THEN 100.0 WHEN levenshtein(x, y) > 0.2 * (length(x) + length(y)) THEN 0.0 ELSE s END)) AS score FROM undated u
 JOIN (SELECT DISTINCT component, name FROM m) v ON v.component = u.component
 JOIN (SELECT s1 AS x, s2 AS y, CASE WHEN s1 = s2 OR levenshtein(s1, s2) > 0.2 * (length(s1) + length(s2)) THEN 0.0 ELSE {_ratio('s1', 's2')} END AS s
  FROM (SELECT DISTINCT {_words_sorted('u.name')} AS s1, {_words_sorted('v.name')} AS s2 FROM undated u JOIN m v ON v.component = u.component)) ON x = {_words_sorted('u.name')} AND y = {_words_sorted('v.name')}
 GROUP BY u.idx),
late(component, j, who, spot, names, als) AS (
 SELECT component, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), names, als FROM folded
 UNION ALL
 SELECT component, j, list_append(who, idx), list_append(spot, coalesce(home, 0)),
  CASE WHEN home IS NULL THEN names ELSE list_transform(names, lambda s, i: CASE WHEN i = home THEN list_append(s, name) ELSE s END) END,
  CASE WHEN home IS NULL THEN als ELSE list_transform(als, lambda s, i: CASE WHEN i = home THEN list_concat(s, aliases) ELSE s END) END
 FROM (SELECT *, CASE WHEN list_max(good) >= 0 THEN list_position(good, list_max(good)) END AS home
  FROM (SELECT *, list_transform(scores, lambda s, i: CASE WHEN s >= 98 OR (s >= 95 AND list_has_any(als[i], aliases)) THEN s ELSE -1.0 END) AS good
   FROM (SELECT late.component, u.j, late.who, late.spot, late.names, late.als, u.idx, u.name, u.aliases,
    list_transform(late.names, lambda ns: alike.score[list_sort(list_transform(list_distinct(ns), lambda n: struct_pack(c := -len(list_filter(ns, lambda x: x = n)), l := -length(n), p := list_position(ns, n), n := n)))[1].n]) AS scores
    FROM late JOIN undated u ON u.component = late.component AND u.j = late.j + 1 JOIN alike ON alike.idx = u.idx)))),
attached AS (SELECT unnest(who) AS idx, unnest(spot) AS spot FROM (SELECT who, spot FROM late QUALIFY row_number() OVER (PARTITION BY component ORDER BY j DESC) = 1)),
placed AS (SELECT dated.idx, folded.spot[dated.k] AS spot FROM dated JOIN folded USING (component) UNION ALL SELECT idx, spot FROM attached WHERE spot > 0),
split AS (SELECT m.idx, m.component, CAST(CASE WHEN folded.component IS NULL THEN 0 WHEN placed.spot IS NULL THEN len(folded.sets) ELSE placed.spot - 1 END AS INTEGER) AS sub_no
 FROM m LEFT JOIN folded ON folded.component = m.component LEFT JOIN placed ON placed.idx = m.idx)"""


def _whole_run() -> str:
    """The golden records of a run: those of clusters, with (component, sub_no) as the person."""
    clusters = "g AS (SELECT f.* EXCLUDE (person), split.component * 1000 + split.sub_no AS person, CASE WHEN len(years) = 0 THEN 1 ELSE 0 END AS late FROM f JOIN split USING (idx))"
    votes = Q._VOTES.replace(Q._CLUSTERS, clusters)
    return f"""WITH RECURSIVE {Q._PPL}, {Q._KEYS}, {Q._refined(500)}, {Q._PAIRS}, {Q._SCORED}, {_SPLIT}, {votes}, {Q._IDS}, {Q._FACTS},
whole AS (SELECT * FROM facts JOIN ids USING (person) JOIN v_full_name USING (person) JOIN v_first_name USING (person) JOIN v_last_name USING (person) LEFT JOIN v_gender USING (person)),
heads AS (SELECT person, count(*) AS n_profiles FROM g GROUP BY person),
golden AS (SELECT CAST(person // 1000 AS BIGINT) AS component, CAST(person % 1000 AS INTEGER) AS sub_no, resource_id, full_name, n_profiles, sha256({Q._envelope(ResolverOptions.excluded_data_fields, True)}) AS golden_hash FROM whole JOIN heads USING (person))"""


def _second_run(fields: str) -> str:
    """The golden records of the second export, by person."""
    dead = "facts AS (SELECT person, bool_or(is_deceased) OR person % 9 = 0 AS dead"
    every = Q._ALL.replace("facts AS (SELECT person, bool_or(is_deceased) AS dead", dead)
    return f"{every}, lines AS (SELECT person, {Q._envelope((), False)} AS line, resource_id, sha256({Q._envelope(ResolverOptions.excluded_data_fields, True)}) AS golden_hash, datasets, bool_before FROM whole JOIN (SELECT person AS person, bool_or(is_deceased) AS bool_before FROM g GROUP BY person) USING (person)) {fields}"


def oracle_sql() -> dict[str, str]:
    w = f"WITH {Q._PPL}"
    bar = lambda x: f"array_to_string({x}, '|')"
    run = _whole_run()
    new = "(SELECT count(*) FROM lines WHERE person % 3 <> 0)"
    updated = "(SELECT count(*) FROM lines WHERE person % 9 = 0 AND NOT bool_before)"
    facts = "(SELECT array_to_string(list_sort(list_distinct(flatten(list(datasets)))), '|') FROM lines)"
    excluded = "provider_version|evidences|notes"
    quoted = "json_array(note)"
    return {
        "load_order": f"{w}, {_ORDERED} SELECT CAST(place AS BIGINT) AS idx, full_name, gender, {bar('al')} AS name_aliases, {bar('list_filter([dob1, dob2], lambda x: x IS NOT NULL)')} AS dobs, {bar(f'list_concat([{chr(39)}FR{chr(39)}], list_filter({_CODES_WITH_FR}, lambda c: c <> {chr(39)}FR{chr(39)}))')} AS nats, dataset AS datasets FROM ordered",
        "load_rejects": f"WITH p AS ({Q.PEOPLE}) SELECT CASE idx % 10 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' ELSE 'data is not an object' END AS reason, count(*) AS n FROM p WHERE idx % 10 < 3 GROUP BY 1",
        "load_bags": f"{w}, q AS (SELECT *, CAST(to_json(note) AS VARCHAR) AS j FROM f) SELECT {Q._squeeze('full_name')} AS full_name, count(*) AS n_profiles, {bar('list_sort(list(j))')} AS san_current, {bar('list_sort(list(j))')} AS san_former, '' AS pep_current, {bar('list_sort(flatten(list([j, j])))')} AS rel, {bar('list_sort(list(j))')} AS links, {bar('list_transform(list(j), lambda x: ' + chr(39) + '{' + chr(34) + 'a' + chr(34) + ':' + chr(34) + 'x' + chr(34) + ',' + chr(34) + 'b' + chr(34) + ':2}' + chr(39) + ')')} AS addresses FROM q GROUP BY q.full_name",
        "comparison_statistics": f"{w}, {Q._KEYS}, {Q._refined(Q.SMALL)}, {Q._PAIRS}, t AS (SELECT (SELECT CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) FROM f) AS naive, (SELECT count(*) FROM pairs) AS actual, (SELECT count(DISTINCT key) FROM sized WHERE size > {Q.SMALL} AND regexp_matches(key, '^(fp|afp|tok):')) AS downblocked) SELECT naive, actual, round((1 - actual / CAST(naive AS DOUBLE)) * 100, 6) AS saved_percent, downblocked FROM t",
        "export_full": _second_run("SELECT row_number() OVER (ORDER BY person) - 1 AS n, sha256(line) AS line_sha256 FROM lines"),
        "export_parts": _second_run("SELECT sha256(line) AS line_sha256 FROM lines"),
        "export_delta": _second_run("SELECT resource_id FROM lines WHERE person % 3 <> 0 OR (person % 9 = 0 AND NOT bool_before)"),
        "export_manifests": _second_run(
            f"""SELECT 'kinfold_meta.json' AS manifest, 'jsonl.gz' AS format, (SELECT count(*) FROM lines) AS records, {facts} AS datasets, '{excluded}' AS excluded, true AS sha_ok,
 (SELECT count(*) FROM (SELECT golden_hash, lag(golden_hash) OVER (PARTITION BY resource_id ORDER BY person) AS b FROM lines) WHERE b <> golden_hash) AS collisions, CAST(-1 AS BIGINT) AS new_records, CAST(-1 AS BIGINT) AS updated_records, CAST(77 AS BIGINT) AS max_block_size, 'here' AS source_dir, '' AS state_file
 UNION ALL SELECT 'kinfold_delta_meta.json', 'jsonl.gz', {new} + {updated}, {facts}, '{excluded}', true, -1, {new}, {updated}, -1, '', 'kinfold_state.json'
 UNION ALL SELECT 'first run', '', (SELECT count(*) FROM lines WHERE person % 3 = 0), '', '', true, -1, (SELECT count(*) FROM lines WHERE person % 3 = 0), 0, -1, '', ''"""
        ),
        "export_state": _second_run("SELECT resource_id, arg_max(golden_hash, person) AS golden_hash FROM lines GROUP BY resource_id"),
        "export_switches": "SELECT * FROM (VALUES ('no delta manifest', true), ('no state', true), ('broken state is empty', true), ('nothing written', true)) AS t(what, holds)",
        "service_answers": "SELECT route, CAST(status AS INTEGER) AS status, CAST(records AS BIGINT) AS records, sha256 FROM (VALUES ('/', 200, -1, ''), ('/meta', 200, 3, sha256('data')), ('/file', 200, 4, ''), ('/delta/meta', 500, -1, ''), ('/none', 404, -1, '')) AS t(route, status, records, sha256)",
        "job_gating": """SELECT * FROM (VALUES ('sources fail', 'OK', 'FAIL', 'OK'), ('phase fails', 'FAIL', 'FAIL', 'SKIP'), ('resolver off', 'OK', 'SKIP', 'SKIP'), ('resolver fails', 'OK', 'SKIP', 'FAIL'),
 ('single sources', 'FAIL', 'OK', '3'), ('settings', 's3a://lake/schema', 's3a://lake/new_data', '7')) AS t("case", first, second, third)""",
        "event_props": "SELECT event_id, '{' || array_to_string(list_transform(list_sort(json_keys(props)), lambda k: '\"' || k || '\":' || CAST(json_extract(props, '$.\"' || k || '\"') AS VARCHAR)), ',') || '}' AS canonical FROM events",
        "dob_split": f"WITH RECURSIVE {Q._PPL}, {Q._KEYS}, {Q._refined(500)}, {Q._PAIRS}, {Q._SCORED}, {_SPLIT} SELECT idx, component, sub_no FROM split",
        "resolve_golden": f"{run} SELECT * FROM golden",
        "resolve_delta": f"{run}, now AS (SELECT resource_id, arg_max(golden_hash, component * 1000 + sub_no) AS now FROM golden GROUP BY 1) SELECT CASE WHEN substring(resource_id, 1, 1) < 'a' THEN 'SAME' ELSE 'NEW' END AS change, count(*) AS n FROM golden GROUP BY 1",
    }


QUERIES = {f.__name__: f for f in (load_order, load_rejects, load_bags, comparison_statistics, dob_split, export_full, export_parts, export_delta, export_manifests, export_state, export_switches, service_answers, job_gating, resolve_delta, resolve_golden)}
