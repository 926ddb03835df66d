"""Driver queries of the resolver's operators, with the SQL that DuckDB runs.

The provided tables hold no person profiles, so ``PEOPLE`` derives them from
customer keys in SQL that both engines accept: five profiles per person, with
variants of the name, aliases, birth dates and nationality texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.config import ResolverOptions
from kinfold.functions import country as C
from kinfold.functions import text as T
from kinfold.functions.phonetic import metaphone
from kinfold.functions.similarity import with_ratio
from kinfold.operators import blocking as B
from kinfold.operators import delta as D
from kinfold.operators import golden as G
from kinfold.operators import kinds as K
from kinfold.operators.components import saved, shared_dir
from kinfold.operators.matching import COMPARED, match_edges, scored_pairs
from kinfold.schema import complete
from kinfold.sources.profiles import profile_columns

PEOPLE = """
WITH base AS (SELECT c_custkey AS idx, CAST(FLOOR(c_custkey / 5) AS BIGINT) AS person FROM customer),
given AS (SELECT * FROM (VALUES (0,'Mohammed','Muhammad'),(1,'John','Jon'),(2,'Catherine','Katherine'),(3,'Sergei','Sergey'),
 (4,'José','Jose'),(5,'Youssef','Yusuf'),(6,'Philip','Phillip'),(7,'Anna','Ana'),(8,'Xavier','Javier'),(9,'Nguyen','Nguyễn'),
 (10,'Michael','Mikhail'),(11,'Hussein','Husain')) AS g(i, name, variant)),
family AS (SELECT * FROM (VALUES (0,'Al-Hassan'),(1,'de la Cruz'),(2,'Smith'),(3,'Schmidt'),(4,'O’Connor'),(5,'bin Saleh'),
 (6,'Thompson'),(7,'Wright'),(8,'Petrov'),(9,'Ivanova'),(10,'Garcia'),(11,'Müller'),(12,'Kowalczyk'),(13,'Rossi'),(14,'Zhang'),
 (15,'Jean–Baptiste'),(16,'Abdullahi'),(17,'McKenzie'),(18,'Filipowicz'),(19,'Shevchenko')) AS f(j, family)),
named AS (SELECT idx, person, name, variant, family, 1930 + (person * 13) % 70 AS y FROM base
 JOIN given ON i = person % 12 JOIN family ON j = CAST(FLOOR(person / 12) AS BIGINT) % 20)
SELECT idx, person, name AS first_name, family AS last_name,
 CASE idx % 5 WHEN 1 THEN variant || ' ' || family WHEN 2 THEN UPPER(name) || '  ' || family WHEN 3 THEN family || ', ' || name
  WHEN 4 THEN name || ' ' || family || '.' ELSE name || ' ' || family END AS full_name,
 CASE WHEN idx % 4 = 0 THEN variant || ' ' || family END AS alias1,
 CASE WHEN idx % 6 = 1 THEN name || ' ' || family || ' Jr' END AS alias2,
 CASE WHEN idx % 5 = 0 THEN NULL WHEN idx % 11 = 3 THEN CAST(y + 5 AS VARCHAR(10)) || '-01-02'
  ELSE CAST(y AS VARCHAR(10)) || '-03-04' END AS dob1,
 CASE WHEN idx % 7 = 0 THEN 'c. ' || CAST(y + 1 AS VARCHAR(10)) || '/12' WHEN idx % 9 = 4 THEN 'c1980 19700101' END AS dob2,
 CASE person % 8 WHEN 0 THEN 'Pakistan' WHEN 1 THEN 'United Kingdom and France' WHEN 2 THEN 'ru' WHEN 3 THEN 'Russia; UA'
  WHEN 4 THEN 'Germany (as at Dec 2019)' WHEN 5 THEN 'Rep. of Iraq' WHEN 6 THEN 'nan' ELSE 'Türkiye, Hong Kong, China' END AS nat,
 CASE idx % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender, idx % 13 = 0 AS is_deceased, idx % 17 = 0 AS is_deleted,
 CASE WHEN idx % 2 = 0 THEN 'sdn' ELSE ' eu ' END AS dataset, '{"n":' || CAST(idx % 4 AS VARCHAR(10)) || '}' AS note
FROM named
"""


def _view(spark: SparkSession, d: str) -> DataFrame:
    customer = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey")
    text = PEOPLE.replace("{", "{{").replace("}", "}}").replace("FROM customer", "FROM {customer}")
    return spark.sql(text, customer=customer)


def people(spark: SparkSession, d: str) -> DataFrame:
    """The synthetic profiles with all profile columns, and person."""
    v = _view(spark, d)
    some = lambda *c: F.filter(F.array(*c), lambda x: x.isNotNull())
    v = v.withColumns(
        {
            "name_aliases": some("alias1", "alias2"),
            "dobs": some("dob1", "dob2"),
            "nats": C.normalize(F.array("nat")),
            "datasets": F.array("dataset"),
            "bag_notes": F.array("note"),
            "bag_addresses": F.array("note", F.lit('{"a":1}')),
        }
    )
    person = v.select("idx", "person")
    return complete(v).join(person, "idx")


def _features(spark: SparkSession, d: str) -> DataFrame:
    return B.features(people(spark, d))


def _bar(c):
    return F.array_join(c, "|")


def norm_text(spark, d):
    return _view(spark, d).select("idx", T.norm_text(F.col("full_name")).alias("norm"), T.squeeze(F.col("full_name")).alias("display"))


def norm_part(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    return part.select("p_partkey", T.norm_text(F.col("p_name")).alias("norm"), T.fingerprint(T.name_tokens(T.norm_text(F.col("p_name")))).alias("fp"))


def name_tokens(spark, d):
    f = _features(spark, d)
    return f.select("idx", _bar("tokens").alias("tokens"), "fp", F.col("first").alias("first_token"), F.col("last").alias("last_token"))


def extract_years(spark, d):
    return _features(spark, d).select("idx", _bar("years").alias("years"))


def alias_set(spark, d):
    f = _features(spark, d)
    return f.select("idx", _bar(F.array_sort("aliases")).alias("aliases"), _bar("top").alias("top"))


def nationality_normalize(spark, d):
    return _view(spark, d).select("idx", _bar(C.normalize(F.array("nat"))).alias("codes"))


def country_keys(spark, d):
    """Codes of every text that the dictionary knows, as a text of its own and beside another."""
    keys = spark.createDataFrame([(k,) for k in C.default_table()], "key string")
    return keys.select("key", _bar(C.normalize(F.array("key"))).alias("codes"), _bar(C.normalize(F.array(F.concat(F.col("key"), F.lit("; Rep. of Iraq and xx"))))).alias("codes_beside"))


def nationality_overlap(spark, d):
    f = _features(spark, d).select("idx", "nats")
    pairs = f.toDF("a", "x").join(f.toDF("b", "y"), F.col("b") == F.col("a") + 5)
    return pairs.select("a", "b", T.shared(F.col("x"), F.col("y")).alias("overlap"))


def metaphone_codes(spark, d):
    tokens = _features(spark, d).select(F.explode("tokens").alias("token")).distinct()
    return tokens.select("token", metaphone(F.col("token")).alias("code"))


def _keys(spark, d):
    coded = saved(B.with_codes(_features(spark, d)))
    return coded, B.blocking_keys(coded)


def blocking_keys(spark, d):
    return _keys(spark, d)[1]


def block_sizes(spark, d):
    return B.block_sizes(_keys(spark, d)[1]).where("size > 1")


SMALL = 12


def downblock_keys(spark, d):
    coded, keys = _keys(spark, d)
    return B.refined_keys(saved(keys), coded, SMALL)


def _kinds(spark, d):
    feats = saved(_features(spark, d))
    return feats, K.find(feats, 500)


def candidate_pairs(spark, d):
    return K.expanded(_kinds(spark, d)[1].pairs("list"))


def token_sort_ratio(spark, d):
    f = _features(spark, d).select("idx", "sorted_name", F.floor(F.col("idx") / 5).alias("p"))
    pairs = f.toDF("a", "x", "p").join(f.toDF("b", "y", "p"), "p").where("a < b").select("a", "b", "x", "y")
    return with_ratio(pairs, "x", "y", "score").select("a", "b", F.round("score", 6).alias("score"))


def match_edges_query(spark, d):
    pairs = _kinds(spark, d)[1].pairs("list", *COMPARED)
    edges = K.expanded(match_edges(scored_pairs(pairs), "list_a", "list_b"), "score")
    return edges.select("a", "b", F.round("score", 6).alias("score"))


def components_query(spark, d):
    feats, kinds = _kinds(spark, d)
    found = kinds.components(match_edges(scored_pairs(kinds.pairs(*COMPARED))))
    return feats.select("idx").join(found, "idx", "left").select("idx", F.coalesce("component", "idx").alias("component"))


def component_top_n(spark, d):
    got = G.largest(people(spark, d).withColumn("component", F.col("person")), 20)
    return got.select("component", "size", _bar("names").alias("names"), _bar("years").alias("years"), _bar("datasets").alias("datasets"))


def comparison_counts(spark, d):
    feats, kinds = _kinds(spark, d)
    n = feats.agg(F.count("*").alias("n")).select((F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("naive"))
    return n.crossJoin(K.count_pairs(kinds.pairs()))  # one row each


def _clustered(spark, d):
    """Profiles with the person as their cluster."""
    p = people(spark, d)
    late = (F.size(T.years(F.col("dobs"))) == 0).cast("int")
    return p.withColumns({"component": F.col("person"), "sub_no": F.lit(0), "pos": F.struct(late.alias("late"), F.col("idx").alias("idx"))})


def golden_votes(spark, d):
    got = G.winners(G.votes(_clustered(spark, d)))
    return got.select("component", "full_name", "first_name", "last_name", "gender")


def golden_sets(spark, d):
    g = G.merge(_clustered(spark, d))
    return g.select("component", *(_bar(c).alias(c) for c in ("name_aliases", "dobs", "nats", "datasets")))


def golden_flags(spark, d):
    return G.merge(_clustered(spark, d)).select("component", "n_profiles", "is_deceased", "is_deleted")


def golden_bags(spark, d):
    return G.merge(_clustered(spark, d)).select("component", _bar("bag_notes").alias("notes"), _bar("bag_addresses").alias("addresses"))


def golden_conflicts(spark, d):
    g = G.merge(_clustered(spark, d))
    return g.select("component", _bar("gender_values").alias("genders"), _bar("dob_years").alias("dob_years"), G.conflicts().alias("trace"))


def golden_resource_id(spark, d):
    return G.merge(_clustered(spark, d)).select("component", "resource_id", F.substring("resource_id", 1, 10).alias("qr_code"))


VERSION_MS = 1_700_000_000_000


def _golden(spark, d):
    options = ResolverOptions()
    return G.with_json(G.merge(_clustered(spark, d)), options.provider, VERSION_MS, options.excluded_data_fields)


def golden_hash(spark, d):
    """The canonical form's hash; notes differ between two runs and must not matter."""
    return _golden(spark, d).select("component", "golden_hash")


def golden_json(spark, d):
    return _golden(spark, d).select("component", "json")


def _hashes(spark, d):
    """Rows (resource_id, seq, golden_hash) with repeated ids."""
    v = _view(spark, d)
    return v.select(F.sha2((F.col("person") % 50).cast("string"), 256).alias("resource_id"), F.col("idx").alias("seq"), F.sha2((F.col("idx") % 3).cast("string"), 256).alias("golden_hash"))


def hash_collisions(spark, d):
    return D.collisions(_hashes(spark, d)).groupBy("resource_id").agg(F.count("*").alias("collisions"))


def delta_new_updated(spark, d):
    now = _hashes(spark, d)
    old = D.current_state(now.where("seq % 2 = 0")).where("resource_id < 'c'")
    return D.classify(now, old).groupBy("resource_id", "change").agg(F.count("*").alias("n"))


def manifest_full(spark, d):
    g = G.merge(_clustered(spark, d))
    facts = g.select(F.explode("datasets").alias("x")).agg(F.array_join(F.array_sort(F.collect_set("x")), "|").alias("datasets"))
    return g.agg(F.count("*").alias("records")).crossJoin(facts)  # one row each


def manifest_delta(spark, d):
    now = _hashes(spark, d)
    old = D.current_state(now.where("seq % 2 = 0")).where("resource_id < 'c'")
    got = D.classify(now, old)
    return got.agg(F.count_if(F.col("change") != "SAME").alias("records"), F.count_if(F.col("change") == "NEW").alias("new_records"), F.count_if(F.col("change") == "UPDATED").alias("updated_records"))


def jsonl_roundtrip(spark, d):
    """Profiles written as gzipped JSON lines and read again."""
    v = _view(spark, d)
    data = F.struct(F.col("full_name").alias("fullName"), F.filter(F.array("alias1", "alias2"), lambda x: x.isNotNull()).alias("nameAliases"), F.filter(F.array("dob1", "dob2"), lambda x: x.isNotNull()).alias("datesOfBirthIso"), F.col("nat").alias("nationality"), "gender")
    line = F.to_json(F.struct(data.alias("data"), F.array("dataset").alias("datasets")))
    out = f"{shared_dir(spark)}/roundtrip-{uuid.uuid4().hex}"
    v.select(line.alias("value")).write.option("compression", "gzip").text(out)
    lines = spark.read.text(out).select(F.col("value").alias("line"))
    parsed = lines.withColumn("v", F.try_parse_json("line"))
    got = parsed.select(*profile_columns(F.col("v")))
    return got.groupBy("full_name").agg(F.count("*").alias("n"), F.sum(F.size("dobs")).alias("dobs"), F.sum(F.size("name_aliases")).alias("aliases"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("nats")))), "|").alias("nats"))


def event_props(spark, d):
    """Canonical JSON of a JSON text column."""
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select("event_id", F.to_json(F.try_parse_json("props")).alias("canonical"))


# ------------------------------------------------------------------ DuckDB

#: Expected primary codes of the vocabulary.
CODES = """('mohammed','MHMT'),('muhammad','MHMT'),('john','JN'),('jon','JN'),('catherine','K0RN'),('katherine','K0RN'),
('sergei','SRJ'),('sergey','SRJ'),('josé','HS'),('jose','HS'),('youssef','ASF'),('yusuf','ASF'),('philip','FLP'),('phillip','FLP'),
('anna','AN'),('ana','AN'),('xavier','SF'),('javier','JF'),('nguyen','NKN'),('nguyễn','NKN'),('michael','MKL'),('mikhail','MKL'),
('hussein','HSN'),('husain','HSN'),('al','AL'),('hassan','HSN'),('de','T'),('la','L'),('cruz','KRS'),('smith','SM0'),('schmidt','XMT'),
('o','A'),('connor','KNR'),('bin','PN'),('saleh','SL'),('thompson','TMPSN'),('wright','RT'),('petrov','PTRF'),('ivanova','AFNF'),
('garcia','KRS'),('müller','MLR'),('kowalczyk','KLSK'),('rossi','RS'),('zhang','JNK'),('jean','JN'),('baptiste','PPTST'),
('abdullahi','APTLH'),('mckenzie','MKNS'),('filipowicz','FLPTS'),('shevchenko','XFXNK'),('jr','JR')"""

_STOP = ",".join(f"'{w}'" for w in T.NAME_STOPWORDS)
_YEAR = r"\b((?:18|19|20)\d{2})\b"


def _norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace({x},'[’‘`´]','''','g'),'[‐-—−\-]+',' ','g')),'[^\p{{L}}\p{{N}}_\s]',' ','g'),'\s+',' ','g'))"


def _squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x},'\s+',' ','g'))"


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct({x})),' ')"


def _meaning(x: str) -> str:
    return f"list_filter({x}, lambda t: length(t) >= 2 AND NOT list_contains([{_STOP}], t))"


def _tail_sql(x: str) -> str:
    two = f"list_filter(list_slice({x}, greatest(len({x}) - 1, 1), len({x})), lambda t: NOT list_contains([{_STOP}], t))"
    return f"CASE WHEN len({x}) >= 2 AND len({two}) = 2 AND len(list_filter({two}, lambda t: length(t) >= 2)) = 2 THEN array_to_string(list_sort({two}),'_') ELSE '' END"


_CODE_OF = r"""list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array(nat, '\s*(?:;|,|/|\||&|\+|\b(?i:and)\b)\s*'),
 lambda t: CASE regexp_replace(t, '\s*\(as at \w+ \d{4}\)$', '') WHEN 'Pakistan' THEN 'PK' WHEN 'United Kingdom' THEN 'GB' WHEN 'France' THEN 'FR'
 WHEN 'ru' THEN 'RU' WHEN 'Russia' THEN 'RU' WHEN 'UA' THEN 'UA' WHEN 'Germany' THEN 'DE' WHEN 'Rep. of Iraq' THEN 'IQ'
 WHEN 'Türkiye' THEN 'TR' WHEN 'Hong Kong' THEN 'HK' WHEN 'China' THEN 'CN' END), lambda c: c IS NOT NULL)))"""
_PPL = f"""p AS ({PEOPLE}),
f0 AS (SELECT *, {_norm('full_name')} AS norm, list_filter([alias1, alias2], lambda x: x IS NOT NULL) AS al,
 list_sort(list_distinct(regexp_extract_all(coalesce(dob1,'') || ' ' || coalesce(dob2,''), '{_YEAR}', 1))) AS years, {_CODE_OF} AS nats FROM p),
f1 AS (SELECT *, string_split(norm, ' ') AS tokens, list_distinct(list_filter(list_transform(al, lambda x: {_norm('x')}), lambda x: length(x) >= 10 OR contains(x,' '))) AS top FROM f0),
f AS (SELECT *, {_sorted('tokens')} AS fp, coalesce({_meaning('tokens')}[1], tokens[1], '') AS first_token,
 coalesce({_meaning('tokens')}[-1], tokens[-1], '') AS last_token, array_to_string(list_sort(tokens),' ') AS sorted_name,
 list_distinct(list_concat([norm], list_transform(al, lambda x: {_norm('x')}))) AS aliases FROM f1)"""
_KEYS = f"""codes AS (SELECT * FROM (VALUES {CODES}) AS c(token, code)),
fc AS (SELECT f.*, coalesce(x.code,'') AS cf, coalesce(z.code,'') AS cl FROM f LEFT JOIN codes x ON x.token = first_token LEFT JOIN codes z ON z.token = last_token),
tops AS (SELECT idx, years, string_split(t, ' ') AS tk FROM (SELECT idx, years, unnest(top) AS t FROM f)),
tc AS (SELECT tops.*, coalesce(x.code,'') AS cf, coalesce(z.code,'') AS cl FROM tops
 LEFT JOIN codes x ON x.token = coalesce({_meaning('tk')}[1], tk[1]) LEFT JOIN codes z ON z.token = coalesce({_meaning('tk')}[-1], tk[-1])),
keys AS (SELECT idx, 'fp:' || fp AS key FROM f WHERE fp <> ''
 UNION SELECT idx, 'ph:' || cf || ':' || y FROM (SELECT idx, cf, unnest(years) AS y FROM fc WHERE cf <> '')
 UNION SELECT idx, 'phl:' || cl || ':' || y FROM (SELECT idx, cl, unnest(years) AS y FROM fc WHERE cl <> '')
 UNION SELECT idx, 'tail2:' || t || ':' || y FROM (SELECT idx, {_tail_sql('tokens')} AS t, unnest(years) AS y FROM f) WHERE t <> ''
 UNION SELECT idx, 'tok:' || t FROM (SELECT idx, years, list_filter(list_distinct(tokens), lambda x: length(x) > 5) AS lt, unnest(list_filter(list_distinct(tokens), lambda x: length(x) > 5)) AS t FROM f) WHERE len(years) > 0 OR len(lt) >= 2
 UNION SELECT idx, 'afp:' || {_sorted('tk')} FROM tops
 UNION SELECT idx, 'aph:' || cf || ':' || y FROM (SELECT idx, cf, unnest(years) AS y FROM tc WHERE cf <> '')
 UNION SELECT idx, 'aphl:' || cl || ':' || y FROM (SELECT idx, cl, unnest(years) AS y FROM tc WHERE cl <> '')
 UNION SELECT idx, 'atail2:' || t || ':' || y FROM (SELECT idx, {_tail_sql('tk')} AS t, unnest(years) AS y FROM tops) WHERE t <> '')"""


def _refined(cap: int) -> str:
    return f"""sized AS (SELECT keys.*, count(*) OVER (PARTITION BY key) AS size FROM keys),
parts AS (SELECT sized.idx, sized.key || '|y:' || unnest(CASE WHEN len(years) > 0 THEN years ELSE ['NODOB'] END) || '|phl:' || CASE WHEN cl <> '' THEN cl ELSE 'NOPH' END AS key
 FROM sized JOIN fc USING (idx) WHERE size > {cap} AND regexp_matches(sized.key, '^(fp|afp|tok):')),
refined AS (SELECT idx, key FROM sized WHERE size > 1 AND size <= {cap}
 UNION ALL SELECT idx, key FROM (SELECT *, count(*) OVER (PARTITION BY key) AS size FROM parts) WHERE size > 1 AND size <= {cap})"""


_PAIRS = "pairs AS (SELECT DISTINCT l.idx AS a, r.idx AS b FROM refined l JOIN refined r ON l.key = r.key AND l.idx < r.idx)"


def _lcs(x: str, y: str) -> str:
    """Longest common subsequence of two non-empty texts: rows of the table, folded over characters.

    Rows and characters are lists of integers, so both kinds of list element agree.
    """
    row = f"list_transform(range(0, length({x}) + 1), lambda i: CAST(0 AS BIGINT))"
    chars = f"list_transform(string_split({y}, ''), lambda c: [CAST(unicode(c) AS BIGINT)])"
    inner = (
        f"list_reduce(list_transform(range(1, length({x}) + 1), lambda j: [CAST(j AS BIGINT)]), "
        f"lambda cur, j: list_append(cur, CASE WHEN unicode(substring({x}, j[1], 1)) = c[1] THEN prev[j[1]] + 1 ELSE greatest(prev[j[1] + 1], cur[-1]) END), [CAST(0 AS BIGINT)])"
    )
    return f"list_reduce({chars}, lambda prev, c: {inner}, {row})[-1]"


_SCORED = f"""texts AS (SELECT DISTINCT x.sorted_name AS s, y.sorted_name AS t FROM pairs JOIN f x ON x.idx = a JOIN f y ON y.idx = b),
lcs AS (SELECT s, t, CASE WHEN s = t THEN 100.0 ELSE 100.0 * (1.0 - (length(s) + length(t) - 2 * {_lcs('s', 't')}) / CAST(length(s) + length(t) AS DOUBLE)) END AS score FROM texts
 WHERE s = t OR levenshtein(s, t) <= 0.2 * (length(s) + length(t))),
scored AS (SELECT a, b, score, len(x.years) > 0 AND len(y.years) > 0 AS dated, list_has_any(x.years, y.years) AS same, list_has_any(x.nats, y.nats) AS nat,
 list_has_any(x.aliases, y.aliases) AS alias FROM pairs JOIN f x ON x.idx = a JOIN f y ON y.idx = b JOIN lcs ON s = x.sorted_name AND t = y.sorted_name),
edges AS (SELECT a, b, score FROM scored WHERE CASE WHEN dated THEN same AND score > CASE WHEN nat THEN 90 ELSE 92 END
 ELSE score >= CASE WHEN nat THEN 96 ELSE 97 END OR (alias AND score >= CASE WHEN nat THEN 92 ELSE 93 END) END)"""

_CLUSTERS = "g AS (SELECT *, CASE WHEN len(years) = 0 THEN 1 ELSE 0 END AS late FROM f)"


def _vote(field: str, expr: str, length: str) -> str:
    return f"""v_{field} AS (SELECT person, val AS {field} FROM (SELECT person, val, row_number() OVER (PARTITION BY person ORDER BY n DESC, {length} DESC, late, idx) AS r
 FROM (SELECT person, val, count(*) AS n, min(struct_pack(late := late, idx := idx)).late AS late, min(struct_pack(late := late, idx := idx)).idx AS idx
 FROM (SELECT person, late, idx, {expr} AS val FROM g) WHERE val IS NOT NULL GROUP BY person, val)) WHERE r = 1)"""


_VOTES = ",\n".join([_CLUSTERS, _vote("full_name", _squeeze("full_name"), "length(val)"), _vote("first_name", _squeeze("first_name"), "length(val)"), _vote("last_name", _squeeze("last_name"), "length(val)"), _vote("gender", "gender", "0")])
_DOBS = "list_sort(list_distinct(list_filter(flatten(list([dob1, dob2])), lambda x: x IS NOT NULL)))"
_MIN_YEAR = f"regexp_extract_all(array_to_string({_DOBS}, ' '), '{_YEAR}', 1)"
_IDS = f"""ids AS (SELECT person, sha256({_norm('v_full_name.full_name')} || ':' || coalesce(y, 'NODOB')) AS resource_id FROM
 (SELECT person, list_sort({_MIN_YEAR})[1] AS y FROM g GROUP BY person) JOIN v_full_name USING (person))"""
_NATS = "list_sort(list_distinct(flatten(list(nats))))"
_GENDERS = "list_sort(list_distinct(list_filter(list(gender), lambda x: x IS NOT NULL)))"
_DOB_YEARS = "list_sort(list_distinct(flatten(list(years))))"


def _json_list(x: str) -> str:
    return f"CASE WHEN len({x}) = 0 THEN '[]' ELSE '[\"' || array_to_string({x}, '\",\"') || '\"]' END"


_FACTS = f"""facts AS (SELECT person, bool_or(is_deceased) AS dead, bool_or(is_deleted) AS gone, {_DOBS} AS dobs, {_NATS} AS codes, {_GENDERS} AS genders, {_DOB_YEARS} AS dob_years,
 list_sort(list(note)) AS notes, list_sort(flatten(list([note, '{{"a":1}}']))) AS addresses, list_sort(list_distinct(list(trim(dataset)))) AS datasets,
 list_sort(list_distinct(list_transform(flatten(list(list_concat([full_name], al))), lambda x: {_squeeze('x')}))) AS every_name FROM g GROUP BY person)"""
_TRACE = f"""CASE WHEN len(genders) > 1 OR len(dob_years) > 1 THEN '{{"conflicts":{{' || concat_ws(',', CASE WHEN len(genders) > 1 THEN '"gender_values":' || {_json_list('genders')} END,
 CASE WHEN len(dob_years) > 1 THEN '"dob_years":' || {_json_list('dob_years')} END) || '}}}}' END"""
_NAME_LIST = "list_filter(every_name, lambda x: x <> full_name)"


def _data_sql(skip: tuple[str, ...], order: bool) -> str:
    """The data object of a golden record as a SQL text expression."""
    parts = {f: "'[]'" for f in G.DATA_FIELDS} | {
        "qrCode": "'\"' || substring(resource_id, 1, 10) || '\"'",
        "resourceUri": "'\"/individuals/' || resource_id || '\"'",
        "resourceId": "'\"' || resource_id || '\"'",
        "firstName": "'\"' || first_name || '\"'",
        "fullName": "'\"' || full_name || '\"'",
        "middleName": "'\"\"'",
        "lastName": "'\"' || last_name || '\"'",
        "gender": "CASE WHEN gender IS NULL THEN 'null' ELSE '\"' || gender || '\"' END",
        "provider": "'\"kinfold\"'",
        "provider_version": f"'{VERSION_MS}'",
        "isDeleted": "CAST(gone AS VARCHAR)",
        "isDeceased": "CAST(dead AS VARCHAR)",
        "nationality": _json_list("codes"),
        "nationalitiesIsoCodes": _json_list("codes"),
        "datesOfBirthIso": _json_list("dobs"),
        "nameAliases": f"'[' || array_to_string(list_transform({_NAME_LIST}, lambda x: '{{\"fullName\":\"' || x || '\"}}'), ',') || ']'",
        "notes": "'[' || array_to_string(notes, ',') || ']'",
        "addresses": "'[' || array_to_string(addresses, ',') || ']'",
        "sanEntries": "'{\"current\":[],\"former\":[]}'",
        "pepEntries": "'{\"current\":[],\"former\":[]}'",
    }
    names = sorted(parts) if order else G.DATA_FIELDS
    return " || ',' || ".join(f"'\"{n}\":' || {parts[n]}" for n in names if n not in skip)


def _envelope(skip: tuple[str, ...], order: bool) -> str:
    return f"""'{{"data":{{' || {_data_sql(skip, order)} || '}},"datasets":' || {_json_list('datasets')} || coalesce(',"debug_trace":' || {_TRACE}, '') || '}}'"""


_ALL = f"""WITH RECURSIVE {_PPL}, {_VOTES}, {_IDS}, {_FACTS},
whole AS (SELECT * FROM facts JOIN ids USING (person) JOIN v_full_name USING (person) JOIN v_first_name USING (person) JOIN v_last_name USING (person) LEFT JOIN v_gender USING (person))"""
_HASHES = f"""h AS (SELECT sha256(CAST(person % 50 AS VARCHAR)) AS resource_id, idx AS seq, sha256(CAST(idx % 3 AS VARCHAR)) AS golden_hash FROM ({PEOPLE}))"""
_CHANGES = f"""{_HASHES}, now AS (SELECT resource_id, arg_max(golden_hash, seq) AS now FROM h GROUP BY 1),
old AS (SELECT resource_id, arg_max(golden_hash, seq) AS old FROM h WHERE seq % 2 = 0 AND resource_id < 'c' GROUP BY 1),
changes AS (SELECT resource_id, CASE WHEN old IS NULL THEN 'NEW' WHEN old <> now THEN 'UPDATED' ELSE 'SAME' END AS change FROM now LEFT JOIN old USING (resource_id)),
rows AS (SELECT * FROM h JOIN changes USING (resource_id))"""


def _country_sql(text: str) -> str:
    """Codes of a text by the dictionary ``dm``, in order of appearance."""
    tail = r"(?i)\s*(?:-\s*NDE|-\s*Non\s*ADB\s*Member\s*Country|\(\s*as\s*at\s*(?:Dec\.?|\w+)\s*\d{4}\s*\))\s*$"

    def strip(x: str) -> str:
        return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"

    def clean(x: str) -> str:
        tidy = rf"regexp_replace(replace(replace({x}, chr(160), ' '), '’', chr(39)), '\s+', ' ', 'g')"
        short = strip(f"regexp_replace({strip(tidy)}, '{tail}', '')")
        return strip(rf"regexp_replace({short}, '\.+$', '')")

    less = clean(rf"regexp_replace(regexp_replace(t, '(?i)\bRep\.?\s*of\b', '', 'g'), '(?i)\bRepublic\s+of\b', '', 'g')")
    parts = rf"list_transform(regexp_split_to_array({text}, '(?i)\s*(?:;|,|/|\||&|\+|\band\b)\s*'), lambda t: {clean('t')})"
    codes = f"flatten(list_transform(list_filter({parts}, lambda t: t <> ''), lambda t: CASE WHEN regexp_matches(t, '^[A-Za-z]{{2}}$') THEN [t] ELSE coalesce(dm[t], dm[{less}], []) END))"
    return f"CASE WHEN regexp_matches({text}, '^[A-Za-z]{{2}}$') THEN [upper({text})] ELSE list_transform({codes}, lambda c: upper(c)) END"


def _country_keys_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ",\n".join(f"({quoted(k)}, [{', '.join(map(quoted, v))}]::VARCHAR[])" for k, v in C.default_table().items())
    once = lambda x: f"array_to_string(list_filter({x}, lambda v, i: list_position({x}, v) = i), '|')"
    return f"""WITH dict AS (SELECT * FROM (VALUES {rows}) AS t(key, codes)), known AS (SELECT map(list(key), list(codes)) AS dm FROM dict),
each AS (SELECT key, {_country_sql('key')} AS a, {_country_sql("(key || '; Rep. of Iraq and xx')")} AS b FROM dict, known)
SELECT key, {once('a')} AS codes, {once('b')} AS codes_beside FROM each"""


def oracle_sql() -> dict[str, str]:
    w = f"WITH {_PPL}"
    k = f"{w}, {_KEYS}"
    e = f"{k}, {_refined(500)}, {_PAIRS}, {_SCORED}"
    SQUEEZED = _squeeze("full_name")
    bar = lambda x: f"array_to_string({x}, '|')"
    return {
        "norm_text": f"WITH p AS ({PEOPLE}) SELECT idx, {_norm('full_name')} AS norm, {_squeeze('full_name')} AS display FROM p",
        "norm_part": f"SELECT p_partkey, {_norm('p_name')} AS norm, {_sorted('string_split(' + _norm('p_name') + ', chr(32))')} AS fp FROM part",
        "name_tokens": f"{w} SELECT idx, {bar('tokens')} AS tokens, fp, first_token, last_token FROM f",
        "extract_years": f"{w} SELECT idx, {bar('years')} AS years FROM f",
        "alias_set": f"{w} SELECT idx, {bar('list_sort(aliases)')} AS aliases, coalesce({bar('(SELECT list(x ORDER BY length(x) DESC, list_position(top, x)) FROM unnest(top) AS u(x))')}, '') AS top FROM f",
        "nationality_normalize": f"{w} SELECT idx, {bar(_CODE_OF.replace('list_sort(list_distinct(', '(('))} AS codes FROM f",
        "country_keys": _country_keys_sql(),
        "nationality_overlap": f"{w} SELECT x.idx AS a, y.idx AS b, list_has_any(x.nats, y.nats) AS overlap FROM f x JOIN f y ON y.idx = x.idx + 5",
        "metaphone_codes": f"{k} SELECT token, code FROM codes WHERE token IN (SELECT unnest(tokens) FROM f)",
        "blocking_keys": f"{k} SELECT idx, key FROM keys",
        "block_sizes": f"{k} SELECT key, count(*) AS size FROM keys GROUP BY key HAVING count(*) > 1",
        "downblock_keys": f"{k}, {_refined(SMALL)} SELECT idx, key FROM refined",
        "candidate_pairs": f"{k}, {_refined(500)}, {_PAIRS} SELECT a, b FROM pairs",
        "comparison_counts": f"{k}, {_refined(500)}, {_PAIRS} SELECT (SELECT CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) FROM f) AS naive, (SELECT count(*) FROM pairs) AS actual",
        "token_sort_ratio": f"{w}, q AS (SELECT x.idx AS a, y.idx AS b, x.sorted_name AS s, y.sorted_name AS t FROM f x JOIN f y ON CAST(FLOOR(x.idx / 5) AS BIGINT) = CAST(FLOOR(y.idx / 5) AS BIGINT) AND x.idx < y.idx) SELECT a, b, round(CASE WHEN s = t THEN 100.0 ELSE 100.0 * (1.0 - (length(s) + length(t) - 2 * {_lcs('s', 't')}) / CAST(length(s) + length(t) AS DOUBLE)) END, 6) AS score FROM q",
        "match_edges": f"{e} SELECT a, b, round(score, 6) AS score FROM edges",
        "connected_components": f"WITH RECURSIVE {e[5:]}, both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT idx AS a, idx AS b FROM f UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a) SELECT a AS idx, min(b) AS component FROM reach GROUP BY a",
        "component_top_n": f"{w}, {_CLUSTERS} SELECT person AS component, count(*) AS size, {bar(f'list_sort(list_distinct(list({SQUEEZED})))')} AS names, {bar(_DOB_YEARS)} AS years, {bar('list_sort(list_distinct(list(dataset)))')} AS datasets FROM g GROUP BY person ORDER BY size DESC, component LIMIT 20",
        "golden_votes": f"{_ALL} SELECT person AS component, full_name, first_name, last_name, gender FROM whole",
        "golden_sets": f"{_ALL} SELECT person AS component, {bar(_NAME_LIST)} AS name_aliases, {bar('dobs')} AS dobs, {bar('codes')} AS nats, {bar('datasets')} AS datasets FROM whole",
        "golden_flags": f"{w} SELECT person AS component, count(*) AS n_profiles, bool_or(is_deceased) AS is_deceased, bool_or(is_deleted) AS is_deleted FROM f GROUP BY person",
        "golden_bags": f"{_ALL} SELECT person AS component, {bar('notes')} AS notes, {bar('addresses')} AS addresses FROM whole",
        "golden_conflicts": f"{_ALL} SELECT person AS component, {bar('genders')} AS genders, {bar('dob_years')} AS dob_years, {_TRACE} AS trace FROM whole",
        "golden_resource_id": f"{_ALL} SELECT person AS component, resource_id, substring(resource_id, 1, 10) AS qr_code FROM whole",
        "golden_hash": f"{_ALL} SELECT person AS component, sha256({_envelope(ResolverOptions.excluded_data_fields, True)}) AS golden_hash FROM whole",
        "golden_json": f"{_ALL} SELECT person AS component, {_envelope((), False)} AS json FROM whole",
        "hash_collisions": f"WITH {_HASHES} SELECT resource_id, count(*) AS collisions FROM (SELECT resource_id, golden_hash, lag(golden_hash) OVER (PARTITION BY resource_id ORDER BY seq) AS before FROM h) WHERE before <> golden_hash GROUP BY 1",
        "delta_new_updated": f"WITH {_CHANGES} SELECT resource_id, change, count(*) AS n FROM rows GROUP BY 1, 2",
        "manifest_full": f"{_ALL} SELECT count(*) AS records, (SELECT array_to_string(list_sort(list_distinct(flatten(list(datasets)))), '|') FROM whole) AS datasets FROM whole",
        "manifest_delta": f"WITH {_CHANGES} SELECT count(*) FILTER (change <> 'SAME') AS records, count(*) FILTER (change = 'NEW') AS new_records, count(*) FILTER (change = 'UPDATED') AS updated_records FROM rows",
        "jsonl_roundtrip": f"{w} SELECT full_name, count(*) AS n, CAST(sum(CASE WHEN dob1 IS NULL THEN 0 ELSE 1 END + CASE WHEN dob2 IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS dobs, CAST(sum(len(al)) AS BIGINT) AS aliases, {bar(_NATS)} AS nats FROM f GROUP BY full_name",
    }


QUERIES = {
    "norm_text": norm_text,
    "norm_part": norm_part,
    "name_tokens": name_tokens,
    "extract_years": extract_years,
    "alias_set": alias_set,
    "nationality_normalize": nationality_normalize,
    "country_keys": country_keys,
    "nationality_overlap": nationality_overlap,
    "metaphone_codes": metaphone_codes,
    "blocking_keys": blocking_keys,
    "block_sizes": block_sizes,
    "downblock_keys": downblock_keys,
    "candidate_pairs": candidate_pairs,
    "comparison_counts": comparison_counts,
    "token_sort_ratio": token_sort_ratio,
    "match_edges": match_edges_query,
    "connected_components": components_query,
    "component_top_n": component_top_n,
    "golden_votes": golden_votes,
    "golden_sets": golden_sets,
    "golden_flags": golden_flags,
    "golden_bags": golden_bags,
    "golden_conflicts": golden_conflicts,
    "golden_resource_id": golden_resource_id,
    "golden_hash": golden_hash,
    "golden_json": golden_json,
    "hash_collisions": hash_collisions,
    "delta_new_updated": delta_new_updated,
    "manifest_full": manifest_full,
    "manifest_delta": manifest_delta,
    "jsonl_roundtrip": jsonl_roundtrip,
    "event_props": event_props,
}
