"""Golden records: one row per cluster, all in built-in aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions import text as T
from kinfold.schema import BAGS, DATA_FIELDS, DATED_BAGS, bag_columns

CLUSTER = ["component", "sub_no"]
NAMES = ["full_name", "first_name", "middle_name", "last_name"]
_LIST = "array<string>"


def votes(profiles: DataFrame) -> DataFrame:
    """(cluster, field, value, votes, first) of names and gender; ``first`` is the earliest position."""
    fields = [F.struct(F.lit(n).alias("field"), T.squeeze(F.col(n)).alias("value")) for n in NAMES]
    fields.append(F.struct(F.lit("gender").alias("field"), F.col("gender").alias("value")))
    each = profiles.select(*CLUSTER, "pos", F.explode(F.array(*fields)).alias("v")).select(*CLUSTER, "pos", "v.field", "v.value")
    each = each.where("value is not null and (field = 'gender' or value <> '')")
    return each.groupBy(*CLUSTER, "field", "value").agg(F.count("*").alias("votes"), F.min("pos").alias("first"))


def winners(counted: DataFrame) -> DataFrame:
    """The value of each field with most votes, then (names) the longest, then the first seen."""
    length = F.when(F.col("field") == "gender", 0).otherwise(F.length("value"))
    rank = F.struct("votes", length.alias("length"), (-F.col("first.late")).alias("late"), (-F.col("first.idx")).alias("idx"), "value")
    best = [F.max(F.when(F.col("field") == f, rank))["value"].alias(f) for f in [*NAMES, "gender"]]
    kinds = F.array_sort(F.collect_set(F.when(F.col("field") == "gender", F.col("value"))))
    return counted.groupBy(*CLUSTER).agg(*best, kinds.alias("gender_values"))


def _union(c: str) -> Column:
    """Sorted distinct non-empty elements of the cluster's lists."""
    return F.array_sort(F.filter(F.array_distinct(F.flatten(F.collect_set(c))), lambda x: x.isNotNull() & (x != "")))


def _bag(c: str) -> Column:
    """All elements of the cluster's lists, repeated ones too, in canonical order."""
    return F.array_sort(F.flatten(F.collect_list(c)))


def merge(profiles: DataFrame) -> DataFrame:
    """One golden row per cluster of profiles (all profile columns, component, sub_no, pos).

    Both aggregations are keyed by the cluster, so their join needs no further exchange.
    """
    aliases = F.transform(F.concat(F.array(F.col("full_name")), F.col("name_aliases")), T.squeeze)
    sets = profiles.withColumn("__names", aliases).withColumn("__years", T.years(F.col("dobs")))
    facts = sets.groupBy(*CLUSTER).agg(
        F.count("*").alias("n_profiles"),
        _union("__names").alias("names"),
        F.bool_or("is_deceased").alias("is_deceased"),
        F.bool_or("is_deleted").alias("is_deleted"),
        _union("dobs").alias("dobs"),
        _union("dods").alias("dods"),
        _union("images").alias("images"),
        _union("nats").alias("nats"),
        _union("datasets").alias("datasets"),
        _union("__years").alias("dob_years"),
        *(_bag(b).alias(b) for b in bag_columns()),
    )
    golden = facts.join(winners(votes(profiles)), CLUSTER, "left")
    golden = golden.withColumns({n: F.coalesce(n, F.lit("")) for n in NAMES} | {"gender_values": F.coalesce("gender_values", F.array().cast(_LIST))})
    golden = golden.withColumn("datasets", F.array_sort(F.array_distinct(F.filter(F.transform("datasets", lambda x: F.trim(x)), lambda x: x != ""))))
    golden = golden.withColumn("name_aliases", F.filter("names", lambda x: x != F.col("full_name"))).drop("names")
    years = T.years(F.col("dobs"))
    seed = F.trim(F.concat(T.norm_text(F.col("full_name")), F.lit(":"), F.coalesce(F.try_element_at(years, F.lit(1)), F.lit("NODOB"))))
    return golden.withColumn("resource_id", F.sha2(seed, 256))


def _quoted(c: Column) -> Column:
    """A string as JSON; null as null."""
    packed = F.to_json(F.array(c))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.regexp_replace(packed, r"(?s)^\[(.*)\]$", "$1"))


def _raw_list(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(c, ","), F.lit("]"))


def data_json(provider: str, version_ms: int) -> dict[str, Column]:
    """JSON text of each field of the golden record's data."""
    names = F.to_json(F.transform("name_aliases", lambda n: F.struct(n.alias("fullName"))))
    out = {
        "qrCode": _quoted(F.substring("resource_id", 1, 10)),
        "resourceUri": _quoted(F.concat(F.lit("/individuals/"), "resource_id")),
        "resourceId": _quoted(F.col("resource_id")),
        "firstName": _quoted(F.col("first_name")),
        "fullName": _quoted(F.col("full_name")),
        "middleName": _quoted(F.col("middle_name")),
        "lastName": _quoted(F.col("last_name")),
        "gender": _quoted(F.col("gender")),
        "provider": _quoted(F.lit(provider)),
        "provider_version": F.lit(str(version_ms)),
        "isDeleted": F.col("is_deleted").cast("string"),
        "isDeceased": F.col("is_deceased").cast("string"),
        "nationality": F.to_json("nats"),
        "nameAliases": names,
        "datesOfBirthIso": F.to_json("dobs"),
        "datesOfDeathIso": F.to_json("dods"),
        "nationalitiesIsoCodes": F.to_json("nats"),
        "profileImages": F.to_json("images"),
    }
    out |= {b: _raw_list(F.col(f"bag_{b}")) for b in BAGS}
    for b in DATED_BAGS:
        out[b] = F.concat(F.lit('{"current":'), _raw_list(F.col(f"bag_{b}_current")), F.lit(',"former":'), _raw_list(F.col(f"bag_{b}_former")), F.lit("}"))
    return {f: out[f] for f in DATA_FIELDS}


def _object(parts: list[tuple[str, Column]]) -> Column:
    items = [F.concat(F.lit(f'"{k}":'), v) for k, v in parts]
    return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))


def conflicts() -> Column:
    """JSON of what the profiles disagree on, or null."""
    genders = F.when(F.size("gender_values") > 1, F.concat(F.lit('"gender_values":'), F.to_json("gender_values")))
    dobs = F.when(F.size("dob_years") > 1, F.concat(F.lit('"dob_years":'), F.to_json("dob_years")))
    return F.when(F.coalesce(genders, dobs).isNotNull(), F.concat(F.lit('{"conflicts":{'), F.concat_ws(",", genders, dobs), F.lit("}}")))


def with_json(golden: DataFrame, provider: str, version_ms: int, excluded_data: tuple[str, ...] = (), excluded_top: tuple[str, ...] = ()) -> DataFrame:
    """``golden`` with ``json`` (the exported line) and ``golden_hash`` (sha256 of the canonical form).

    The canonical form has sorted keys and leaves the excluded fields out; the
    trace of conflicts is left out of both where there is none.
    """
    data = data_json(provider, version_ms)
    trace = conflicts()

    def envelope(inner: Column, top: list[str]) -> Column:
        parts = {"data": F.concat(F.lit('"data":'), inner), "datasets": F.concat(F.lit('"datasets":'), F.to_json("datasets")), "debug_trace": F.concat(F.lit('"debug_trace":'), trace)}
        return F.concat(F.lit("{"), F.concat_ws(",", *(parts[p] for p in top)), F.lit("}"))

    whole = envelope(_object(list(data.items())), ["data", "datasets", "debug_trace"])
    kept = [(k, v) for k, v in sorted(data.items()) if k not in excluded_data]
    canonical = envelope(_object(kept), [p for p in ("data", "datasets", "debug_trace") if p not in excluded_top])
    return golden.withColumn("json", whole).withColumn("golden_hash", F.sha2(canonical, 256))


def largest(profiles: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` largest components with their names, years and datasets."""
    got = profiles.withColumn("y", T.years(F.col("dobs"))).groupBy("component").agg(
        F.count("*").alias("size"), F.array_sort(F.collect_set(T.squeeze(F.col("full_name")))).alias("names"), _union("y").alias("years"), _union("datasets").alias("datasets")
    )
    return got.orderBy(F.desc("size"), "component").limit(n)
