"""Reading profiles from JSON lines, plain or gzipped."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions.country import normalize
from kinfold.operators.components import saved
from kinfold.schema import BAGS, DATED_BAGS, complete

_EMPTY = ("null", "false", "0", "0.0", '""', "[]", "{}")


@dataclass
class Loaded:
    good: DataFrame
    rejected: DataFrame

    @cached_property
    def profiles(self) -> DataFrame:
        """Read, parsed and numbered once they are asked for."""
        return complete(numbered(self.good))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _string(v: Column) -> Column:
    """A JSON string's value; null for anything else."""
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _scalar(v: Column) -> Column:
    """A scalar as text; null for null, empty values, lists and objects."""
    kind = _kind(v)
    plain = ~(kind.startswith("ARRAY") | kind.startswith("OBJECT") | (kind == "VOID"))
    return F.when(plain, F.try_variant_get(v, "$", "string"))


def _truthy(v: Column) -> Column:
    return F.coalesce(~F.to_json(v).isin(*_EMPTY), F.lit(False))


def _list(v: Column) -> Column:
    """Elements of a JSON array; null for anything else."""
    return F.when(_kind(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def _strings(v: Column) -> Column:
    return F.filter(F.transform(_list(v), _string), lambda s: s.isNotNull())


def _texts(v: Column) -> Column:
    """A scalar or the scalars of a list, as text."""
    one = _scalar(v)
    many = F.filter(F.transform(_list(v), _scalar), lambda s: s.isNotNull())
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def _bag(v: Column) -> Column:
    """Canonical JSON of a list's elements; of another non-empty value, as one element."""
    many = F.transform(_list(v), lambda x: F.to_json(x))
    return F.coalesce(many, F.when(_truthy(v), F.array(F.to_json(v))), F.array().cast("array<string>"))


def _aliases(v: Column) -> Column:
    one = F.transform(_list(v), lambda x: F.when(_kind(x).startswith("OBJECT"), _string(_get(x, "$.fullName"))).otherwise(_string(x)))
    return F.filter(one, lambda s: s.isNotNull())


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, block, line): all lines of *.jsonl and *.jsonl.gz below ``folder``; corrupt files give what was read."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{jsonl,jsonl.gz}").option("ignoreCorruptFiles", "true").option("lineSep", "\n").text(folder)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (path, block, ...) as read, with ``idx``: their rank by path parts, block and line.

    A block is read by one task, in order, so counts of blocks place its rows; they
    are read once and neither sorted nor moved.
    """
    placed = saved(rows.withColumn("__at", F.monotonically_increasing_id()))
    blocks = placed.groupBy("path", "block").agg(F.min("__at").alias("__first"), F.count("*").alias("n"))
    order = Window.orderBy(F.split("path", "/"), "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("path", "block", "__first", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("__before"))
    got = placed.join(F.broadcast(before), ["path", "block"])  # a row per block of a file
    return got.withColumn("idx", F.col("__before") + F.col("__at") - F.col("__first")).drop("path", "block", "__at", "__first", "__before")


def profile_columns(v: Column, table: dict[str, list[str]] | None = None) -> list[Column]:
    """The profile columns of a parsed line."""
    data = lambda name: _get(v, f"$.data.{name}")
    nats = F.concat(_texts(data("nationalitiesIsoCodes")), _texts(data("nationality")))
    cols = [
        _string(data("fullName")).alias("full_name"),
        *(_scalar(data(j)).alias(c) for j, c in (("firstName", "first_name"), ("middleName", "middle_name"), ("lastName", "last_name"))),
        _scalar(data("gender")).alias("gender"),
        _truthy(data("isDeceased")).alias("is_deceased"),
        _truthy(data("isDeleted")).alias("is_deleted"),
        _aliases(data("nameAliases")).alias("name_aliases"),
        _strings(data("datesOfBirthIso")).alias("dobs"),
        _strings(data("datesOfDeathIso")).alias("dods"),
        normalize(nats, table).alias("nats"),
        _strings(data("profileImages")).alias("images"),
        _strings(_get(v, "$.datasets")).alias("datasets"),
        *(_bag(data(b)).alias(f"bag_{b}") for b in BAGS),
    ]
    for b in DATED_BAGS:
        cols += [_bag(data(f"{b}.{part}")).alias(f"bag_{b}_{part}") for part in ("current", "former")]
    return cols


def load_profiles(spark: SparkSession, folder: str, table: dict[str, list[str]] | None = None) -> Loaded:
    """Profiles in the order of (path parts, line), numbered from 0, and the lines that were rejected.

    Blank lines are skipped.  Lines that are no JSON object, or whose data is no
    object, are rejected with a reason.
    """
    lines = read_lines(spark, folder).where(~F.col("line").rlike(r"(?U)^[\s\x1c-\x1f]*$"))
    parsed = lines.withColumn("v", F.try_parse_json("line"))
    data = _get(F.col("v"), "$.data")
    reason = (
        F.when(F.col("v").isNull(), "not JSON")
        .when(~_kind(F.col("v")).startswith("OBJECT"), "not an object")
        .when(data.isNotNull() & ~_kind(data).startswith("OBJECT"), "data is not an object")
    )
    judged = parsed.withColumn("reason", reason)
    rejected = judged.where("reason is not null").select("path", "line", "reason")
    good = judged.where("reason is null").select("path", "block", *profile_columns(F.col("v"), table))
    return Loaded(good, rejected)
