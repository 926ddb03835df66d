"""Blocking keys and candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions import text as T
from kinfold.functions.phonetic import metaphone
from kinfold.operators.components import saved

REFINED = ("fp:", "afp:", "tok:")


def features(profiles: DataFrame) -> DataFrame:
    """What blocking, matching and splitting need, once for each profile.

    In: idx, full_name, name_aliases, dobs, nats.  A missing name gives empty text.
    """
    norm = T.norm_text(F.col("full_name"))
    out = profiles.select(
        "idx",
        F.col("full_name"),
        norm.alias("norm"),
        T.years(F.col("dobs")).alias("years"),
        F.coalesce("nats", F.array().cast("array<string>")).alias("nats"),
        T.alias_set(F.col("full_name"), F.col("name_aliases")).alias("aliases"),
        T.top_aliases(F.col("name_aliases")).alias("top"),
    )
    return with_tokens(out)


def with_tokens(out: DataFrame) -> DataFrame:
    """The features that follow from the normalised name."""
    tokens = T.name_tokens(F.col("norm"))
    return out.select(
        "*",
        tokens.alias("tokens"),
        T.fingerprint(tokens).alias("fp"),
        T.first_token(tokens).alias("first"),
        T.last_token(tokens).alias("last"),
        T.sorted_tokens(F.col("norm")).alias("sorted_name"),
    )


def _with_year(prefix: str, code: Column, years: Column) -> Column:
    """prefix:code:year for each year; none for an empty code."""
    found = F.transform(years, lambda y: F.concat(F.lit(prefix), code, F.lit(":"), y))
    return F.when(code != "", found).otherwise(F.array().cast("array<string>"))


def _tail(tokens: Column) -> Column:
    """The last two tokens, sorted and joined by '_'; '' unless both are words of two characters or more."""
    stop = F.array(*map(F.lit, T.NAME_STOPWORDS))
    two = F.filter(F.slice(tokens, F.greatest(F.size(tokens) - 1, F.lit(1)), 2), lambda t: ~F.array_contains(stop, t))
    good = (F.size(tokens) >= 2) & (F.size(two) == 2) & F.forall(two, lambda t: F.length(t) >= 2)
    return F.when(good, F.array_join(F.array_sort(two), "_")).otherwise(F.lit(""))


def with_codes(feats: DataFrame) -> DataFrame:
    """Phonetic codes of the first and last token of the name and of the chosen aliases.

    One batched Python pass over the profiles; each distinct token of a batch is coded once.
    """
    token_pairs = F.transform("top", lambda a: F.struct(T.first_token(T.name_tokens(a)).alias("f"), T.last_token(T.name_tokens(a)).alias("l"), _tail(T.name_tokens(a)).alias("t"), T.fingerprint(T.name_tokens(a)).alias("fp")))
    n = 6
    flat = feats.withColumn("parts", token_pairs)
    for i in range(n):
        part = F.get("parts", F.lit(i))
        flat = flat.withColumns({f"__f{i}": F.coalesce(part["f"], F.lit("")), f"__l{i}": F.coalesce(part["l"], F.lit(""))})
    coded = flat.withColumns({"code_first": metaphone(F.col("first")), "code_last": metaphone(F.col("last"))} | {f"__{k}{i}c": metaphone(F.col(f"__{k}{i}")) for i in range(n) for k in "fl"})
    alias_first = F.array(*(F.col(f"__f{i}c") for i in range(n)))
    alias_last = F.array(*(F.col(f"__l{i}c") for i in range(n)))
    kept = [*feats.columns, "code_first", "code_last"]
    return coded.select(*kept, "parts", F.slice(alias_first, 1, n).alias("alias_first"), F.slice(alias_last, 1, n).alias("alias_last"))


def named(feats: DataFrame) -> DataFrame:
    """Profiles with a name."""
    return feats.where(F.coalesce(T.squeeze(F.col("full_name")) != "", F.lit(False)))


def blocking_keys(coded: DataFrame) -> DataFrame:
    """(idx, key) of profiles with a name; distinct within a profile."""
    return keys_of(named(coded))


def _weight(rows: DataFrame) -> list[str]:
    """The column of a row's number of profiles, where rows stand for several."""
    return [c for c in ("n",) if c in rows.columns]


def keys_of(coded: DataFrame) -> DataFrame:
    """(idx, key) of rows with features and codes, with n if they stand for n profiles."""
    years = F.col("years")
    dated = F.size(years) > 0
    none = F.array().cast("array<string>")
    long_tokens = F.filter(F.array_sort(F.array_distinct("tokens")), lambda t: F.length(t) > 5)
    tok = F.when(dated | (F.size(long_tokens) >= 2), F.transform(long_tokens, lambda t: F.concat(F.lit("tok:"), t))).otherwise(none)
    tail = _tail(F.col("tokens"))
    each = F.flatten(
        F.transform(
            "parts",
            lambda p, i: F.concat(
                F.when(p["fp"] != "", F.array(F.concat(F.lit("afp:"), p["fp"]))).otherwise(none),
                _with_year("aph:", F.get("alias_first", i), years),
                _with_year("aphl:", F.get("alias_last", i), years),
                _with_year("atail2:", p["t"], years),
            ),
        )
    )
    keys = F.concat(
        F.when(F.col("fp") != "", F.array(F.concat(F.lit("fp:"), F.col("fp")))).otherwise(none),
        _with_year("ph:", F.col("code_first"), years),
        _with_year("phl:", F.col("code_last"), years),
        _with_year("tail2:", tail, years),
        tok,
        each,
    )
    return coded.select("idx", F.explode(F.array_distinct(keys)).alias("key"), *_weight(coded))


def block_sizes(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg((F.sum("n") if _weight(keys) else F.count("*")).alias("size"))


def refined_keys(keys: DataFrame, coded: DataFrame, max_block: int) -> DataFrame:
    """(idx, key) after the size rules: blocks of one are dropped, blocks over the cap are refined or dropped.

    A block over the cap is refined by year and last-token code if its prefix is in
    ``REFINED``; refined blocks obey the same two limits.
    """
    sizes = block_sizes(keys).where("size > 1")
    # a table: of joins by key on both sides, Spark zips the union below by partitions, whose numbers adaptive execution changes
    sized = saved(keys.join(sizes, "key"))
    kept = sized.where(F.col("size") <= max_block).select("idx", "key")
    large = sized.where((F.col("size") > max_block) & F.col("key").rlike("^(fp|afp|tok):"))
    more = coded.select("idx", F.when(F.size("years") > 0, F.col("years")).otherwise(F.array(F.lit("NODOB"))).alias("years"), F.when(F.col("code_last") != "", F.col("code_last")).otherwise("NOPH").alias("code"))
    parts = large.join(more, "idx").select("idx", "key", "code", F.explode("years").alias("y"), *_weight(keys))
    parts = parts.select("idx", F.concat("key", F.lit("|y:"), "y", F.lit("|phl:"), "code").alias("key"), *_weight(keys))
    parts = saved(parts)
    good = block_sizes(parts).where((F.col("size") > 1) & (F.col("size") <= max_block)).select("key")
    return kept.unionByName(parts.join(good, "key").select("idx", "key"))


def downblocked(keys: DataFrame, max_block: int) -> int:
    """Number of blocks that were refined."""
    return block_sizes(keys).where((F.col("size") > max_block) & F.col("key").rlike("^(fp|afp|tok):")).count()


def block_rows(refined: DataFrame) -> DataFrame:
    """(idx, block, earlier) of numbered blocks; ``earlier`` lists the row's blocks with lower numbers."""
    refined = saved(refined.select("idx", "key"))
    blocks = saved(refined.select("key").distinct().select("key", F.monotonically_increasing_id().alias("block")))
    own = refined.join(blocks, "key").groupBy("idx").agg(F.array_sort(F.collect_set("block")).alias("blocks"))
    each = own.select("idx", "blocks", F.posexplode("blocks").alias("at", "block"))
    return saved(each.select("idx", "block", F.slice("blocks", F.lit(1), F.col("at")).alias("earlier")))


def paired(rows: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """(a, b), a <= b, of rows that share a block, with columns of ``carried`` (idx, ...) as c_a and c_b.

    A pair is made in the first block that both are in, so none is made twice and
    none is moved to find that out.
    """
    more = [] if carried is None else [c for c in carried.columns if c != "idx"]
    if carried is not None:
        rows = rows.join(carried, "idx")
    side = lambda s: rows.select("block", F.col("idx").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ["earlier", *more]))
    both = side("a").join(side("b"), "block").where("a <= b").where(~F.arrays_overlap("earlier_a", "earlier_b"))
    return both.select("a", "b", *(f"{c}_{s}" for c in more for s in "ab"))


def candidate_pairs(refined: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of profiles that share a block; bounded by the block cap."""
    return paired(block_rows(refined)).where("a < b")
