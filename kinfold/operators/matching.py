"""The match rule over candidate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import with_ratio
from kinfold.functions.text import shared

#: Least scores without and with a shared nationality.
BOTH_DATED = (92, 90)  # to be exceeded
UNDATED = (97, 96)
UNDATED_ALIAS = (93, 92)


#: The features that pairs bring along to be scored.
COMPARED = ["sorted_name", "years", "nats", "aliases"]


def scored_pairs(pairs: DataFrame, floor: float = 90.0) -> DataFrame:
    """Pairs (with the columns ``COMPARED`` of both) that the dates allow, with their score and evidence; scores below ``floor`` are dropped."""
    dated = (F.size("years_a") > 0) & (F.size("years_b") > 0)
    both = pairs.where(~dated | shared(F.col("years_a"), F.col("years_b")))
    kept = [c for c in pairs.columns if c[:-2] not in COMPARED]
    facts = both.select(
        *kept,
        F.col("sorted_name_a").alias("name_a"),
        F.col("sorted_name_b").alias("name_b"),
        dated.alias("dated"),
        shared(F.col("nats_a"), F.col("nats_b")).alias("nat"),
        shared(F.col("aliases_a"), F.col("aliases_b")).alias("alias"),
    )
    return with_ratio(facts, "name_a", "name_b", "score", floor)


def match_edges(scored: DataFrame, *kept: str) -> DataFrame:
    """(a, b, score) of the pairs that match, with ``kept`` columns."""

    def least(limits):
        return F.when(F.col("nat"), limits[1]).otherwise(limits[0])

    undated = (F.col("score") >= least(UNDATED)) | (F.col("alias") & (F.col("score") >= least(UNDATED_ALIAS)))
    rule = F.when(F.col("dated"), F.col("score") > least(BOTH_DATED)).otherwise(undated)
    return scored.where(rule).select("a", "b", "score", *kept)
