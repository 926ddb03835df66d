"""Changes of golden records against the previous state of hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collisions(golden: DataFrame) -> DataFrame:
    """(resource_id, seq) of rows whose hash differs from the one their id had just before."""
    before = F.lag("golden_hash").over(Window.partitionBy("resource_id").orderBy("seq"))
    return golden.select("resource_id", "seq", "golden_hash", before.alias("before")).where("before <> golden_hash").select("resource_id", "seq")


def current_state(golden: DataFrame) -> DataFrame:
    """(resource_id, golden_hash): of several rows of an id the last one's hash holds."""
    return golden.groupBy("resource_id").agg(F.max_by("golden_hash", "seq").alias("golden_hash"))


def classify(golden: DataFrame, previous: DataFrame) -> DataFrame:
    """Golden rows with ``change``: NEW, UPDATED, or SAME, by their id's current hash.

    All rows of a changed id get its change; ids that vanished have no row.
    """
    state = current_state(golden).withColumnRenamed("golden_hash", "now")
    old = previous.select("resource_id", F.col("golden_hash").alias("old"))
    change = F.when(F.col("old").isNull(), "NEW").when(F.col("old") != F.col("now"), "UPDATED").otherwise("SAME")
    changes = state.join(old, "resource_id", "left").select("resource_id", change.alias("change"))
    return golden.join(changes, "resource_id")
