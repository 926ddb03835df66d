"""Splitting of components by birth year: an order-dependent greedy fold.

Profiles with years join the first bucket that shares a year with them, in order
of idx; profiles without join the bucket whose representative name is most
alike; the rest form one group.  Only components that the fold can change go to
Python: those with a dated profile and either undated ones or several year sets.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import token_sort_ratio

ALONE, WITH_ALIAS = 98, 95


def representative(names: list[str | None]) -> str:
    """The name with most votes, then the longest, then the first seen."""
    votes: dict[str, int] = {}
    for n in names:
        clean = " ".join((n or "").split())
        if clean:
            votes[clean] = votes.get(clean, 0) + 1
    return max(votes, key=lambda n: (votes[n], len(n))) if votes else ""


def fold(rows: list[tuple]) -> list[int]:
    """Group numbers of (full_name, years, aliases), in order of idx."""
    groups: list[dict] = []
    number = [-1] * len(rows)
    if not any(len(r[1]) for r in rows):
        return [0] * len(rows)

    def put(i, g):
        g["names"].append(rows[i][0])
        g["rep"] = None
        g["aliases"].update(rows[i][2])
        number[i] = g["no"]

    for i, (_, years, _) in enumerate(rows):
        if not len(years):
            continue
        home = next((g for g in groups if not g["years"].isdisjoint(years)), None)
        if home is None:
            home = {"no": len(groups), "years": set(), "names": [], "aliases": set(), "rep": None}
            groups.append(home)
        home["years"].update(years)
        put(i, home)
    for i, (name, years, aliases) in enumerate(rows):
        if len(years) or not (name or "").strip():
            continue
        best, home = -1.0, None
        for g in groups:
            if g["rep"] is None:  # it changed since it was last asked for
                g["rep"] = representative(g["names"])
            if not g["rep"]:
                continue
            score = token_sort_ratio(name.lower(), g["rep"].lower())
            good = score >= ALONE or (score >= WITH_ALIAS and not g["aliases"].isdisjoint(aliases))
            if good and score > best:
                best, home = score, g
        if home is not None:
            put(i, home)
    return [len(groups) if n < 0 else n for n in number]


def _fold_frame(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("idx")
    rows = list(zip(pdf["full_name"], pdf["years"], pdf["aliases"]))
    return pd.DataFrame({"idx": pdf["idx"].to_numpy(), "component": pdf["component"].to_numpy(), "sub_no": fold(rows)})


def split_components(members: DataFrame) -> DataFrame:
    """(idx, component, sub_no, pos) of members (idx, component, full_name, years, aliases).

    ``pos`` is the order within the cluster: dated members by idx, then attached ones.
    """
    shape = members.groupBy("component").agg(F.max(F.size("years") > 0).alias("dated"), F.min(F.size("years") > 0).alias("all_dated"), F.min("years").alias("lo"), F.max("years").alias("hi"))
    needs = F.col("dated") & (~F.col("all_dated") | (F.col("lo") != F.col("hi")))
    changed = members.select("idx", "component", "full_name", "years", "aliases").join(shape.where(needs).select("component"), "component")
    folded = changed.groupBy("component").applyInPandas(_fold_frame, "idx long, component long, sub_no int")
    # a join and no union: Spark zips the partitions of a union's alike branches, whose numbers adaptive execution can change
    every = members.select("idx", "component", (F.size("years") == 0).cast("int").alias("late")).join(folded.select("idx", "sub_no"), "idx", "left")
    return every.select("idx", "component", F.coalesce("sub_no", F.lit(0)).alias("sub_no"), F.struct("late", "idx").alias("pos"))
