"""Token sort ratio: 100 * (1 - indel distance / (len a + len b)) of sorted tokens."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of a longest common subsequence, by bit-parallel rows over one integer."""
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - bin(row).count("1")


def token_sort_ratio(a: str, b: str) -> float:
    """The ratio of two texts, each split at white space, sorted and joined."""
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    n = len(a) + len(b)
    return 100.0 if not n else 100.0 * (1.0 - (n - 2 * lcs_length(a, b)) / n)


@F.pandas_udf(T.DoubleType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    def ratio(x, y):
        if x is None:  # equal texts
            return 100.0
        n = len(x) + len(y)
        return 100.0 if not n else 100.0 * (1.0 - (n - 2 * lcs_length(x, y)) / n)

    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def with_ratio(pairs: DataFrame, a: str, b: str, out: str, floor: float = 0.0) -> DataFrame:
    """``pairs`` with the ratio of two columns of sorted texts; rows below ``floor`` are dropped.

    With lev the edit and d the indel distance, lev <= d <= 2 lev, as a substitution
    is a deletion and an insertion.  So equal texts, and pairs whose edit distance
    rules the floor out, are settled in the JVM; only the rest goes to vectorised
    Python for the exact subsequence.
    """
    x, y = F.col(a), F.col(b)
    n = (F.length(x) + F.length(y)).cast("double")
    most = F.floor((100.0 - floor) / 100.0 * n + 1e-9).cast("int")
    near = (F.abs(F.length(x) - F.length(y)) <= most) & (F.levenshtein(x, y) <= most)
    left = pairs.where((x == y) | near) if floor > 0 else pairs.where(x.isNotNull() & y.isNotNull())
    # one pass and no union; equal texts go as nulls, which cost next to nothing
    exact = _ratio_udf(F.when(x != y, x), F.when(x != y, y))
    return left.withColumn(out, F.when(x == y, F.lit(100.0)).otherwise(exact)).where(F.col(out) >= floor)
