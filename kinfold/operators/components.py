"""Connected components of an edge table, by randomised contraction.

In each round every vertex is mapped to the vertex of lowest random priority that
two edges reach and the edges are rewritten to the images; a new order is drawn for
each round.  A star of any size is united in one round, and paths shrink by a
constant factor in expectation.  Minima are pre-aggregated before their exchange, so
a hub costs one row per task, and the joins are plain inner joins, which adaptive
execution can split.  Each round ends in a table in the shared folder.
"""

from __future__ import annotations

import gc
import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_count = itertools.count()
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which the driver and all executors share.

    Where that is unset, a folder of this machine serves a session that is local;
    any other session gets an error.
    """
    app = spark.sparkContext.applicationId
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        found = _own[app]
    return f"{found.rstrip('/')}/kinfold-{app}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clean(spark: SparkSession) -> None:
    """Delete all tables that this application saved; their DataFrames can't be read any more."""
    remove(spark, shared_dir(spark))


def saved(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Unlike a checkpoint, the table carries no constraints of the plan that made it;
    those grow with each round of an iteration until they fill the driver.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if next(_count) % 4 == 3:
        release(spark)
    got = spark.read.schema(df.schema).parquet(path)
    got._kinfold_path = path
    return got


def discard(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t._kinfold_path)


def release(spark: SparkSession) -> None:
    """Let the driver drop what finished steps left: heap, and by it shuffle files and broadcasts."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component): for every vertex of an edge, the smallest vertex it can reach.

    Null ends, loops and repeated edges have no effect, but the vertex of a loop is
    listed.  An empty edge table has no rows.  Ids must be of an orderable type.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    every = saved(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    loops = every.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("to"))
    left, held = every.where("a <> b"), None
    maps: list[DataFrame] = []
    round_no = 0
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_no)).alias("h"), F.col(c).alias("v"))
        both = left.select("a", rank("b").alias("r")).unionAll(left.select(F.col("b").alias("a"), rank("a").alias("r")))
        near = both.groupBy("a").agg(F.min("r").alias("r")).select(F.col("a").alias("b"), F.least(F.col("r"), rank("a")).alias("r"))
        ways = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a vertex's own minimum is no lower than those of its neighbours, whose neighbour it is
        best = ways.join(near, "b").groupBy("a").agg(F.min("r").alias("r"))
        step = saved(best.select(F.col("a").alias("id"), F.col("r")["v"].alias("to")))
        one, two = step.select(F.col("id").alias("a"), F.col("to").alias("x")), step.select(F.col("id").alias("b"), F.col("to").alias("y"))
        moved = left.join(one, "a").join(two, "b").where("x <> y")
        left = saved(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if held is not None:
            discard(held)
        held = left
        maps.append(step)
        round_no += 1
    if not maps:
        return loops.select("id", F.col("to").alias("component"))
    label = maps[0]
    for step in maps[1:]:
        nxt = step.select(F.col("id").alias("to"), F.col("to").alias("then"))
        label = label.join(nxt, "to", "left").select("id", F.coalesce("then", "to").alias("to"))
    label = saved(label)
    discard(held, *maps)
    alone = loops.join(label.select("id"), "id", "left_anti")
    low = label.groupBy("to").agg(F.min("id").alias("component"))
    return label.join(low, "to").select("id", "component").unionAll(alone.select("id", F.col("to").alias("component")))
