"""Detecting new profile files with Structured Streaming.

Resolution is a global batch; the stream only remembers, in its checkpoint, which
files were seen, and starts a run when there are new ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def on_new_files(spark: SparkSession, folder: str, checkpoint: str, act: Callable[[DataFrame, int], None]) -> int:
    """Call ``act(files, batch)`` for the files below ``folder`` not seen before; returns how many batches ran.

    ``files`` has path and lines.  Uses the available files only and then stops.
    """
    ran = []
    lines = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{jsonl,jsonl.gz}").text(folder)
    lines = lines.select(F.col("_metadata.file_path").alias("path"))

    def batch(df: DataFrame, number: int) -> None:
        files = df.groupBy("path").agg(F.count("*").alias("lines"))
        if not files.isEmpty():
            ran.append(number)
            act(files, number)

    query = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(ran)
