"""A corpus pipeline of four operators over ``documents``.

Each stage takes all that the one before kept and returns the columns of
documents; the last returns packed pieces.  Stages are written as Parquet in the
folder that the driver and all executors share, and read again; a stage's table goes
once the next one is written.

Defined results: extra columns are carried to the last stage, whatever their names;
null texts have no toxic tokens, no shingles and no repeats, and are packed as their
end id alone; null ids are kept by all stages; of repeated ids each row is judged by
its own text; an empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.minhash import drop_near_duplicates
from kinfold.llm.packing import pack_documents
from kinfold.llm.queries import held_out
from kinfold.llm.shared import remove, shared_dir
from kinfold.llm.suffix import without_repeats
from kinfold.llm.toxicity import drop_toxic, train, training_rows

TOXIC = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity score reaches the threshold; the model is fitted on those of ``labels`` that are not held out.

    Without labelled documents of both kinds nothing is dropped; null ids, null and
    empty texts stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = train(training_rows(docs, labels, usable=~held_out(F.col("id"))))
    return drop_toxic(docs, net, TOXIC)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group of near duplicates (five words, 0.8).

    Null ids and texts without words stay; equal rows of one id stay together.
    """
    return drop_near_duplicates(docs, k=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut byte strings of 200 that occur more than once out of the texts; no row goes, a null text becomes empty."""
    got = without_repeats(docs, length=200)
    return got.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else got


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, placed in sequences; each document has its end id at least."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("repeats", repeats), ("packing", packing)]

#: SQL can express none of the stages after the first model; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
        if before:
            remove(spark, before)
        before = f"{out}/{name}"
    return docs
