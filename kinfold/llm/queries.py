"""The queries of this subpackage, by name, with the SQL that DuckDB can run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_superminhash(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.minhash import near_duplicates

    return near_duplicates(_docs(spark, d), k=2, percent=80)


def op2_wavelet_shards(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.wavelet import encode_to_shards

    got = encode_to_shards(_docs(spark, d), _tokenizer("byte_bpe_50k.json"), end_id=2)
    return got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_bpe_transducer(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.bpe import encode_decode

    got = encode_decode(_docs(spark, d), _tokenizer("word_bpe_49k.json"))
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def media(spark: SparkSession, d: str) -> DataFrame:
    """(vec_id, image): the tables hold no images, so each row of embeddings gets one, by its id.

    Four neighbouring ids share a picture: plain, cropped, relit with noise, turned and cropped.
    """
    from functools import lru_cache

    import pandas as pd

    from kinfold.llm.images import draw, edited, encode_pgm

    def paint(batches):
        picture = lru_cache(16)(draw)
        for pdf in batches:
            every = pdf["vec_id"].tolist()
            for lo in range(0, len(every), 256):
                ids = every[lo : lo + 256]
                yield pd.DataFrame({"vec_id": ids, "image": [encode_pgm(edited(picture(i // 4), i % 4, i)) for i in ids]})

    ids = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id")
    return ids.mapInPandas(paint, "vec_id long, image binary")


def op4_local_descriptors(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.images import image_copies

    return image_copies(media(spark, d), id_col="vec_id")


def held_out(doc_id) -> Column:
    """Rows that no label may be learnt from: crc32 of the id's decimal text, mod 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def op5_crf_toxicity(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.toxicity import score_documents, train, training_rows

    docs = _docs(spark, d)
    net = train(training_rows(docs, spark.read.parquet(f"{d}/labels.parquet"), usable=~held_out(F.col("id"))))
    got = score_documents(docs, net)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")


def op6_cost_packing(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.packing import pack_documents

    got = pack_documents(_docs(spark, d), _tokenizer("word_bpe_49k.json"), end_id=2)
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_projection_passes(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.vectors import near_vectors

    return near_vectors(spark.read.parquet(f"{d}/embeddings.parquet"), least=0.95)


def op8_page_differencing(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.html import extract

    got = extract(spark.read.parquet(f"{d}/pages.parquet"))
    return got.withColumn("n_chars", F.length("text").cast("long"))


def op9_bucket_refinement(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.suffix import remove_repeats

    got = remove_repeats(_docs(spark, d), length=200)
    return got.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.llm.urls import filter_urls

    return filter_urls(spark.read.parquet(f"{d}/pages.parquet"), RULES)


def queries() -> dict:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """Tokenizers, fitted models, markup and images are beyond SQL; tests hold those queries against plain versions."""
    from kinfold.llm import sql

    return {"op1_superminhash": sql.OP1, "op7_projection_passes": sql.OP7, "op9_bucket_refinement": sql.OP9}
