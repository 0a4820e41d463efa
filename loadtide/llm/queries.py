"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.llm import bpe, decontam, extract, hashforest, hyperminhash, metricjoin, mixture, ordinal, ring, rtree, viterbi, walsh, warc
from loadtide.session import shared_dir

ROWS_PER_BATCH = "1000"  # whole documents and pages: a few megabytes, where the default makes tens


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    found = warc.read(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op2_metricjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metricjoin.near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.98)


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.taken(read(spark, sf_dir, "documents"))


def op5_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    out = ring.assign(docs.select("doc_id", "text", crc), shards=24)
    nothing = F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", nothing)


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(read(spark, sf_dir, "documents"), threshold=0.85)


def op7_viterbi(spark: SparkSession, sf_dir: str, path: str = public_tokenizers.path("piece_bpe_32k.model")) -> DataFrame:
    return viterbi.count_tokens(read(spark, sf_dir, "documents"), path)


def op8_hashforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashforest.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = ordinal.fit(docs, ordinal.grades_of(read(spark, sf_dir, "labels")), levels=3)
    out = ordinal.grade_documents(model, docs, at_least=2)
    return out.select("doc_id", "expected_grade", "tail_probability", "accepted")


def op10_bpe(spark: SparkSession, sf_dir: str, path: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    out = bpe.encode(read(spark, sf_dir, "documents"), path)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(out, out["ids"], path), 256).alias("decoded_sha256"),
    )


def op11_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.mine(table.withColumn("label", other), F.col("vec_id") % 100 == 0, positives=5, negatives=10, window=(30, 90))


def op12_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op13_walsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = walsh.compress(read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    return out.select("vec_id", "code", "error", "label_error", F.lit(walsh.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_metricjoin": op2_metricjoin,
    "op3_extract": op3_extract,
    "op4_mixture": op4_mixture,
    "op5_ring": op5_ring,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_viterbi": op7_viterbi,
    "op8_hashforest": op8_hashforest,
    "op9_ordinal": op9_ordinal,
    "op10_bpe": op10_bpe,
    "op11_rtree": op11_rtree,
    "op12_decontam": op12_decontam,
    "op13_walsh": op13_walsh,
}
