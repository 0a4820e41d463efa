"""From raw documents to token ids, stage by stage.

quality          documents whose chance of the top grade is below one half go
near_duplicates  of documents linked by a shingle similarity of 0.8 or more, the one of the smallest doc_id stays
mixture          sources come near their target weights: documents appear as often as the mix reads them
encode           each document becomes its token ids

Every stage works on all rows of its predecessor. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadtide.llm import bpe, hyperminhash, mixture, ordinal
from loadtide.llm.bloom import maybe_in
from loadtide.llm.queries import read
from loadtide.llm.rows import packed, unpacked
from loadtide.session import materialize

SIMILARITY = 0.8
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents accepted by the ordinal classifier, trained on the labels of the documents present.

    Null, empty and blank texts are rejected. Equal texts share their fate. Without labels everything else stays.
    """
    labels = ordinal.grades_of(read(spark, sf_dir, "labels"))
    model = ordinal.fit(docs, labels, levels=3)
    chance = ordinal.tail(model, ordinal.score(model, F.col("text")), 2)
    return docs.where(chance >= 0.5)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document per group: the smallest doc_id, and one of repeated rows.

    Documents without words have no near duplicates and stay. Different texts of one doc_id stay if any of them is kept.
    """
    found = hyperminhash.near_duplicates(docs.select("doc_id", "text"), threshold=SIMILARITY)
    ids = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept"))
    ids = materialize(ids.where("rows > 1 or not kept"), "decided-ids")
    # documents that are alone in their group pass as they are; the others need an exact look
    doubtful = maybe_in(ids.select("doc_id"), ids.count(), F.col("doc_id"))
    rest = docs.where(doubtful).select(packed(docs))
    rest = rest.join(ids, _same(F.col("row.doc_id"), F.col("doc_id")), "left").where(F.coalesce("kept", F.lit(True)))
    text = F.col("row.text")
    first = Window.partitionBy("row.doc_id", F.xxhash64(text), F.sha1(text.cast("binary"))).orderBy("row.source", "row.lang")
    rest = rest.select("row", F.row_number().over(first).alias("n")).where("n = 1")
    return docs.where(~doubtful).union(rest.select(*unpacked(rest, docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that the sources come near their targets.

    A document appears once for each epoch in which the mix reads any of its words. Rows that agree in doc_id, source and size appear as often as the one read most.
    """
    line, placed = mixture.mix(mixture.sizes(docs))
    epochs = placed.select("row", "epoch").distinct().groupBy("row").agg(F.count("*").cast("int").alias("copies"))
    often = line.where("size > 0").join(epochs, "row", "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
    often = often.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    often = materialize(often.withColumn("at", mixture.bucket(F.col("doc_id"))), "mix-copies")
    # Along a source's line copies only fall. All but a few buckets are therefore alike, and one row per source
    # says which: texts of alike buckets need no shuffle, the others meet their own row.
    ends = [F.min(F.when(F.col("copies") < k, F.col("at"))).alias(f"below{k}") for k in (1, 2, 3)]
    ends += [F.max(F.when(F.col("copies") >= k, F.col("at"))).alias(f"above{k}") for k in (1, 2, 3)]
    bounds = materialize(often.groupBy(F.col("source").alias("of")).agg(*ends), "mix-bounds")
    sized = docs.select(packed(docs), mixture.bucket(F.col("doc_id")).alias("bucket"))
    sized = sized.join(bounds, _same(F.col("row.source"), F.col("of")))
    at = F.col("bucket")
    surely = [F.coalesce(at < F.col(f"below{k}"), F.lit(True)) for k in (1, 2, 3)]
    never = [F.coalesce(at > F.col(f"above{k}"), F.lit(True)) for k in (1, 2, 3)]
    clear = (surely[0] | never[0]) & (surely[1] | never[1]) & (surely[2] | never[2])
    words = mixture.words(F.col("row.text"))
    alike = sized.where(clear).select("row", sum(s.cast("int") for s in surely).alias("copies")).where(words > 0)
    own = often.select("doc_id", "source", "size", "copies")
    rest = sized.where(~clear).select("row", words.alias("words"))
    rest = rest.join(own, _same(F.col("row.doc_id"), F.col("doc_id")) & _same(F.col("row.source"), F.col("source")) & (F.col("words") == F.col("size")))
    both = alike.union(rest.select("row", "copies")).where("copies > 0")
    both = both.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return both.select(*unpacked(both, docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every document."""
    out = bpe.encode(docs, TOKENIZER, keep=("doc_id", "source"))
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixture", mix_sources),
    ("encode", encode),
]

# the stages train a classifier and encode with a tokenizer's tables, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read by the next; extra columns, whatever their names, are passed on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
