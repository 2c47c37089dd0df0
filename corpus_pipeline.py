"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``, so further columns travel along.

Defined results: null and empty texts and texts without letters leave in the first stage; an empty
table stays empty; rows that repeat are one document of a near-duplicate group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import langid, mixing, neardup, packing, toxicity
from wardline.llm.common import split_by_keys, table
from wardline.llm.queries import vocabulary_path
from wardline.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the models learn from all labelled rows of ``docs``."""
    found = langid.predict(docs, langid.train(docs))
    return found.filter(~F.col("rejected")).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("score < 0.7").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8).

    A document is an id with its text: an id with several texts is several documents, and rows that
    repeat both, the id missing or not, are one. Only rows that repeat meet each other, and only
    texts of rows that may go or repeat are shuffled.
    """
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    found = neardup.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), k=5)
    per_key = written(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("kept")), "dup-keys")
    gone = per_key.filter("not kept").select(F.col("doc_id").alias("_key"))
    again = per_key.filter("kept and n > 1").select(F.col("doc_id").alias("_key"))
    met, rest = split_by_keys(keyed, "_key", gone.union(again))
    stays = met.join(gone, "_key", "left_anti")
    once = stays.join(again, "_key", "left_semi").dropDuplicates(["_key"])
    return rest.unionByName(stays.join(again, "_key", "left_anti")).unionByName(once).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, mixing.plan(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(packing.pieces(docs, vocabulary_path()))


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), "pipeline-result")
