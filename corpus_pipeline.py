"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; docs has the columns of documents, and all stages but the last return
them. Null texts count as empty. Of texts without words, as of any class of near
duplicates, near_dedup keeps one row, and of repeated rows one; else null ids
are rows of their own. An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.llm.decontaminate import without_leaks
from rainledger.llm.frames import shared_dir, small_batches, table
from rainledger.llm.near_duplicates import near_duplicates
from rainledger.llm.packing import pack
from rainledger.llm.queries import vocabulary
from rainledger.llm.suffix import without_repeats
from rainledger.llm.toxicity import toxicity_scores

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is under 0.5."""
    small_batches(spark)
    return toxicity_scores(docs, table(spark, sf_dir, "labels"), carry=COLUMNS).where("predicted = 0").select(*COLUMNS)


def _rows(docs: DataFrame, *names: str) -> DataFrame:
    """docs with these columns as one, `row`, for operators that hand their id column through."""
    return docs.withColumn("row", F.struct(*names))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id. Rows are told apart by two hashes of all they hold, so texts are shuffled once."""
    small_batches(spark)
    held = [x for c in COLUMNS for x in (F.col(c).isNull(), F.col(c))]
    keyed = docs.withColumn("k1", F.xxhash64(*held)).withColumn("k2", F.hash(*held))
    kept = near_duplicates(_rows(keyed, "doc_id", "k1", "k2"), id_col="row").where("kept").select("doc_id.k1", "doc_id.k2")
    return keyed.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 200-byte strings that stand elsewhere too; parts of characters at the cuts go as well, and n_chars follows."""
    small_batches(spark)
    kept = without_repeats(_rows(docs, "doc_id", "lang", "source"), id_col="row", as_text=True)
    return kept.select("doc_id.*", "text", F.length("text").cast("long").alias("n_chars")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    small_batches(spark)
    return pack(docs, vocabulary())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("decontamination", decontamination), ("packing", packing)]

#: A classifier that is fitted, samples and packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
