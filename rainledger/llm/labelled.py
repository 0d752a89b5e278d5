"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import crc


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most `most` labelled rows whose crc32(id) mod folds isn't held_out.

    The rows with the lowest hashes of their ids are taken, so the sample is the
    same in each run; rows without an id or a label are left out. Of an id with
    several texts, the one with the smallest hash is taken, so `most` bounds
    what is broadcast and the sample too. A label row that stands twice counts
    once; an id with both labels is in the sample with either.
    """
    fold = crc(F.col("id")) % folds
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (fold != held_out))
        .orderBy(F.xxhash64(F.col("id").cast("string")), "id", "label")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("k"), "text"))["text"]
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one.alias("text")).select("id", "text", "label")
