"""The corpus operators as queries over the synthetic tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainledger.llm.frames import table


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from rainledger.llm.suffix import without_repeats

    found = without_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op3_weighted_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.site_style import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op8_elias_fano_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.language_model import model_scores

    return model_scores(table(spark, sf_dir, "documents"))


def op9_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.webp import media_columns

    return media_columns(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary())


def op11_tsqr_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"))


def op12_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.lexical import ranked

    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_grace_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rainledger.llm.exact import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    from rainledger.llm import decontaminate, exact, lexical

    return {"op2_template_decontamination": decontaminate.oracle(), "op12_bit_sliced_search": lexical.oracle(), "op13_grace_hash_dedup": exact.oracle()}
