"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    compressed,
    decontaminate,
    language,
    licences,
    pages,
    quality,
    scoring,
    sentencepieces,
    simhash,
    spellings,
    substrings,
    tokenfiles,
    whitening,
)

#: Where the public vocabulary files lie.
PIECES = "piece_bpe_32k.model"
BYTE_PAIRS = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("text_hash")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokenfiles.digests(spark, tokenfiles.write(docs, vocabulary(BYTE_PAIRS)))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"), drop_one_in=31)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_html_extraction": op4_html_extraction,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_license_scan": op9_license_scan,
    "op10_token_output": op10_token_output,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_quality_classifier": op13_quality_classifier,
}

SQL: dict[str, str] = {}
