"""Registered queries of the corpus operators: opN_<name> over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import bpe, embedding, html, jaccard, langid, line_dedup, merkle, packing, pii, quality, spelling, suffix, url_filter
from marquee.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.suffix_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where("not held_out"))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), pretoken_pattern())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents", *merkle.COLUMNS), merkle.tampered_leaf())
    return found.drop("source")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_line_dedup, op3_suffix_dedup, op4_html_extraction, op5_ngram_jaccard, op6_language_id, op7_best_fit_packing,
                                   op8_quality_rules, op9_byte_bpe, op10_url_filter, op11_merkle_manifest, op12_pii, op13_spelling_variants)}
ORACLE_SQL: dict[str, str] = {"op2_line_dedup": line_dedup.SQL, "op8_quality_rules": quality.SQL, "op10_url_filter": url_filter.SQL,
                              "op11_merkle_manifest": merkle.SQL, "op13_spelling_variants": spelling.SQL}
