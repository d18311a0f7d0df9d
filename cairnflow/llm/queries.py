"""The registered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, html_extract, langid, line_dedup, mixing, packing, quality, resampling, shingle_join, token_counts, topk, urls, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality features and verdict of every document."""
    out = quality.judge(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best integer inner products of every 50th vector with all others."""
    x = topk.integer_vector(F.col("embedding")).alias("x")
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", x)
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and draw of every document under raked source, language and topic weights."""
    out = mixing.mix(_read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return out.select("doc_id", "source", "lang", "topic", "tokens", F.round("probability", 5).alias("probability"), "kept")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and component of every document."""
    return shingle_join.join(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.tokens_by_section(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the folds that are not held out."""
    docs = _read(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.train(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold, read back."""
    out = warc.read_archives(warc.write_archives(_read(spark, sf_dir, "pages")))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels taken as page outcomes: a page is bad if its label says toxic or of no quality."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    return _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rule or host reputation."""
    out = urls.judge_urls(_read(spark, sf_dir, "pages"), outcomes(spark, sf_dir), threshold=0.25)
    return out.withColumn("lower", F.round("lower", 6))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents"), with_ids=False)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of all sources of each language, and the terms that mark each source."""
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document by the benchmark's word runs, and the draw of a twentieth."""
    out = resampling.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when lines of ten documents or more are dropped."""
    out = line_dedup.dedup(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_text": op2_html_text,
    "op3_top_k": op3_top_k,
    "op4_mix": op4_mix,
    "op5_ngram_join": op5_ngram_join,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_warc": op8_warc,
    "op9_url_filter": op9_url_filter,
    "op10_pack": op10_pack,
    "op11_divergence": op11_divergence,
    "op12_resample": op12_resample,
    "op13_line_dedup": op13_line_dedup,
}
