"""From raw documents to packed sequences: quality, language, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.llm import langid, mixing, packing, quality, shingle_join
from cairnflow.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.passing(docs.select(*COLUMNS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, least_score: float = 0.5) -> DataFrame:
    """Documents in a language that the classifier knows, told with at least ``least_score``."""
    found = langid.predict(docs.select(*COLUMNS), langid.train(docs), keep=tuple(COLUMNS))
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least_score)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id.

    A document is dropped only if its component is a smaller doc_id; dropped ids are few and have no hot key.
    """
    groups = shingle_join.join(docs)
    gone = written(groups.filter("component_id <> doc_id").select("doc_id"), "near_duplicates")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of documents by calibrated probabilities of their source, language and topic."""
    return mixing.mix(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Language identification and packing have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written to the shared folder and reread by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
