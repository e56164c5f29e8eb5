"""The training-data pipeline over ``documents``: five operators, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from serieslake.llm import decontamination, language, pieces, quality, simhash
from serieslake.llm.common import table, tokenizer_path
from serieslake.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized."""
    model = language.fit(docs)
    return language.keep_identified(docs, model, language.least_probability(model))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by shingles of 3 words at 2 bits or fewer."""
    return simhash.keep_one(docs, length=3, most=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or with other parameters."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the piece ids of each remaining text."""
    return pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]
#: The classifiers and the best paths have no SQL form; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` in order; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
