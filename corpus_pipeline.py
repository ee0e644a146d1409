"""The text pipeline: documents to tokens in stages, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from alertlake.llm import byte_bpe, decontam, line_dedup, quality_model, simhash
from alertlake.llm.common import read
from alertlake.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_model.keep_predicted(docs, read(spark, sf_dir, "labels"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred in an earlier document go from the text; every document stays."""
    return line_dedup.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encoded_and_decoded(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", passages),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
