"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes the documents that the one before kept and returns the columns of ``documents``; the last returns the
pieces of the packed sequences. Null texts, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import mixing, packing, quality_rules, simhash, substrings
from flowgauge.llm.common import stored, table
from flowgauge.llm.queries import tokenizer, trusted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or are unlike the trusted ones, go."""
    return quality_rules.judge(docs, trusted(spark, sf_dir)).filter("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 3 bits of each other stays: SimHash of three-word shingles."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; texts without any stay as they are. A text may end up empty, its row stays."""
    cut = substrings.remove_repeated(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).filter("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(docs.columns)


def to_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", passage_dedup),
    ("mixing", to_weights),
    ("packing", to_sequences),
]

#: No SQL twin: models, components, tokenizers and linear programs are beyond SQL. Tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else stored(docs), sf_dir)
    return docs
