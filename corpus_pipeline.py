"""The corpus pipeline: each stage is written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import bpe, decontamination, line_dedup, quality_rules, simhash
from sensorloom.llm.common import read
from sensorloom.llm.queries import token_digests, tokenizer_path
from sensorloom.session import work_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the production table rejects go."""
    return quality_rules.passing(docs)


def drop_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: of similar lines the first stays. Documents stay, also without a line left."""
    return line_dedup.deduplicated(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document with the smallest doc_id of each component stays."""
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding: doc_id, number of tokens, and digests of the ids and of the
    decoded text."""
    return token_digests(bpe.encode_decode(docs, tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_copied_lines),
    ("simhash", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: Similar lines, near-duplicates, edit distances and tokens are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
