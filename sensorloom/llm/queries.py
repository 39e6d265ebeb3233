"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import bpe, conversation_trie, decontamination, hard_negatives, language_id, language_model
from sensorloom.llm import line_dedup, oracles
from sensorloom.llm import quality_classifier, quality_rules, simhash, token_files, toxicity, url_filter
from sensorloom.llm.common import read, remainder
from sensorloom.session import work_dir

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed vocabulary files have the named one."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = language_id.train(docs.filter(~held_out))
    return language_id.identify(docs, model).withColumn("held_out", held_out)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents", "doc_id", "text"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return decontamination.contaminated(docs, read(spark, folder, "benchmark"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "labels")
    model = toxicity.train(docs, labels.filter(remainder("doc_id", 5) != 0))
    return toxicity.judge(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        "offending",
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.marked(read(spark, folder, "documents", "doc_id", "text"))


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    held_out = remainder("doc_id", 5) == 1
    scored = language_model.score(docs.withColumn("held_out", held_out))
    return scored.withColumn("held_out", held_out)


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "labels")
    forest = quality_classifier.train(docs, labels.filter(remainder("doc_id", 5) != 0), "quality")
    scored = quality_classifier.classify(docs, forest, 0.3)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The URLs that a rule decides are the labelled ones that the trees learn from."""
    pages = read(spark, folder, "pages", "page_id", "url")
    ruled = url_filter.with_rules(pages).filter("rule is not null")
    model = url_filter.train(ruled.select("url", (F.col("verdict") == "block").alias("blocked")))
    return url_filter.judge(pages, model).select("page_id", "host", "path", "rule", "verdict", "score")


def op9_bpe(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return token_digests(bpe.encode_decode(docs, path or tokenizer_path()))


def token_digests(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, folder, "documents"))


def op11_token_files(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    out = work_dir(spark, "token-files")
    docs = read(spark, folder, "documents", "doc_id", "text")
    token_files.write(docs, out, path or tokenizer_path())
    found = token_files.documents(spark, out)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of every seventh row are shifted first, so that there are hard ones."""
    rows = read(spark, folder, "embeddings", "vec_id", "embedding", "label")
    label = F.col("label").cast("bigint")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = rows.select("vec_id", shifted.alias("label"), hard_negatives.quantised(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    sequences = conversation_trie.sequences(turns)
    return conversation_trie.nodes(conversation_trie.with_common_start(sequences))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if re.match(r"op\d+_", name)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
