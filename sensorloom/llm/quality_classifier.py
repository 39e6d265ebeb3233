"""Quality classifier: gradient-boosted trees over statistics of whole documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm import boosting
from sensorloom.llm.arrow import batch_of, schema_of, text_groups
from sensorloom.llm.common import drawn, labelled_texts

#: Labelled documents that the trees are fitted on, drawn by a hash of doc_id.
MAX_TRAINING_ROWS = 20_000

#: Text of those documents, in bytes; where they are long, fewer are drawn.
MAX_TRAINING_BYTES = 1024**3

FEATURES = (
    "log_words", "word_bytes", "distinct_words", "distinct_pairs", "top_word", "digits", "capitals", "symbols",
    "marks", "exclamations", "other_bytes", "log_lines", "line_bytes", "repeated_lines", "no_stop_line",
)


def _class(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), list(characters.encode()))


_CLASSES = np.stack(
    [
        _class("0123456789"),
        _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _class("#*$%&|<>"),
        _class(".,;:?'\"-()"),
        _class("!"),
        np.arange(256) >= 128,
    ]
).astype(np.float64)


def statistics(text: str) -> list[float]:
    """The features of a whole text, in the order of FEATURES. An empty text has zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    counts = Counter(words)
    shares = _CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    ended = sum(line.rstrip()[-1:] in b".!?" for line in lines)
    return [
        np.log(n),
        sum(map(len, words)) / n,
        len(counts) / n,
        len(set(zip(words, words[1:]))) / max(n - 1, 1),
        max(counts.values()) / n,
        *shares.tolist(),
        np.log(len(lines)),
        len(raw) / len(lines),
        1 - len(set(lines)) / len(lines),
        1 - ended / len(lines),
    ]


def _table(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def features(docs: DataFrame, *more: str) -> DataFrame:
    """Statistics of each row's text as an array column, with the columns ``more``."""
    schema = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType())), *(docs.schema[c] for c in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(batch.column(0)[i].as_py() or "") for i in range(batch.num_rows)]
            yield batch_of(schema, found, *(c.to_pylist() for c in batch.columns[1:]))

    return docs.select("text", *more).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_TRAINING_ROWS) -> boosting.Forest:
    """Fit trees on the documents (doc_id, text) that ``labels`` (doc_id, label) covers.

    Rows without a label teach nothing. At most about ``max_rows`` of them, and
    MAX_TRAINING_BYTES of text, are used. Rows that are repeated teach as often.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_label"))
    known = known.filter("_label is not null")
    picked = drawn(known, "_id", max_rows, known.count())
    rows = features(labelled_texts(docs, picked, MAX_TRAINING_BYTES).select("text", "_label"), "_label").collect()
    return boosting.fit(np.array([r[0] for r in rows]).reshape(-1, len(FEATURES)), np.array([r[1] for r in rows]))


def classify(docs: DataFrame, forest: boosting.Forest, threshold: float) -> DataFrame:
    """doc_id, score and predicted of each row of ``docs``. Missing and empty texts are scored
    as texts without words; equal rows alike; an empty table gives no row."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(forest))
    schema = schema_of(docs, "doc_id", ("score", T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = cloudpickle.loads(shared.value)
        for keys, texts in text_groups(batches):
            yield batch_of(schema, keys, trees.probability(_table(texts)))

    scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
