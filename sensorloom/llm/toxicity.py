"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's probability is logistic in the distinct words it holds, each described by itself
and by its beginnings; a document is toxic unless none of its sentences is (noisy-or). Both
are fitted together by gradient descent on the documents' labels, and the sentences' own
probabilities then locate the offence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.arrow import batch_of, schema_of, text_groups
from sensorloom.llm.common import drawn, labelled_texts

#: Labelled documents of each class that the model is fitted on, drawn by a hash of doc_id.
MAX_TRAINING_ROWS = 3_000

#: Text of all those documents, in bytes; where they are long, fewer are drawn.
MAX_TRAINING_BYTES = 128 * 1024 * 1024

#: A feature counts if it is in at least so many training documents.
LEAST_DOCUMENTS = 5

#: Features that a model holds at most; those in the most documents come first.
MAX_FEATURES = 500_000

#: Words whose weights a worker remembers.
REMEMBERED = 1_000_000

#: A sentence with at least this probability is reported.
OFFENDING = 0.5

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
WORD = re.compile(r"\w+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Begin and end of each sentence: up to a full stop, mark or line end."""
    return [m.span() for m in SENTENCE.finditer(text)]


def describe(word: str) -> list[str]:
    """A word's features: the word itself, and its first 4, 5 and 6 letters."""
    return [word + "$", *(word[:n] for n in (4, 5, 6) if len(word) >= n)]


class _Words(dict):
    """Weight of each word, made when it is first met."""

    def __init__(self, features: dict[str, float]):
        self.features = features

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = weight = sum(self.features.get(f, 0.0) for f in describe(word))
        return weight


class Model:
    """Weights of known features, and the log-odds of a sentence without any."""

    def __init__(self, weights: dict[str, float], base: float):
        self.weights, self.base = weights, base
        self.words = _Words(weights)

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences, and the offending ones with their probabilities."""
        lowered = text.lower()
        if len(lowered) != len(text):  # some letters change length; spans are those of the text
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        weight = self.words.__getitem__
        spans = sentences(lowered)
        odds = [self.base + sum(map(weight, sorted(set(WORD.findall(lowered, b, e))))) for b, e in spans] or [self.base]
        p = 1 / (1 + np.exp(-np.clip(np.array(odds, np.float64), -500, 500)))
        score = float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))
        return score, [(b, e, float(x)) for (b, e), x in zip(spans, p) if x >= OFFENDING]


def fit(texts: list[str], labels: np.ndarray, epochs: int = 150, rate: float = 0.2, sparsity: float = 3e-4) -> Model:
    """Fit feature weights by Adam on the noisy-or likelihood; both classes count alike."""
    number: dict[str, int] = {}
    column, sentence, owner = [], [], []
    for i, text in enumerate(texts):
        lowered = text.lower()
        for begin, end in sentences(lowered):
            words = [number.setdefault(w, len(number)) for w in sorted(set(WORD.findall(lowered, begin, end)))]
            column += words
            sentence += [len(owner)] * len(words)
            owner.append(i)
    column, sentence, owner = (np.array(x, np.int64) for x in (column, sentence, owner))
    within = np.unique(owner[sentence] * max(len(number), 1) + column) % max(len(number), 1)
    documents = np.bincount(within, minlength=len(number))
    described = [describe(w) for w in number]
    found: dict[str, int] = {}
    for word, n in zip(described, documents.tolist()):
        for feature in word:
            found[feature] = found.get(feature, 0) + n
    often = sorted((f for f, n in found.items() if n >= LEAST_DOCUMENTS), key=lambda f: (-found[f], f))[:MAX_FEATURES]
    place = {f: k for k, f in enumerate(often)}
    pairs = [(k, place[f]) for k, word in enumerate(described) for f in word if f in place]
    of_word, feature = np.array(pairs, np.int64).reshape(-1, 2).T
    n, labels = len(texts), np.asarray(labels, np.float64)
    weight = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    w, base = np.zeros(len(often)), -4.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for epoch in range(1, epochs + 1):
        of_words = np.bincount(of_word, w[feature], len(number))
        z = np.clip(base + np.bincount(sentence, of_words[column], len(owner)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), n)
        toxic = -np.expm1(clean)
        slope = np.where(labels > 0, (1 - toxic) / np.maximum(toxic, 1e-9), -1.0) * weight
        by_sentence = slope[owner] * p
        by_word = np.bincount(column, by_sentence[sentence], len(number))
        by_feature = np.bincount(feature, by_word[of_word], len(w)) - sparsity * np.sign(w)
        gradient = np.append(by_feature, by_sentence.sum())
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient**2 - v)
        step = rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-4)
        w += step[:-1]
        base = min(base + step[-1], -1.0)
    kept = np.flatnonzero(np.abs(w) > 0.1)
    return Model({often[k]: float(w[k]) for k in kept}, float(base))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Fit on the documents (doc_id, text) that ``labels`` (doc_id, label) covers, at most about
    ``max_rows`` of each class and MAX_TRAINING_BYTES of text. One task fits: what it reads is
    bounded by these. Rows that are repeated teach as often; an empty table, or one class
    alone, gives a model that still scores every text."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).filter("_label in (0, 1)")
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for value in sorted(counts):
        part = drawn(known.filter(F.col("_label") == value), "_id", max_rows, counts[value])
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return Model({}, -10.0)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_id", "text"])
        model = fit(rows["text"].fillna("").tolist(), rows["_label"].to_numpy())
        return pd.DataFrame({"model": [cloudpickle.dumps((model.weights, model.base))]})

    rows = labelled_texts(docs, picked, MAX_TRAINING_BYTES)
    fitted = rows.groupBy(F.lit(0).alias("_all")).applyInPandas(run, "model binary").collect()
    return Model(*cloudpickle.loads(fitted[0]["model"])) if fitted else Model({}, -10.0)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, and the offending sentences (begin, end, probability) of each row.

    Missing and empty texts have no sentences; their score is that of a sentence without
    known words. Equal rows give equal results; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps((model.weights, model.base)))
    span = T.StructType(
        [
            T.StructField("begin", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("probability", T.DoubleType()),
        ]
    )
    schema = schema_of(docs, "doc_id", ("score", T.DoubleType()), ("offending", T.ArrayType(span)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Model(*cloudpickle.loads(shared.value))
        for keys, texts in text_groups(batches):
            scores, spans = zip(*(learned.score(t) for t in texts))
            named = [[dict(zip(("begin", "end", "probability"), s)) for s in found] for found in spans]
            yield batch_of(schema, keys, scores, named)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
