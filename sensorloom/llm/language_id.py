"""Language identification by interpolated Kneser-Ney models of characters.

One model of order 4 per language gives the probability of each character after the three
before it. A text's language is the one with the lowest cross-entropy per character; a text
whose cross-entropy lies above what the language's own texts reach is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.arrow import batch_of, schema_of, text_groups

ORDER = 4

#: Texts of each language that its model is fitted on, drawn by a hash of the key.
MAX_TRAINING_TEXTS = 1_500

#: Letters (bytes) of those texts; where texts are long, fewer of them are drawn.
MAX_TRAINING_BYTES = 32 * 1024 * 1024

#: Languages that are told apart. Each has a column of the table of 4-grams that tasks hold.
MAX_LANGUAGES = 200

#: Share of a language's own texts that calibration lets be rejected.
REJECTED_SHARE = 0.001

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(16)
_UNIFORM = np.float32(-np.log(65536.0))

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point a 16-bit symbol: its lower case if it is a letter, else a space."""
    if not _letters:
        table = np.full(0x110000, 32, np.uint16)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                symbol = ord(letter.lower()[0]) % 65521
                table[code] = {0: 65521, 32: 65522}.get(symbol, symbol)  # 0 and 32 are no letters
        _letters.append(table)
    return _letters[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts and the index of the text each belongs to. Runs of other
    characters are one space; a text of no letters has no symbols."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    found = letters()[np.concatenate(codes)] if len(owner) else np.zeros(0, np.uint16)
    space = found == 32
    kept = np.ones(len(found), bool)
    kept[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    found, owner = found[kept], owner[kept]
    has_letter = np.zeros(len(texts), bool)
    has_letter[owner[found != 32]] = True
    kept = has_letter[owner]
    return found[kept], owner[kept]


def grams(found: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each symbol as 64 bits; places before a text are symbol 0."""
    keys = found.astype(np.uint64)
    for back in range(1, ORDER):
        shifted = np.zeros(len(found), np.uint64)
        inside = owner[back:] == owner[:-back]
        shifted[back:][inside] = found[:-back][inside]
        keys |= shifted << np.uint64(16 * back)
    return keys


def _lowest(keys: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` symbols of each key."""
    return keys & np.uint64((1 << (16 * n)) - 1)


class HashArray:
    """Values by key in an array sorted by the key's hash (a bijection, so nothing collides)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = keys * _MIX
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and the places of their values."""
        if not len(self.hashes):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        hashes = keys * _MIX
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, at


class CharacterModel:
    """Interpolated Kneser-Ney probabilities (natural logs) of one language."""

    def __init__(self, keys: np.ndarray):
        """``keys``: the 4-grams of the training texts, repeats included."""
        grams_n, counts = np.unique(keys, return_counts=True)
        levels = {ORDER: (grams_n, counts)}
        for n in range(ORDER - 1, 0, -1):  # lower orders count the different symbols in front
            levels[n] = np.unique(_lowest(levels[n + 1][0], n), return_counts=True)
        self.seen: dict[int, HashArray] = {}
        self.back_off: dict[int, HashArray] = {}
        for n in range(1, ORDER + 1):
            grams_n, counts = levels[n]
            once, twice = int((counts == 1).sum()), int((counts == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            contexts, at, successors = np.unique(grams_n >> _BITS, return_inverse=True, return_counts=True)
            total = np.bincount(at, counts)
            left = discount * successors / total
            lower = np.exp(self.log_p(n - 1, _lowest(grams_n, n - 1)).astype(np.float64))
            p = (counts - discount) / total[at] + left[at] * lower
            self.seen[n] = HashArray(grams_n, np.log(p).astype(np.float32))
            self.back_off[n] = HashArray(contexts, np.log(left).astype(np.float32))

    def log_p(self, n: int, keys: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.full(len(keys), _UNIFORM, np.float32)
        there, at = self.seen[n].find(keys)
        result = self.seen[n].values[at] if len(self.seen[n].values) else np.zeros(len(keys), np.float32)
        rest = np.flatnonzero(~there)
        if len(rest):
            known, place = self.back_off[n].find(keys[rest] >> _BITS)
            weight = np.where(known, self.back_off[n].values[place], np.float32(0))
            result[rest] = weight + self.log_p(n - 1, _lowest(keys[rest], n - 1))
        return result


def sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums by owner; owners ascend. An owner without values has zero."""
    result = np.zeros((n, *values.shape[1:]))
    if len(owner):
        begins = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
        result[owner[begins]] = np.add.reduceat(values, begins, axis=0, dtype=np.float64)
    return result


class Identifier:
    """All languages' models, with one hash array of the 4-grams that any of them has seen."""

    def __init__(self, languages: list[str], models: list[CharacterModel], limits: list[tuple[float, float, float]]):
        self.languages, self.models = languages, models
        if not languages:
            return
        self.limits = np.array(limits, np.float64)
        # Keys are recovered from hashes by the inverse of the odd multiplier.
        inverse = np.uint64(pow(int(_MIX), -1, 1 << 64))
        keys = np.unique(np.concatenate([m.seen[ORDER].hashes * inverse for m in models]))
        self.table = HashArray(keys, np.stack([m.log_p(ORDER, keys) for m in models], axis=1))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy per character (bits) and rejection of each text."""
        if not self.languages:
            nothing = np.zeros(len(texts))
            return ["und"] * len(texts), nothing, nothing, np.ones(len(texts), bool)
        found, owner = symbols(texts)
        n = len(texts)
        keys, at = np.unique(grams(found, owner), return_inverse=True)
        there, place = self.table.find(keys)
        values = self.table.values[place]
        rest = np.flatnonzero(~there)
        if len(rest):
            values[rest] = np.stack([m.log_p(ORDER, keys[rest]) for m in self.models], axis=1)
        length = np.bincount(owner, minlength=n)
        entropy = -sums(values[at], owner, n) / np.maximum(length, 1)[:, None] / np.log(2)
        best = entropy.argmin(axis=1)
        lowest = entropy.min(axis=1)
        # Odds of the languages from their likelihoods, at most 100 characters' worth.
        weight = np.exp2(-(entropy - lowest[:, None]) * np.minimum(length, 100)[:, None])
        score = np.where(length > 0, 1 / weight.sum(axis=1), 0.0)
        mean, spread, limit = self.limits[best].T
        rejected = (length == 0) | ((lowest - mean) * np.sqrt(np.maximum(length, 1)) / spread > limit)
        names = [self.languages[b] if k else "und" for b, k in zip(best, length)]
        return names, score, np.where(length > 0, lowest, 0.0), rejected


def _fit_language(rows: pd.DataFrame) -> pd.DataFrame:
    """Model and limits of one language: four fifths of its texts are fitted, the others
    show what cross-entropy its texts reach."""
    rows = rows.sort_values("_draw")
    found, owner = symbols(rows["_text"].fillna("").tolist())
    keys, apart = grams(found, owner), owner % 5 == 0
    model = CharacterModel(keys[~apart] if (~apart).any() else keys)
    check, owner = (keys[apart], owner[apart]) if apart.any() else (keys, owner)
    limits = (0.0, 1.0, 1e9)
    if len(check):
        bits = -model.log_p(ORDER, check).astype(np.float64) / np.log(2)
        mean, spread = float(bits.mean()), float(bits.std()) or 1.0
        length = np.bincount(owner)
        some = length > 0
        each = np.bincount(owner, bits)[some] / length[some]
        limits = (mean, spread, float(np.quantile((each - mean) * np.sqrt(length[some]) / spread, 1 - REJECTED_SHARE)))
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "model": [cloudpickle.dumps((model, limits))]})


def train(docs: DataFrame, max_texts: int = MAX_TRAINING_TEXTS) -> Identifier:
    """Fit one model per language of ``docs`` (columns doc_id, text, lang).

    Rows without a language or text teach nothing. At most about ``max_texts`` rows of each
    language are used, and no more than about MAX_TRAINING_BYTES of text, drawn by a hash of
    doc_id and text, so that models stay a few MB each. A language with fewer is learned from
    all its rows. An empty table teaches no language; more than MAX_LANGUAGES are an error.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    counts = sizes.limit(MAX_LANGUAGES + 1).collect()
    if not counts:
        return Identifier([], [], [])
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shares = {r["lang"]: min(1.0, max_texts / r["n"], MAX_TRAINING_BYTES / max(r["bytes"], 1)) for r in counts}
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    draw = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    picked = known.withColumn("_draw", draw).filter(
        F.col("_draw").bitwiseAND(F.lit(2**32 - 1)) < share[F.col("lang")] * 2**32
    )
    fitted = (
        picked.select("lang", "_draw", F.col("text").alias("_text"))
        .groupBy("lang")
        .applyInPandas(_fit_language, "lang string, model binary")
        .collect()
    )
    fitted.sort(key=lambda r: r["lang"])
    models, limits = zip(*(cloudpickle.loads(r["model"]) for r in fitted))
    return Identifier([r["lang"] for r in fitted], list(models), list(limits))


def identify(docs: DataFrame, model: Identifier) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): lang_pred, score, entropy, rejected.

    A missing text, or one without a letter, is ``und`` with score 0 and counts as rejected.
    Where languages are equally good the first by name is taken. Equal rows give equal results,
    an empty table none; a model without languages answers ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    schema = schema_of(
        docs, "doc_id", ("lang_pred", T.StringType()), ("score", T.DoubleType()),
        ("entropy", T.DoubleType()), ("rejected", T.BooleanType()),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = cloudpickle.loads(shared.value)
        for keys, texts in text_groups(batches):
            yield batch_of(schema, keys, *identifier.predict(texts))

    return docs.select("doc_id", "text").mapInArrow(run, schema)
