"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a column expression over the whole text; no Python runs. Texts are split
into words once, and the parts that depend on them are bound through one-element arrays,
so that the optimizer can't repeat a split inside a lambda.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import SPACES

WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on with as be at by this had not are but from or have an they "
    "which one you were her all their there been if more when will would who so no he his she we "
    "der die das und ist in zu den nicht von mit sich auf für im dem ein eine als auch des "
    "le la les de des et est un une que qui dans pour pas sur au aux par du il elle "
    "el los las y en una por con para se lo como su al del es no"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text whose measure lies in ``low..high``, both included, or is missing."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are shares of words, lines or characters.
RULES = (
    Rule("longest_text", "n_words", high=1_000_000),
    Rule("word_length", "mean_word_chars", low=2.0, high=14.0),
    Rule("symbols", "symbol_ratio", high=0.10),
    Rule("stop_words", "stop_ratio", low=0.03),
    Rule("capitals", "capital_ratio", high=0.50),
    Rule("repeated_lines", "dup_line_ratio", high=0.50),
    Rule("exclamation", "bang_ratio", high=0.30),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES + "+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of 8 words found twice or more in the text.

    Windows are compared by 64-bit hashes; only texts in which a hash repeats are sorted.
    """

    def covered(sorted_hashes: Column) -> Column:
        def hash_at(i: Column) -> Column:
            return F.get(sorted_hashes, i)["h"]

        marked = F.transform(
            sorted_hashes,
            lambda x, i: F.when(
                F.coalesce(hash_at(i - 1) == x["h"], F.lit(False)) | F.coalesce(hash_at(i + 1) == x["h"], F.lit(False)),
                x["i"],
            ),
        )
        starts = F.array_sort(F.filter(marked, lambda i: i.isNotNull()))
        return let(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    def counted(hashes: Column) -> Column:
        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.array_sort(numbered), covered)
        )

    # A window's hash is mixed by doubling: pairs of words, of pairs, then of fours.
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(
            hashed,
            lambda ones: let(
                mixed(ones, 1), lambda twos: let(mixed(twos, 2), lambda fours: let(mixed(fours, 4), counted))
            ),
        )
    )


def mixed(hashes: Column, step: int) -> Column:
    """Each hash mixed with the one ``step`` places later; the last ``step`` have no partner."""
    firsts = F.slice(hashes, 1, F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def measures(text: Column) -> Column:
    """All measures of a text as one struct; a missing text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    stop = [F.lit(w) for w in dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize()))]

    def removed(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(words_of(text), of_words).alias("words"),
        let(lines, of_lines).alias("lines"),
        (F.length(text) - removed(SPACES + "+")).cast("long").alias("word_chars"),
        removed(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        removed(r"\p{Lu}+").cast("long").alias("n_capitals"),
        removed(r"!+").cast("long").alias("n_bangs"),
    )


MEASURE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "_quality") -> DataFrame:
    """``docs`` with one further column ``out``: a struct of the measures and the verdict.

    A missing or empty text has no words, fails the length rule and isn't kept. Other
    columns pass through untouched; ``out`` must be a free name.
    """
    m = measures(F.col(text))

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b)

    def compiled(x: Column) -> Column:
        n = x["words"]["n_words"]
        values = {
            "n_words": n,
            "word_chars": x["word_chars"],
            "n_symbols": x["n_symbols"],
            "n_dup_lines": x["lines"]["n_dup_lines"],
            "n_repeat_words": x["words"]["n_repeat_words"],
            "mean_word_chars": share(x["word_chars"], n),
            "symbol_ratio": share(x["n_symbols"], x["word_chars"]),
            "stop_ratio": share(x["words"]["n_stop"], n),
            "capital_ratio": share(x["n_capitals"], x["word_chars"]),
            "dup_line_ratio": share(x["lines"]["n_dup_lines"], x["lines"]["n_lines"]),
            "bang_ratio": share(x["n_bangs"], n),
        }
        failed = (n < 20) | (100 * values["n_repeat_words"] > 30 * n)
        kept = ~failed
        for rule in rules:
            value = values[rule.measure]
            if rule.low is not None:
                kept = kept & F.coalesce(value >= rule.low, F.lit(True))
            if rule.high is not None:
                kept = kept & F.coalesce(value <= rule.high, F.lit(True))
        named = [column.alias(name) for name, column in values.items()]
        return F.struct(*named, failed.alias("base_failed"), kept.alias("kept"))

    return docs.withColumn(out, let(m, compiled))


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id with the contract's counts and verdict, one row per row of ``docs``.

    An empty table gives no rows; repeated rows are judged each on its own.
    """
    df = measured(docs.select("doc_id", "text"), rules)
    return df.select("doc_id", *(F.col("_quality")[c].alias(c) for c in MEASURE_COLUMNS))


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are."""
    free = "_quality"
    while free in docs.columns:
        free += "_"
    return measured(docs, rules, out=free).filter(F.col(free)["kept"]).drop(free)
