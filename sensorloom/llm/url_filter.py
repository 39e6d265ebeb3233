"""URL filter: rules first, then gradient-boosted trees on lexical features of the URL."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm import boosting
from sensorloom.llm.arrow import batch_of
from sensorloom.llm.common import drawn

#: Labelled URLs that the trees are fitted on, drawn by a hash of the URL.
MAX_TRAINING_ROWS = 20_000

#: Weight of an even share in the block rate of a suffix.
PRIOR = 50.0

#: A suffix with fewer labelled URLs has the rate of an unseen one, one half.
LEAST_URLS = 5

#: Parts that labelled URLs are dealt over for the rates they are fitted with.
FOLDS = 5

#: Half of the labelled URLs are fitted as if some of their suffixes had never been labelled: of
#: each kind this share.
HIDDEN = 0.5


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that begin with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash sign or the end."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def first_rule(rules: Sequence[Rule], host: Column, path: Column, take: str) -> Column:
    """``take`` (name or verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last, longest one is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, take))).otherwise(found)
    return found


def parts(url: str | None) -> tuple[str, str, str]:
    """Host, path and what follows the path."""
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", "", url or ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:cut].lower(), rest[cut:]
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host, rest[:cut], rest[cut:]


def suffixes(host: str, path: str) -> list[str]:
    """Keys whose block rates are features: the host's last one and two labels, its first
    label, and the path's first folder alone and under the last label."""
    labels = host.split(".")
    folder = path.split("/")[1] if path.count("/") > 1 else ""
    return [
        "1:" + labels[-1],
        "2:" + ".".join(labels[-2:]),
        "f:" + labels[0],
        "p:" + folder,
        "s:" + labels[-1] + "/" + folder,
    ]


def group(url: str | None) -> str:
    """What tells which labelled URLs belong together: the last label and the first folder."""
    return suffixes(*parts(url)[:2])[-1]


def lexical(url: str | None) -> list[float]:
    """Length, depth, shares, entropy and counts of a URL's characters."""
    url = url or ""
    host, path, rest = parts(url)
    n = max(len(url), 1)
    counts = np.unique(np.frombuffer(url.encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)[1] / n
    digits = sum(c.isdigit() for c in url)
    return [
        len(url),
        len(host),
        len(path),
        len(rest),
        path.count("/"),
        host.count("."),
        host.count("-"),
        digits / n,
        sum(c.isdigit() for c in host),
        float(-(counts * np.log2(counts)).sum()) if len(url) else 0.0,
        rest.count("&") + (rest[:1] == "?" and len(rest) > 1),
        rest.count("="),
        url.count("%"),
        float(url[:6].lower() == "https:"),
    ]


class Filter:
    """Block rates of suffixes, and trees over them and the lexical features."""

    def __init__(self, rates: dict[str, float], forest: boosting.Forest):
        self.rates, self.forest = rates, forest

    def probability(self, urls: list[str | None]) -> np.ndarray:
        return self.forest.probability(_rows(urls, self.rates)) if urls else np.zeros(0)


def _rows(urls: list[str | None], rates: dict[str, float]) -> np.ndarray:
    return np.array([lexical(u) + [rates.get(s, 0.5) for s in suffixes(*parts(u)[:2])] for u in urls])


def _rates(urls: list[str], blocked: np.ndarray, weights: np.ndarray) -> dict[str, float]:
    """Block rate of each suffix, drawn towards one half by ``PRIOR`` rows."""
    seen: dict[str, list[float]] = {}
    for url, label, weight in zip(urls, blocked, weights):
        for key in suffixes(*parts(url)[:2]):
            entry = seen.setdefault(key, [0.0, 0.0, 0.0])
            entry[0] += label * weight
            entry[1] += weight
            entry[2] += 1
    return {k: float((b + PRIOR * 0.5) / (n + PRIOR)) for k, (b, n, rows) in seen.items() if rows >= LEAST_URLS}


def fit(urls: list[str], blocked: np.ndarray) -> Filter:
    """Fit on labelled URLs. Both verdicts count alike.

    A URL's rates in fitting come from the other folds, so that its own label is not in them.
    Half of the URLs are fitted with some rates hidden, as those of suffixes without a label
    are later: the trees have to do with the kinds of suffix that are known, and with the
    lexical features, where the nearest one isn't.
    """
    blocked = np.asarray(blocked, np.float64)
    yes, no = max(blocked.sum(), 1.0), max((1 - blocked).sum(), 1.0)
    weights = np.where(blocked > 0, len(blocked) / (2 * yes), len(blocked) / (2 * no))
    width, kinds = len(lexical("")), len(suffixes("", ""))
    rows = np.zeros((len(urls), width + kinds))
    draw = np.array([zlib.crc32(u.encode("utf-8", "surrogatepass")) for u in urls], np.int64)
    folds = draw % FOLDS
    for k in range(FOLDS):
        mine, others = np.flatnonzero(folds == k), np.flatnonzero(folds != k)
        if len(mine):
            rates = _rates([urls[i] for i in others], blocked[others], weights[others])
            rows[mine] = _rows([urls[i] for i in mine], rates)
    random = np.random.default_rng(draw.sum() % 2**32).random((len(urls), kinds + 1))
    hidden = (random[:, 1:] < HIDDEN) & (random[:, :1] < 0.5)
    rows[:, width:][hidden] = 0.5
    return Filter(_rates(urls, blocked, weights), boosting.fit(rows, blocked, weights=weights))


def group_accuracy(urls: list[str], blocked: np.ndarray) -> dict[str, float]:
    """Share of right verdicts in each group, by a filter fitted on all other groups."""
    blocked, names = np.asarray(blocked, np.float64), np.array([group(u) for u in urls])
    found = {}
    for name in sorted(set(names)):
        mine = names == name
        model = fit([u for u, m in zip(urls, mine) if not m], blocked[~mine])
        p = model.probability([u for u, m in zip(urls, mine) if m])
        found[name] = float(((p >= 0.5) == (blocked[mine] > 0)).mean())
    return found


def train(labelled: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Filter:
    """Fit on rows (url, blocked); at most about ``max_rows``, drawn by a hash of the URL."""
    known = labelled.select("url", F.col("blocked").cast("double").alias("blocked"))
    known = known.filter("url is not null and blocked is not null")
    rows = drawn(known, "url", max_rows, known.count()).collect()
    rows.sort()
    return fit([r["url"] for r in rows], np.array([r["blocked"] for r in rows]))


def with_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, url, host, path, rule and the rule's verdict (null where no rule fits)."""
    cut = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    return cut.withColumns(
        {"rule": first_rule(rules, host, path, "name"), "verdict": first_rule(rules, host, path, "verdict")}
    )


def judge(pages: DataFrame, model: Filter, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' block probability of each page.

    A missing URL has empty parts, no rule, and the verdict of the trees on an empty text.
    Repeated rows are judged alike; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    ruled = with_rules(pages, rules)
    kept = [ruled.schema[c] for c in ("page_id", "host", "path", "rule", "verdict")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = cloudpickle.loads(shared.value)
        for batch in batches:
            p = learned.probability(batch.column(0).to_pylist())
            yield batch_of(schema, *(c.to_pylist() for c in batch.columns[1:]), p)

    judged = ruled.select("url", *(f.name for f in kept)).mapInArrow(run, schema)
    learned_verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce("verdict", learned_verdict))
