"""The learned operators against their definitions, written out plainly."""

import math
from collections import Counter

import numpy as np
import pytest

from compare import connect
from conftest import MEDIUM, SMALL
from sensorloom.llm import boosting, language_id, queries, toxicity, url_filter
from pyspark.sql import functions as F


# Kneser-Ney


def kneser_ney(texts):
    """log p of a 4-gram of symbols, from dictionaries."""
    levels = {4: Counter()}
    for text in texts:
        padded = [0] * 3 + text
        levels[4].update(tuple(padded[i : i + 4]) for i in range(len(text)))
    for n in (3, 2, 1):
        levels[n] = Counter(gram[1:] for gram in levels[n + 1])

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / 65536
        counts = levels[n]
        ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        row = {g: c for g, c in counts.items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:])
        if not row:
            return lower
        total = sum(row.values())
        seen = (row[gram] - discount) / total if gram in row else 0.0
        return seen + discount * len(row) / total * lower

    return p


def test_kneser_ney_by_dictionary():
    texts = ["the cat sat on the mat", "a cat, a hat: THE bat", "t", "", "ça va là"]
    found, owner = language_id.symbols(texts)
    keys = language_id.grams(found, owner)
    model = language_id.CharacterModel(keys)
    p = kneser_ney([found[owner == i].tolist() for i in range(len(texts))])
    odd, owner = language_id.symbols(["the dog sat", "zzz", "cat"])
    asked = np.unique(np.r_[keys, language_id.grams(odd, owner)])
    for key, value in zip(asked.tolist(), model.log_p(4, asked)):
        gram = tuple(key >> 16 * i & 0xFFFF for i in (3, 2, 1, 0))
        assert value == pytest.approx(math.log(p(gram)), abs=1e-4)


def test_probabilities_sum_to_one():
    found, owner = language_id.symbols(["abracadabra abba", "cab"])
    p = kneser_ney([found[owner == i].tolist() for i in range(2)])
    symbols = sorted(set(found.tolist()))
    rest = (65536 - len(symbols)) * p((97, 98, 114, 9999))
    assert sum(p((97, 98, 114, s)) for s in symbols) + rest == pytest.approx(1)


def test_the_two_letters_that_fold_to_no_letter(spark):
    texts = ["\U00010011\U00010011", "\U00020002", "\U0000fff1"]
    kept = [t for t in texts if all(map(str.isalpha, t))]
    assert all(len(language_id.symbols([t])[0]) == len(t) for t in kept)
    assert language_id.letters()[0x20002] not in (0, 32)


def test_ties_go_to_the_first_language(spark):
    rows = [(1, "same text", "b"), (2, "same text", "a"), (3, "same text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(docs, language_id.train(docs)).collect()
    assert {r.lang_pred for r in found} == {"a"} and {r.score for r in found} == {0.5}


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 1)
    docs = spark.createDataFrame([(1, "a", "a"), (2, "b", "b")], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language_id.train(docs)


# Noisy-or


def test_noisy_or_by_definition():
    model = toxicity.Model({"idiot$": 3.0, "idio": 2.0, "nice$": -1.5, "stup": 4.5}, -3.0)
    text = "You idiot. Nice day! Stupid\nidiots and nice idiots"
    clean = 1.0
    for sentence in ("you idiot", "nice day", "stupid", "idiots and nice idiots"):
        odds = model.base + sum(model.weights.get(f, 0) for w in set(sentence.split()) for f in toxicity.describe(w))
        clean *= 1 - 1 / (1 + math.exp(-odds))
    score, spans = model.score(text)
    assert score == pytest.approx(1 - clean)
    assert [text[b:e] for b, e, _ in spans] == ["You idiot.", " Stupid\n"[1:]] or len(spans) >= 2


def test_training_climbs_the_noisy_or_likelihood():
    """The likelihood of the labels, written out, is higher after more steps and near one."""
    bad, good = "this is vile filth. good day", "a good day. what a sunny walk"
    texts, labels = [bad, good] * 20, np.array([1, 0] * 20)

    def likelihood(model):
        total = 0.0
        for text, label in zip(texts, labels):
            clean = 1.0
            for b, e in toxicity.sentences(text):
                words = set(toxicity.WORD.findall(text, b, e))
                odds = model.base + sum(model.weights.get(f, 0) for w in words for f in toxicity.describe(w))
                clean *= 1 - 1 / (1 + math.exp(-odds))
            total += math.log(1 - clean if label else clean)
        return total / len(texts)

    steps = [likelihood(toxicity.fit(texts, labels, epochs=n)) for n in (1, 10, 50, 150)]
    assert steps == sorted(steps) and steps[-1] > -0.05
    model = toxicity.fit(texts, labels)
    (begin, end, _), = model.score(bad)[1]
    assert bad[begin:end] == "this is vile filth."


def test_offending_sentences_are_in_the_result(spark):
    found = queries.op4_toxicity(spark, SMALL)
    text = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    spans = found.join(text, "doc_id").select("score", "text", F.explode("offending").alias("s")).collect()
    assert spans
    for r in spans:
        assert 0 <= r.s.begin < r.s.end <= len(r.text) and toxicity.OFFENDING <= r.s.probability <= r.score + 1e-9


def test_training_ignores_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "vile", 9, 9), (2, "good", 9, 9)], "doc_id long, text string, _id int, _label int")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.judge(docs, toxicity.train(docs, labels)).count() == 2


# Boosted trees


def best_split(column, gradient, weight, smoothing=1.0, least=2.0):
    """Gain and threshold of the best cut, by trying every one."""
    best = (0.0, None)
    values = np.unique(column)
    total_g, total_h = gradient.sum(), weight.sum()
    for cut in (values[1:] + values[:-1]) / 2:
        left = column <= cut
        g, h = gradient[left].sum(), weight[left].sum()
        if h < least or total_h - h < least:
            continue
        gain = g**2 / (h + smoothing) + (total_g - g) ** 2 / (total_h - h + smoothing) - total_g**2 / (total_h + smoothing)
        if gain > best[0] + 1e-9:
            best = (gain, cut)
    return best


def test_first_split_by_trying_all():
    draw = np.random.default_rng(4)
    rows = draw.integers(0, 30, (400, 5)).astype(float)
    labels = ((rows[:, 3] > 17) ^ (draw.random(400) < 0.1)).astype(float)
    forest = boosting.fit(rows, labels, trees=1, depth=1)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    gradient, weight = labels - share, np.full(len(labels), share * (1 - share))
    gains = [best_split(rows[:, f], gradient, weight) for f in range(5)]
    feature = max(range(5), key=lambda f: gains[f][0])
    assert forest.feature[0, 0] == feature == 3 and forest.threshold[0, 0] == gains[feature][1]


def test_traversal_by_recursion():
    draw = np.random.default_rng(5)
    rows = draw.normal(size=(300, 4))
    rows[::7, 1] = np.nan
    forest = boosting.fit(rows, (rows[:, 0] + np.nan_to_num(rows[:, 1]) > 0).astype(float), trees=8, depth=3)

    def walk(t, row, node=0):
        if node >= 2**forest.depth - 1:
            return forest.value[t, node - (2**forest.depth - 1)]
        right = row[forest.feature[t, node]] > forest.threshold[t, node]
        return walk(t, row, 2 * node + 1 + int(right))

    for row, found in zip(rows, forest.probability(rows)):
        margin = forest.base + sum(walk(t, row) for t in range(8))
        assert found == pytest.approx(1 / (1 + math.exp(-margin)))


# URLs


RULES_SQL = """
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
),
named AS (SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT n.page_id, n.host, n.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
FROM named n LEFT JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
GROUP BY ALL
"""


def test_rules_as_sql(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    found = url_filter.with_rules(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, found)) == sorted(connect(MEDIUM).sql(RULES_SQL).fetchall())


@pytest.fixture(scope="module")
def labelled(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = url_filter.with_rules(pages).filter("rule is not null").selectExpr("url", "verdict = 'block' as b").collect()
    rows.sort()
    return [r.url for r in rows], np.array([r.b for r in rows], float)


def test_trees_decide_pages_without_a_rule(spark):
    found = queries.op8_url_filter(spark, "/root/testdata/sf0.1").toPandas()
    free = found[found.rule.isna()]
    assert len(free) > 1000 and free.score.nunique() > 20 and set(free.verdict) == {"allow", "block"}
    assert ((free.score >= 0.5) == (free.verdict == "block")).all()
    # Folders of .net were blocked wherever a rule names one; of .com most were allowed.
    assert free[free.host.str.endswith(".net")].score.mean() > free[free.host.str.endswith(".org")].score.mean()


def test_trees_use_lexical_features(labelled):
    model = url_filter.fit(*labelled)
    used = set(model.forest.feature[np.isfinite(model.forest.threshold)].tolist())
    assert used & set(range(len(url_filter.lexical(""))))


def test_accuracy_on_urls_and_on_groups_left_out(labelled):
    """URLs left out are judged right. Whole groups are left out to measure it only: the rules
    set their verdicts one by one, so that hardly anything carries over from six of them."""
    urls, blocked = labelled
    apart = np.array([len(u) % 4 == 0 for u in urls])
    model = url_filter.fit([u for u, a in zip(urls, apart) if not a], blocked[~apart])
    p = model.probability([u for u, a in zip(urls, apart) if a])
    assert ((p >= 0.5) == (blocked[apart] > 0)).mean() > 0.97
    found = url_filter.group_accuracy(urls, blocked)
    assert set(found) == set(map(url_filter.group, urls)) and all(0 <= x <= 1 for x in found.values())


def test_unlabelled_folders_are_judged_by_what_is_known():
    """Two domains, one blocked in every folder: a new folder goes with its domain."""
    urls = [f"https://h{i}.{d}.org/{folder}/{i}" for d in ("good", "bad") for folder in "abcd" for i in range(60)]
    blocked = np.array(["bad.org" in u for u in urls], float)
    model = url_filter.fit(urls, blocked)
    p = model.probability([f"https://h1.{d}.org/z/1" for d in ("good", "bad")])
    assert p[0] < 0.2 and p[1] > 0.8
