"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import pytest

import corpus_pipeline
from conftest import SMALL
from sensorloom.llm import bpe, decontamination, language_id, language_model, line_dedup
from sensorloom.llm import quality_classifier, quality_rules, queries, simhash, toxicity, url_filter
from sensorloom.llm.common import drawn, remainder

LONG = "the cat sat on the mat and looked at it . " * 20_000
ROWS = [
    (1, "the dog and the cat are in the house\nwith a friend of the family", "en", "s", 60),
    (1, "the dog and the cat are in the house\nwith a friend of the family", "en", "s", 60),
    (2, "", None, None, None),
    (3, None, "en", None, 0),
    (None, "der hund und die katze sind im haus", "de", "s", 5),
    (4, LONG, "en", "s", len(LONG)),
    (5, " \n\t\n ", "en", "s", 5),
    (6, "ÄÖÜ 東京 \U0001f600 <|endoftext|> x", None, "s", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(7, "a quite long passage of words that should not be in any text at all"), (8, None), (None, "x"), (9, "")],
        "item_id long, text string",
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (3, 1, None), (None, 0, 0)], "doc_id long, quality int, toxic int")


def test_remainder_of_missing_key(spark):
    rows = spark.createDataFrame([(None,), (17,)], "k long").select(remainder("k", 5).alias("r")).collect()
    import zlib

    assert [r.r for r in rows] == [0, zlib.crc32(b"17") % 5]


def test_drawn_is_the_same_for_any_partitioning(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    once = {r.k for r in drawn(df, "k", 500, 10_000).collect()}
    again = {r.k for r in drawn(df.repartition(3), "k", 500, 10_000).collect()}
    assert once == again and 400 < len(once) < 600
    assert drawn(df, "k", 10_000, 10_000).count() == 10_000


def test_language_id(odd, none):
    model = language_id.train(odd.filter("doc_id is null or doc_id <> 6"))
    found = [(r.doc_id, r.lang_pred) for r in language_id.identify(odd, model).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, "en"), (1, "en"), (2, "und"), (3, "und"), (None, "de"), (4, "en"), (5, "und"), (6, found[-1][1])], key=str
    )
    assert found[-1][1] in ("de", "en")
    assert language_id.identify(none, model).count() == 0
    unlearned = language_id.train(none)
    assert language_id.identify(none, unlearned).count() == 0
    assert {(r.lang_pred, r.score, r.rejected) for r in language_id.identify(odd, unlearned).collect()} == {("und", 0.0, True)}


def test_simhash(odd, none):
    rows = {r.doc_id: r for r in simhash.near_duplicates(odd).collect() if r.doc_id is not None}
    assert simhash.near_duplicates(odd).count() == len(ROWS)
    assert {rows[i].fingerprint for i in (2, 3, 5)} == {"0" * 16}
    assert {rows[i].component_id for i in (2, 3, 5)} == {2}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 4, 6, None]


def test_decontamination(spark, odd, none, benchmark):
    passage = benchmark.first().text
    docs = odd.unionByName(spark.createDataFrame([(10, f"before {passage.upper()} after", "en", "s", 1)], SCHEMA))
    hits = decontamination.contaminated(docs, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.begin_word, r.distance) for r in hits] == [(10, 7, 1, 0)]
    assert decontamination.clean(docs, benchmark).count() == len(ROWS)
    assert decontamination.contaminated(none, benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.filter("false")).count() == 0
    assert decontamination.clean(docs, benchmark.filter("false")).count() == len(ROWS) + 1


def test_toxicity(odd, none, labels):
    model = toxicity.train(odd, labels)
    rows = toxicity.judge(odd, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.judge(none, model).count() == 0
    assert 0 <= toxicity.judge(odd, toxicity.train(none, labels)).first().score <= 1


def test_line_dedup(odd, none):
    rows = line_dedup.marked(odd).collect()
    assert len(rows) == len(ROWS)
    assert {(r.doc_id, r.n_lines, r.n_removed) for r in rows} == {
        (1, 2, 0), (2, 0, 0), (3, 0, 0), (None, 1, 0), (4, 1, 0), (5, 0, 0), (6, 1, 0)
    }
    assert line_dedup.marked(none).count() == 0
    clashing = odd.withColumnRenamed("source", "_key").withColumnRenamed("lang", "_gone")
    assert line_dedup.deduplicated(clashing).columns == clashing.columns
    assert line_dedup.deduplicated(odd).count() == len(ROWS)


def test_rows_of_different_texts_under_one_id(spark):
    shared = "this line of some length is in more than one of the rows"
    own = [f"row {i} alone has words like {w} in this second line" for i, w in enumerate(("apple", "stone", "river"))]
    texts = [(1, f"{own[0]}\n{shared}"), (1, f"{shared}\n{own[1]}"), (2, own[2]), (2, own[2])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    left = sorted(r.text for r in line_dedup.deduplicated(docs).collect())
    assert sorted("\n".join(left).split("\n")) == sorted([*own, own[2], shared])
    assert sorted((r.n_lines, r.n_removed) for r in line_dedup.marked(docs).collect()) == [(1, 0), (1, 0), (2, 0), (2, 1)]
    kept = [tuple(r) for r in simhash.representatives(docs).collect()]
    assert sorted(kept) == sorted(set(texts))


def test_language_model(odd, none):
    held = odd.withColumn("held_out", odd["doc_id"] == 6)
    rows = language_model.score(held).collect()
    assert len(rows) == len(ROWS)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 5)} == {1}
    assert language_model.score(none.withColumn("held_out", none["doc_id"] == 6)).count() == 0
    untrained = language_model.score(odd.withColumn("held_out", odd["doc_id"].isNotNull() | odd["doc_id"].isNull()))
    assert {r.n_known for r in untrained.collect()} == {0}


def test_quality_classifier(odd, none, labels):
    forest = quality_classifier.train(odd, labels, "quality")
    assert quality_classifier.classify(odd, forest, 0.3).count() == len(ROWS)
    assert quality_classifier.classify(none, quality_classifier.train(none, labels, "quality"), 0.3).count() == 0


def test_url_filter(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.example.com/en/x"), (2, "https://WWW.example.com/en/?q=://b"), (3, None), (4, ""), (5, "no scheme"),
            (6, "x://b.net/fr/1"), (7, "http://example.com"), (8, "http://notexample.com/en/"), (None, "http://ü.org/#/es/"),
        ],
        "page_id long, url string",
    )
    ruled = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.with_rules(pages).collect()}
    assert ruled[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert ruled[2] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert ruled[3] == ruled[4] == ruled[5] == ("", "", None, None)
    assert ruled[6][2:] == ("net/fr/", "block")
    assert ruled[7] == ("example.com", "", None, None)
    assert ruled[8][2:] == ("com/", "allow")
    assert ruled[None][:2] == ("ü.org", "/")
    known = url_filter.with_rules(pages).filter("rule is not null").selectExpr("url", "verdict = 'block' as blocked")
    model = url_filter.train(known)
    rows = url_filter.judge(pages, model).collect()
    assert len(rows) == 9 and {r.verdict for r in rows} <= {"allow", "block"}
    assert url_filter.judge(pages.filter("false"), url_filter.train(known.filter("false"))).count() == 0


def test_bpe(odd, none):
    path = queries.tokenizer_path()
    rows = bpe.encode_decode(odd, path).collect()
    texts = [r[1] or "" for r in ROWS]
    assert sorted(r.decoded for r in rows) == sorted(texts)
    assert bpe.encode_decode(none, path).count() == 0


def test_quality_rules(odd, none):
    rows = [(r.doc_id, r.n_words, r.kept) for r in quality_rules.quality_rules(odd).collect()]
    assert (3, 0, False) in rows and (2, 0, False) in rows and len(rows) == len(ROWS)
    assert quality_rules.quality_rules(none).count() == 0
    clashing = odd.withColumnRenamed("source", "_quality")
    assert quality_rules.passing(clashing).columns == clashing.columns


def test_stages_over_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            out.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
