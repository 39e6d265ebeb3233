"""Operators against brute force, libraries and held-out labels."""

import hashlib
import math
import os
import random
import subprocess
import sys
import time
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

import corpus_pipeline
from conftest import MEDIUM, ROOT, SMALL
from sensorloom import session
from sensorloom.llm import boosting, bpe, components, decontamination, language_model, line_dedup, queries, simhash
from sensorloom.llm.elias_fano import EliasFano


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()


def test_xxhash_is_the_same_in_spark_and_python(spark):
    text = "that's ä text\tof 東京"
    assert spark.createDataFrame([(text,)], "t string").selectExpr("xxhash64(t)").first()[0] % 2**64 == (
        xxhash.xxh64_intdigest(text.encode(), 42)
    )


def test_fingerprint_by_definition(documents):
    for text in [*documents.text.head(20), "", "One", "a B c", "a b c d", "a b c d a b c d"]:
        words = text.encode().lower().split()
        grams = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text.encode()) == expected


@pytest.mark.parametrize("parts", (2, 4))
def test_simhash_components_by_brute_force(spark, monkeypatch, parts):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 60, np.int64)
    near = base[draw.integers(0, 60, 240)] ^ (1 << draw.integers(0, 63, 240)) ^ (1 << draw.integers(0, 63, 240))
    # 64 fingerprints of one cell, so of several panels.
    crowd = [0x00FF00FF00FF00FF ^ (1 << i) ^ (1 << j) for i in range(8) for j in range(8, 16)]
    fps = np.unique(np.concatenate([base, near, [0, -1, 1, -2], crowd]))
    if parts == 4:
        monkeypatch.setattr(simhash, "FINE", 0)
    table = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    found = components.connected(simhash.links(table, 4, tile=8, side=2)).collect()
    label = {r.node: r.component for r in found}
    bits = fps.view(np.uint64)
    x, y = np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4)
    expected = components.roots(x, y, len(fps))
    sizes = Counter(expected.tolist())
    assert len(label) == sum(n for n in sizes.values() if n > 1)
    for i, fp in enumerate(fps.tolist()):
        assert label.get(fp, fp) == int(fps[expected == expected[i]].min())


@pytest.mark.parametrize("same", (True, False))
def test_skipped_tiles_lose_no_link(same):
    draw = np.random.default_rng(4)
    base = draw.integers(0, 2**63, 400, np.uint64)
    flips = np.uint64(1) << draw.integers(0, 64, (3, 400)).astype(np.uint64)
    a, b = base, np.unique(base ^ flips[0] ^ flips[1])
    if same:
        a = b = np.unique(np.concatenate([base, base ^ flips[0], base ^ np.bitwise_xor.reduce(flips)]))
    x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 4)
    nodes = np.unique(np.concatenate([a, b]))

    def labels(one, other):
        return components.roots(np.searchsorted(nodes, one), np.searchsorted(nodes, other), len(nodes))

    found = simhash.compared(a, b, 4, same, tile=16)
    assert len(found[0]) < len(nodes)
    assert (labels(*found) == labels(a[x], b[y])).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (3, 2), (2, 3)]
    linked = components.connected(spark.createDataFrame(edges, "a long, b long"))
    found = {r.node: r.component for r in linked.collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(500, 560)} == {500}
    assert found[2] == found[3] == 2 and 7 not in found
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_tables_are_few_files(spark, tmp_path, monkeypatch):
    """Each task's file forks the executor (chmod) on a local disk, which counts its memory twice."""
    monkeypatch.setattr(session, "work_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    edges = spark.range(600).selectExpr("id div 30 * 30 as a", "id as b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.node: r.component for r in components.connected(edges).collect()}
        monkeypatch.setattr(session, "TABLE_ROWS", 100)
        several = session.write_table(spark.range(1000).repartition(8), "several", 300)
        every = session.write_table(spark.range(1000).repartition(8), "every", 1000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {i: i // 30 * 30 for i in range(600)}
    folders = sorted(tmp_path.glob("parents-*"))
    assert len(folders) >= 2 and all(len(list(f.glob("part-*"))) == 1 for f in folders)
    assert (len(several.inputFiles()), len(every.inputFiles())) == (3, 8)
    assert several.count() == every.count() == 1000


def test_edit_distance_by_definition():
    draw = random.Random(5)
    for _ in range(50):
        item = [draw.randrange(4) for _ in range(draw.randint(1, 8))]
        window = [draw.randrange(4) for _ in range(draw.randint(1, 10))]
        table = list(range(len(window) + 1))
        for i, a in enumerate(item, 1):
            row = [i]
            for j, b in enumerate(window, 1):
                row.append(min(table[j - 1] + (a != b), table[j] + 1, row[-1] + 1))
            table = row
        assert decontamination.distances(np.array([window]), np.array([item]))[0] == min(table)


def test_decontamination_recall_at_the_limit(spark, documents):
    draw = random.Random(3)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    matcher = decontamination.Matcher(items)
    clean = [decontamination.words_of(t) for t in documents.text if not matcher.find([t])]
    planted = []
    for trial in range(200):
        item, text = draw.choice(items)
        words = decontamination.words_of(text)
        for edit in range(decontamination.allowed(len(words), decontamination.SIMILARITY)):
            at, kind = draw.randrange(len(words)), draw.choice("sid")
            words[at : at + (kind != "i")] = [] if kind == "d" else [f"zz{edit}"]
        around = draw.choice(clean)
        cut = draw.randrange(len(around) + 1)
        planted.append((item, " ".join(around[:cut] + words + around[cut:])))
    found = {(t, i) for t, i, *_ in matcher.find([text for _, text in planted])}
    assert sum((t, i) in found for t, (i, _) in enumerate(planted)) >= 0.97 * len(planted)


def test_items_at_the_start_of_a_text_by_brute_force(spark):
    """After a clean and after an empty text, all in one group and one by one."""
    item = "once upon a time a small grey mouse lived below the old red barn"
    words = item.split()
    texts = [
        "some clean text about nothing in particular",
        f"{item} and then it rained",
        "",
        f"{item} again",
        "a small grey mouse lived below the old red barn",
        "another clean text",
        " ".join([*words[:3], "year", *words[4:], "so they say"]),
        "...",
        " ".join(["well", *words[:6], *words[7:]]),
    ]
    allowed, expected = decontamination.allowed(len(words), decontamination.SIMILARITY), []
    for number, text in enumerate(texts):
        found, best = text.split() if text != "..." else [], []
        for begin in range(len(found)):
            row = list(range(len(words) + 1))
            for word in [None, *found[begin : begin + len(words) + allowed]]:
                if word is not None:
                    above, row = row, [row[0] + 1]
                    for j, w in enumerate(words):
                        row.append(min(above[j] + (w != word), above[j + 1] + 1, row[-1] + 1))
                best.append((row[-1], begin))
        if best and min(best)[0] <= allowed:
            expected.append((number, 1, min(best)[1], min(best)[0]))
    assert [n for n, *_ in expected] == [1, 3, 6, 8]
    schema = "doc_id long, text string"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), schema).coalesce(1)
    alone = [spark.createDataFrame([row], schema) for row in enumerate(texts)]
    hits = lambda d: [tuple(r)[:4] for r in decontamination.contaminated(d, benchmark).collect()]
    kept = lambda d: [r.doc_id for r in decontamination.clean(d, benchmark).collect()]
    clean = [n for n in range(len(texts)) if n not in {n for n, *_ in expected}]
    assert hits(docs) == expected and kept(docs) == clean
    assert sum(map(hits, alone), []) == expected and sum(map(kept, alone), []) == clean


def test_decontamination_recall_of_long_items():
    draw = random.Random(3)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(800))) for i in range(10)]
    texts = []
    for trial in range(60):
        words = items[trial % 10][1].split()
        for edit in range(decontamination.allowed(800, decontamination.SIMILARITY)):
            at, kind = draw.randrange(len(words)), draw.choice("sid")
            words[at : at + (kind != "i")] = [] if kind == "d" else [f"zz{edit}"]
        texts.append(" ".join(["before"] * 5 + words + ["after"] * 5))
    found = {(t, i) for t, i, *_ in decontamination.Matcher(items).find(texts)}
    assert sum((t, t % 10) in found for t in range(60)) >= 0.98 * 60


def test_line_dedup_by_brute_force(spark, documents):
    rows = line_dedup.marked(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    lines = [(i, n, x) for i, t in sorted(zip(documents.doc_id, documents.text)) for n, x in enumerate(t.split("\n")) if x.strip()]
    distinct = list(dict.fromkeys(x for *_, x in lines))
    sets = [set(s.tolist()) for s in line_dedup._sets(distinct)]
    a, b = [], []
    for i, s in enumerate(sets):
        for j in range(i):
            shared = len(s & sets[j])
            if shared >= 0.8 * (len(s) + len(sets[j]) - shared) - 1e-9:
                a.append(i), b.append(j)
    label = dict(zip(distinct, components.roots(np.array(a, int), np.array(b, int), len(distinct))))
    expected, seen = {}, set()
    for doc, number, line in lines:
        if label[line] in seen:
            expected.setdefault(doc, []).append(number)
        seen.add(label[line])
    assert {r.doc_id: r.removed for r in rows if r.n_removed} == expected


@pytest.mark.parametrize("phrase", ("=", "spam "))
def test_lines_of_one_repeated_phrase_are_candidates(phrase):
    lines = [(phrase * 130)[:size] for size in (60, 130)]
    values, of_line = line_dedup.bands(lines)
    assert set(values[of_line == 0].tolist()) & set(values[of_line == 1].tolist())


@pytest.mark.parametrize("pairwise", [0, 3, line_dedup.PAIRWISE, 10**9])
def test_similar_sets_by_definition(monkeypatch, pairwise):
    monkeypatch.setattr(line_dedup, "PAIRWISE", pairwise)
    draw = np.random.default_rng(5)
    base = draw.integers(0, 400, 60)

    def sets() -> list[np.ndarray]:
        shares = draw.choice([0.95, 0.5], draw.integers(1, 20))
        return [np.unique(np.r_[base[draw.random(60) < s], draw.integers(0, 2000, 9)]).astype(np.uint64) for s in shares]

    for _ in range(20):
        left, right = sets(), sets()
        expected = [[len({*a} & {*b}) >= 0.8 * len({*a} | {*b}) - 1e-9 for b in right] for a in left]
        assert line_dedup.similar(left, right, 0.8).tolist() == expected


def test_lines_left_apart_meet_those_of_their_bands(spark):
    """A cluster of chance links between families of lines, with another block than all of it."""
    draw = random.Random(9)
    words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(400)]
    families = []
    for _ in range(12):
        common = words[:14]  # makes chance links between families
        families.append(common + draw.sample(words, 8))
    lines = []
    for family in families:
        for _ in range(12):
            line = list(family)
            for _ in range(draw.randrange(2)):
                line[draw.randrange(len(line))] = draw.choice(words)
            lines.append(" ".join(line))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.node % 2**64: r.component for r in line_dedup.components(docs, block=16).collect()}
    distinct = list(dict.fromkeys(lines))
    sets = [set(s.tolist()) for s in line_dedup._sets(distinct)]
    near = np.array([[len(a & b) >= 0.8 * len(a | b) - 1e-9 for b in sets] for a in sets])
    x, y = np.nonzero(near)
    expected = components.roots(x, y, len(distinct))
    keys = line_dedup.keys_of(distinct).tolist()
    label = [found.get(k, f"alone {k}") for k in keys]
    for i in range(len(keys)):
        for j in range(i):
            assert (label[i] == label[j]) == (expected[i] == expected[j])


def test_tokenizer_files_of_another_kind_raise(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    with pytest.raises(ValueError, match="normalizer, pre_tokenizer"):
        bpe.encode_decode(docs, queries.tokenizer_path("word_bpe_49k.json"))


def test_large_clusters_of_lines_are_compared_in_blocks(spark):
    line = "the quick brown fox jumps over the lazy dog number one two three {} and then goes home again to sleep well"
    other = "an altogether different line that shares nothing with the others but this part {}, and its end as well"
    texts = [(i, "\n".join([line.format(f"w{i}"), line.format(f"x{i % 7}"), other.format(i % 9)])) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    whole = {tuple(r) for r in line_dedup.components(docs).collect()}
    assert whole == {tuple(r) for r in line_dedup.components(docs, block=8).collect()}
    assert len({c for _, c in whole}) == 2


def test_elias_fano():
    draw = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 5), (1000, 1200), (1000, 2**40), (20_000, 2**63)):
        values = np.unique(draw.integers(0, top, n, dtype=np.uint64))
        coded = EliasFano(values)
        asked = np.concatenate([values, draw.integers(0, top, 300, np.uint64), np.array([0, top, 2**64 - 1], np.uint64)])
        there, place = coded.find(asked)
        assert (there == np.isin(asked, values)).all() and (place == np.searchsorted(values, asked)).all()
        assert (coded.get(np.arange(len(values))) == values).all()


def test_language_model_by_brute_force(spark, documents):
    rows = queries.op6_language_model(spark, SMALL).collect()
    tokens = {i: [*t.encode().lower().split(), "end"] for i, t in zip(documents.doc_id, documents.text)}
    learned = [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for i in learned for w in tokens[i])
    pairs = Counter(p for i in learned for p in zip(["start", *tokens[i]], tokens[i]))
    of_context = c | Counter(start=len(learned))
    total, mu = sum(c.values()), language_model.MU
    once, twice = (sum(n == k for n in c.values()) for k in (1, 2))
    discount = once / (once + 2 * twice)
    for r in rows:
        words = tokens[r.doc_id]
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (len(c) + 1))) for w in words)
        p = [
            (pairs[v, w] + mu * ((c[w] - discount if c[w] else discount * len(c)) / total)) / (of_context[v] + mu)
            for v, w in zip(["start", *words], words)
        ]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(base)
        # codes round log10 probabilities to steps of 12 / 254
        assert abs(r.score - sum(map(math.log10, p))) <= 0.03 * len(words)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_trie_answers_from_the_range_of_a_context():
    """Numbers of successors meet those of the next context, so the pointers decide."""
    random = np.random.default_rng(6)
    own = np.sort(random.choice(1 << 62, 60, replace=False).astype(np.uint64))
    pairs = {(int(c), int(s)) for c, s in zip(random.integers(0, 50, 700), random.integers(0, 40, 700))}
    pairs |= {(55, 0), (57, (1 << 32) - 1), (58, 0)}
    counts = {p: int(random.integers(1, 1000)) for p in pairs}
    context, successor = np.array(sorted(pairs)).T
    totals = random.integers(1000, 2000, 60)
    trie = language_model.Trie(
        context, successor.astype(np.uint64), np.array([counts[p] for p in sorted(pairs)]), totals, own, 50.0
    )
    asked = np.array([0, 1, 7, 20, 39, 40, 45, 46, 80, 1000, (1 << 32) - 1], np.uint64)
    contexts = np.append(own, own[:5] + np.uint64(1))  # the last ones are not there
    codes = trie.find(contexts, np.full(65, len(asked)), np.tile(asked, 65))
    found = language_model.probability_of(codes).reshape(65, -1)
    for i in range(65):
        for j, s in enumerate(asked.tolist()):
            p = counts[i, s] / (totals[i] + 50) if (i, s) in pairs else 0
            assert found[i, j] == pytest.approx(p, rel=0.06)


@pytest.mark.parametrize("share", (1e-5, 2.0))
def test_frequent_words_are_dealt_over_shards(spark, monkeypatch, share):
    """The same scores whether the words are broadcast or reach the blocks by a join."""
    monkeypatch.setattr(language_model, "BROADCAST_SHARE", share)
    docs = spark.createDataFrame([(i, f"the w{i} the x{i % 50} the") for i in range(400)], "doc_id long, text string")
    docs = docs.withColumn("held_out", docs["doc_id"] % 4 == 0)
    small = {r.doc_id: r.score for r in language_model.score(docs, block_tokens=200).collect()}
    whole = {r.doc_id: r.score for r in language_model.score(docs).collect()}
    assert small == pytest.approx(whole)
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    c = Counter(w for i, t in texts.items() if i % 4 for w in [*t, "end"])
    pairs = Counter(p for i, t in texts.items() if i % 4 for p in zip(["start", *t], [*t, "end"]))
    c["start"], total, mu = 300, c.total(), language_model.MU
    once, twice = (sum(n == k for w, n in c.items() if w != "start") for k in (1, 2))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    for i, t in texts.items():
        p = [
            (pairs[v, w] + mu * (c[w] - discount if c[w] else discount * (len(c) - 1)) / total) / (c[v] + mu)
            for v, w in zip(["start", *t], [*t, "end"])
        ]
        assert abs(small[i] - sum(map(math.log10, p))) <= 0.03 * len(p)


def test_blocks_are_held_a_few_at_a_time(spark, tmp_path, monkeypatch):
    """Neither a row group nor a batch for a worker holds many blocks, what blocks sent is gone
    once it is answered, and scores are the same."""
    draw = np.random.default_rng(3)
    texts = [(i, " ".join(f"w{n}" for n in draw.zipf(1.3, 5000) % 3000)) for i in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    docs = docs.withColumn("held_out", docs["doc_id"] % 4 == 0)
    whole = {r.doc_id: r.score for r in language_model.score(docs).collect()}
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, rows_of, write_table = spark.conf.get(key), language_model.rows_of, session.write_table
    disk, left = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), []

    def shuffled():
        return {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle")}

    def written(df, name, *args, **kwargs):
        there = shuffled()
        table = write_table(df, name, *args, **kwargs)
        for _ in range(100):
            if name == "answers" and shuffled() - there:
                time.sleep(0.1)  # they are removed meanwhile
        left.extend(shuffled() - there if name == "answers" else ())
        return table

    def watched(table):
        assert table.num_rows == 1, "a batch of several blocks"
        yield from rows_of(table)

    monkeypatch.setattr(session, "work_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(session, "LARGE_ROWS_BYTES", 10_000, raising=False)
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 5000)
    monkeypatch.setattr(language_model, "rows_of", watched)
    monkeypatch.setattr(language_model, "write_table", written)
    scores = {r.doc_id: r.score for r in language_model.score(docs).collect()}
    assert scores == pytest.approx(whole)
    files = [pq.ParquetFile(x).metadata for x in tmp_path.glob("blocks-*/*.parquet")]
    assert sum(f.num_rows for f in files) == 12
    assert {f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)} == {1}
    assert spark.conf.get(key) == before and not left


def test_bpe_is_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    rows = {r.doc_id: r for r in queries.op9_bpe(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_of_odd_texts():
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_path()
    library = tokenizers.Tokenizer.from_file(path)
    with open(path, "rb") as file:
        vocabulary = bpe.Vocabulary(file.read())
    draw = random.Random(1)
    parts = ["<|endoftext|>", "aaaa", "  ", "\n\n", " the", "'ll", "\u0085", "中", "é", "1", "!", "\x1c", "a\u0301"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(2000)]
    for text, ids in zip(texts, bpe.encode_texts(vocabulary, iter(texts))):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert vocabulary.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_boosting_learns_and_takes_missing_numbers():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(3000, 4))
    labels = (rows[:, 0] > 0.3) ^ (rows[:, 1] > 0)
    forest = boosting.fit(rows[:2000], labels[:2000])
    assert ((forest.probability(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.95
    assert np.isfinite(forest.probability(np.full((2, 4), np.nan))).all()
    assert boosting.fit(rows[:5], np.ones(5)).probability(rows[:2]).min() > 0.8


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    language = queries.op1_language_id(spark, MEDIUM).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (language.lang == language.lang_pred).mean() > 0.97
    quality = queries.op7_quality_classifier(spark, MEDIUM).join(labels, "doc_id").filter("held_out").toPandas()
    assert (quality.quality == quality.predicted).mean() > 0.95
    toxic = queries.op4_toxicity(spark, MEDIUM).join(labels, "doc_id").filter("held_out").toPandas()
    assert (toxic.toxic == toxic.predicted).mean() > 0.93


def test_url_filter_covers_all_pages(spark):
    rows = queries.op8_url_filter(spark, SMALL).toPandas()
    assert len(rows) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert set(rows.verdict) <= {"allow", "block"} and rows.score.between(0, 1).all()


def test_pipeline_is_its_stages_one_after_the_other(spark):
    tokens = corpus_pipeline.run(spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
    assert sorted(tokens.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontamination.contaminated(docs, benchmark).count() == 0


def test_whole_tables_are_read(spark):
    """Each document query gives a row for every document."""
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op2_simhash", "op5_line_dedup", "op10_quality_rules"):
        assert queries.queries()[name](spark, SMALL).count() == n


SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from sensorloom.llm import queries
from sensorloom.session import build_session

spark = build_session("away", "local[2]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}})
for name in ("op1_language_id", "op4_toxicity", "op7_quality_classifier", "op8_url_filter", "op11_token_files",
             "op12_hard_negatives", "op13_prefix_trie"):
    print("rows", queries.queries()[name](spark, {SMALL!r}).count())
"""


def test_workers_that_cannot_import_the_package(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.count("rows") == 7, done.stderr[-2000:]
