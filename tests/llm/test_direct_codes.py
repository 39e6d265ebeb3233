"""Token ids in directly addressable codes, and the files made of them."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from sensorloom.llm import queries, token_files
from sensorloom.llm.arrow import text_arrays
from sensorloom.llm.direct_codes import Bitmap, DirectCodes
from sensorloom.session import work_dir

ROWS = [
    (None, "a  b <|endoftext|> x\n\n  y <|endoftext|>"),
    (5, None),
    (5, ""),
    (5, " "),
    (-1, "tab\t x 's 't  ' s  z \x1c q"),
    (7, " lead\nline\n"),
    (7, " lead\nline\n"),
    (8, "東京 が  x"),
    (9, "long " * 20_000),
]


@pytest.mark.parametrize("top", (0, 1, 200, 300, 70_000, 2**32 - 1))
@pytest.mark.parametrize("n", (1, 63, 64, 512, 5000))
def test_any_number_and_any_run(top, n):
    draw = np.random.default_rng(n)
    numbers = draw.integers(0, top, n, np.uint32, endpoint=True)
    codes = DirectCodes.of(np.array_split(numbers, 3))
    assert len(codes) == n and len(codes.levels) == max(1, -(-int(numbers.max()).bit_length() // 8))
    at = draw.integers(0, n, 200)
    assert (codes.get(at) == numbers[at]).all()
    for begin, end in ((0, n), (0, 0), (n // 3, n // 2), (n - 1, n)):
        assert (codes.run(begin, end) == numbers[begin:end]).all()


def test_rank_by_counting():
    bits = np.random.default_rng(1).random(3000) < 0.3
    bitmap = Bitmap.of(bits)
    assert (bitmap.rank(np.arange(3001)) == np.r_[0, np.cumsum(bits)]).all()
    assert (bitmap.test(np.arange(3000)) == bits).all()
    assert (bitmap.run(700, 1900) == bits[700:1900]).all()


def test_encoder_equals_the_library_also_when_it_forgets(monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENTS", 300)
    path = queries.tokenizer_path()
    library, draw = Tokenizer.from_file(path), random.Random(5)
    letters = [" ", "\n", "a", "'s", "'", "b1", "é", "\t", "\x1c", "\xa0", "<|endoftext|>", ".", "東", " x", "\r\n", "foo"]
    encoder = token_files.Encoder(open(path, "rb").read())
    for _ in range(20):
        texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 14))) for _ in range(300)]
        flat, counts = encoder.encode(texts)
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(e) for e in expected]
        assert flat.tolist() == [i for e in expected for i in e]
    assert len(encoder.numbers) < 4000


def test_encoder_equals_the_library_at_marks_and_wide_spaces(monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENTS", 400)
    path = queries.tokenizer_path()
    library, draw = Tokenizer.from_file(path), random.Random(6)
    letters = [" ", "\n", "Ab", "c", "s", "'", "ll", ",", ".", "!!", "_", "-", "|", "<", ">", "9", "é", "”", "–", "ы", "東"]
    letters += ["\x7f", "\x1d", "\t", "\x85", "\xa0", "\u1680", "\u180e", "\u2009", "\u2028", "\u3000", "\u200b", "<|endoftext|>"]
    encoder = token_files.Encoder(open(path, "rb").read())
    for _ in range(20):
        texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 20))) for _ in range(400)]
        flat, counts = encoder.encode(texts)
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(e) for e in expected]
        assert flat.tolist() == [i for e in expected for i in e]


def test_a_word_goes_through_the_library_once_whatever_mark_follows():
    path, sent = queries.tokenizer_path(), []
    library, encoder = Tokenizer.from_file(path), token_files.Encoder(open(path, "rb").read())
    plain = encoder._ids
    encoder._ids = lambda texts: sent.extend(texts) or plain(texts)
    words = ["".join(random.Random(i).choices("abcdefgh", k=12)) for i in range(200)]
    texts = [" " + " ".join(word + mark for word in words) for mark in ("", ",", ".", "!!", ");", '?"')]
    flat, _ = encoder.encode(texts)
    assert flat.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert sum(map(len, sent)) < 1.1 * len(texts[0])


@pytest.mark.parametrize("normalizer", (None, {"type": "NFC"}))
def test_encoder_takes_empty_texts_and_other_settings(normalizer):
    spec = json.load(open(queries.tokenizer_path())) | {"normalizer": normalizer}
    content = json.dumps(spec).encode()
    library, encoder = Tokenizer.from_str(content.decode()), token_files.Encoder(content)
    for texts in (["", ""], ["e\u0301, x", "", "  e\u0301, x ", "a.b\nc", "a.b\nc", ""], [""]):
        flat, counts = encoder.encode(texts)
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(e) for e in expected]
        assert flat.tolist() == [i for e in expected for i in e]


def test_groups_of_texts_in_arrow():
    rows = [(None, "a"), (1, None), (2, ""), (3, "éé" * 10), (4, "x"), (5, "y" * 50), (6, None)]
    table = pa.table({"key": [k for k, _ in rows], "text": [t for _, t in rows]})
    for limit in (1, 5, 30, 1000):
        found = list(text_arrays([*table.slice(0, 4).to_batches(2), *table.slice(4).to_batches()], limit))
        assert [k for keys, _ in found for k in keys] == [k for k, _ in rows]
        assert [t.decode() for _, texts in found for t in texts.to_pylist()] == [t or "" for _, t in rows]
        assert all(len(keys) == len(texts) for keys, texts in found)
        assert len(found) == {1: 7, 5: 3, 30: 3, 1000: 1}[limit]


def test_added_tokens_with_a_line_end_take_whole_texts():
    spec = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "model": {"type": "BPE"}}
    assert not token_files.cuts_at_spaces(spec | {"added_tokens": [{"content": "a\nb"}]})


def test_other_tokenizer_settings_take_whole_texts():
    spec = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "model": {"type": "BPE"}}
    assert token_files.cuts_at_spaces(spec)
    assert not token_files.cuts_at_spaces(spec | {"normalizer": {"type": "NFC"}})
    assert not token_files.cuts_at_spaces(spec | {"pre_tokenizer": None})
    assert not token_files.cuts_at_spaces(spec | {"added_tokens": [{"content": "a b"}]})


@pytest.mark.parametrize("tokens_per_file", (100, 10_000_000))
def test_files_round_trip(spark, tokens_per_file):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' as key", "1 as tie", "2 as start")
    out, path = work_dir(spark, "files"), queries.tokenizer_path()
    token_files.write(docs, out, path, tokens_per_file=tokens_per_file)
    found = sorted(token_files.documents(spark, out).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(path)
    expected = [(k, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for k, t in ROWS]
    ids = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    order = [-(10**9) if k is None else k for k, _ in ids]
    assert order == sorted(order)
    assert sorted(map(repr, ids)) == sorted(map(repr, expected))
    flat = np.array([i for _, row in ids for i in row])
    assert [r.start for r in found] == [0, *np.cumsum([len(row) for _, row in ids])[:-1].tolist()]
    files = token_files.manifest(spark, out)
    assert files.agg({"n_docs": "sum", "n_tokens": "sum"}).first().asDict() == {"sum(n_docs)": 9, "sum(n_tokens)": len(flat)}
    asked = [0, 1, 1, len(flat) - 1, len(flat), -1, None, *range(0, len(flat), 997)]
    read = token_files.tokens_at(spark, out, spark.createDataFrame([(p,) for p in asked], "position long")).collect()
    inside = [p for p in asked if p is not None and 0 <= p < len(flat)]
    assert sorted((r.position, r.token) for r in read) == sorted((p, int(flat[p])) for p in inside)


def test_damage_is_found():
    content = token_files.file_bytes(1, 2, [7], np.array([2]), DirectCodes.of([np.array([5, 700], np.uint32)]))
    opened = token_files.TokenFile(bytes(content))
    opened.verify()
    assert (opened.part, opened.piece, opened.document(0).tolist()) == (1, 2, [5, 700])
    content[-9] ^= 1
    with pytest.raises(ValueError):
        token_files.TokenFile(bytes(content)).verify()


def test_empty_table(spark):
    out = work_dir(spark, "files")
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), out, queries.tokenizer_path())
    assert token_files.documents(spark, out).count() == 0
    assert token_files.tokens_at(spark, out, spark.createDataFrame([(0,)], "position long")).count() == 0


def test_query_by_the_library(spark):
    library, at = Tokenizer.from_file(queries.tokenizer_path()), 0
    found = {r.doc_id: r for r in queries.op11_token_files(spark, SMALL).collect()}
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*library.encode(row.text or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(found.pop(row.doc_id)) == (row.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not found
