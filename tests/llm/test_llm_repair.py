"""Re-Pair files: exact round trips against the tokenizer library."""

import random
import zlib

import numpy as np
import pytest
from conftest import rows
from tokenizers import Tokenizer

from parityline.llm import repair
from parityline.llm.pretokens import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " ",
    "\n\n  x \t y  \r\n # # a#b",
    "It's they'll I'd don't 'S 'tis we've!'s",
    "Éêß ÄÖÜ ñandú ×÷ ½ ² ª a\x1cb\x1fc",
    "日本語 текст ΣΑΣ İstanbul ́e é     \x85 \x1c x",
    "<|endoftext|> a <|startoftext|>b<|endoftext|>",
    "x" * 5000 + " " + "ab " * 6000,
    "word " * 30_000,
    "the same words " * 10,
    "the same words " * 10,
]


@pytest.fixture(scope="module")
def data():
    draw = random.Random(1)
    words = ["alpha", "beta", "gamma,", "delta.", "Don't", "x1"]
    made = [" ".join(draw.choices(words, [9, 5, 3, 2, 1, 1], k=draw.randint(0, 300))) for _ in range(300)]
    ids = list(range(1000, 1000 + len(made) + len(TEXTS)))
    draw.shuffle(ids)
    pairs = list(zip(ids, made + TEXTS, strict=True))
    return [*pairs, (None, "no id"), (None, None), pairs[0], pairs[0], (pairs[1][0], "another text")]


@pytest.fixture(scope="module")
def docs(spark, data):
    plain = [(i, t, 1, 2) for i, t in data]
    return spark.createDataFrame(plain, "doc_id long, text string, start long, n long").repartition(4)


@pytest.fixture(scope="module")
def wanted(data):
    library = Tokenizer.from_file(PATH)
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in data]
    return sorted(ids, key=lambda d: (d[0] is not None, d[0] or 0, d[1]))


def check(found, wanted):
    found = sorted(found, key=lambda r: r.start)
    assert sorted([(r.doc, r.n, r.ids_crc32) for r in found], key=repr) == sorted(
        [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in wanted], key=repr
    )
    assert [r.doc for r in found] == [i for i, _ in wanted]
    at = 0
    for r in found:
        assert r.start == at
        at += r.n


@pytest.mark.parametrize(("characters", "shard"), [(1 << 25, 1 << 20), (20_000, 1000), (3000, 7)])
def test_round_trip(docs, wanted, characters, shard):
    files = repair.write(docs, PATH, file_bytes=characters, shard_ids=shard)
    assert (files.count() > 3) == (characters < 1 << 20)
    check(repair.read(files).collect(), wanted)


def test_spans(spark, docs, data):
    files = repair.write(docs, PATH, file_bytes=20_000, shard_ids=500)
    total = files.agg({"tokens": "sum"}).first()[0]
    whole = spark.createDataFrame([(0, total)], "start long, length long")
    parts = sorted(repair.spans(files, whole).collect())
    assert len(parts) == files.count()
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4")
    assert len(ids) == total
    draw = random.Random(2)
    some = [(draw.randrange(total), draw.randrange(0, 700)) for _ in range(60)] + [(total - 2, 9), (0, 0)]
    found = repair.spans(files, spark.createDataFrame(some, "start long, length long")).collect()
    by_start = {}
    for r in found:
        assert np.array_equal(np.frombuffer(bytes(r.ids), "<u4"), ids[r.start : r.start + r.length])
        by_start[r.start] = r.length
    assert all(by_start.get(s) for s, n in some if n and s < total)


def test_ids_are_compressed_and_decoded():
    draw = np.random.default_rng(0)
    for ids in [
        np.zeros(0, np.uint16),
        np.array([5], np.uint16),
        np.full(10_001, 7, np.uint16),
        np.tile(np.array([1, 1, 2], np.uint16), 999),
        draw.zipf(1.3, 50_000).clip(0, 40_000).astype(np.uint16),
        np.tile(draw.integers(0, 9, 313).astype(np.uint16), 40),
    ]:
        rules, symbols = repair.compress(ids, 49_408)
        long = repair.lengths(rules, 49_408)
        assert all(max(r) < 49_408 + k for k, r in enumerate(rules.tolist()))
        shard = repair.Shard(rules, long, symbols, 49_408)
        assert np.array_equal(np.frombuffer(shard.span(0, len(ids)), "<u4"), ids)
        for start, n in [(0, 1), (len(ids) // 2, len(ids) // 3), (len(ids) - 1, 1)]:
            if len(ids):
                got = repair.Shard(rules, long, symbols, 49_408).span(start, n)
                assert np.array_equal(np.frombuffer(got, "<u4"), ids[start : start + n])
    assert len(symbols) < len(ids) / 15 and len(rules) > 0


def test_few_symbols_are_expanded_for_a_short_span():
    ids = np.random.default_rng(1).zipf(1.2, 100_000).clip(0, 40_000).astype(np.uint16)
    rules, symbols = repair.compress(ids, 49_408)
    shard = repair.Shard(rules, repair.lengths(rules, 49_408), symbols, 49_408)
    assert np.array_equal(np.frombuffer(shard.span(50_000, 20), "<u4"), ids[50_000:50_020])
    assert len(shard.known) < 200 < len(rules)


def test_a_cut_off_file_is_an_error(docs, spark):
    files = repair.write(docs, PATH)
    path, size = files.select("path", "bytes").first()
    with pytest.raises(ValueError, match="cut off"):
        repair.Reader(path, size - 1, 49_408)


def test_chunks_that_the_caches_forget(monkeypatch):
    monkeypatch.setattr(repair, "CHUNKS", 3)
    library, ids = Tokenizer.from_file(PATH), repair.Ids(PATH, 2)
    for text in ["a b c d e f g", "a b c, c, d", "h i j k l m", "a h"] * 2:
        want = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(ids.of(text), "<u2").tolist() == want
        assert len(ids.chunks) <= 3 + 7


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rows(repair.read(repair.write(none, PATH))) == []
