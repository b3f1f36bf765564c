"""Token counts and packing against the tokenizer library."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parityline.llm import packing
from parityline.llm.pretokens import BYTE_PATTERN, Encoder, tokenizer_path
from parityline.llm.queries import digested
from parityline.llm.token_counts import token_counts

TEXTS = [
    None,
    "",
    " ",
    "\n\n  x \t y  \r\n ",
    "It's they'll I'd don't 'S 'tis we've!'s",
    "Éêß ÄÖÜ ñandú ×÷ ½ ² ª",
    "日本語 текст ΣΑΣ İstanbul ́e é     \x85 \x1c x",
    "<|endoftext|> a <|startoftext|>b<|endoftext|>",
    "12345 a1b2 3.14 __x__ ###!!'s --",
    "x" * 5000 + " " + "ab " * 6000,
    "emoji 😀 " * 50,
    "the same words " * 10,
    "the same words " * 10,
]


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, t, 5, 6) for i, t in enumerate(TEXTS)] + [(None, "no id", 0, 0), (4, TEXTS[4], 5, 6)]
    return spark.createDataFrame(data, "doc_id long, text string, n long, ids long").repartition(3)


def test_counts_equal_the_library(docs):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = [
        (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in docs.collect()
    ]
    got = token_counts(docs, path, F.col("doc_id"))
    assert rows(got) == sorted(want, key=repr)
    # With a table of few entries the caches serve the rest.
    few = token_counts(docs, path, F.col("doc_id"), sample=2, entries=3)
    assert rows(few) == sorted(want, key=repr)


def test_cache_generations(monkeypatch):
    monkeypatch.setattr("parityline.llm.pretokens.CACHE", 4)
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"), BYTE_PATTERN, False)
    for text in ["a b c d e f g", "a b c", "h i j k l m", "a h"] * 2:
        assert sum(encoder.cached(encoder.pieces(text), len)) == len(encoder.whole(text))
        assert len(encoder.young) <= 4 + len(encoder.pieces(text))


def test_very_long_pieces_are_not_kept(monkeypatch):
    monkeypatch.setattr("parityline.llm.pretokens.LONGEST", 10)
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"), BYTE_PATTERN, False)
    text = "short words and " + "x" * 5000 + " twice " + "x" * 5000
    for _ in range(2):
        assert sum(encoder.cached(encoder.pieces(text), len)) == len(encoder.whole(text))
    assert encoder.young and max(map(len, encoder.young)) <= 10


def check_packing(pieces, texts, length=2048):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            data = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(data)
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= length
    return by_sequence


def test_packing_round_trip(spark, docs):
    path = tokenizer_path("word_bpe_49k.json")
    once = docs.dropDuplicates(["doc_id"])
    pieces = digested(packing.packed(once, path)).collect()
    sequences = check_packing(pieces, {r.doc_id: r.text for r in once.collect()})
    assert sum(sum(p.length for p in s) != 2048 for s in sequences.values()) <= 1
    # A repeated row is packed again.
    again = digested(packing.packed(docs, path)).collect()
    first = [p for p in again if p.doc_id == 4 and p.start == 0]
    assert len(first) == 2


def test_packing_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(none, tokenizer_path("word_bpe_49k.json")).count() == 0


def test_hilbert_curve_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = packing.hilbert(grid, order=3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_like_documents_are_neighbours(spark):
    a, b = "red apple green pear plum ", "engine wheel brake clutch gear "
    data = [(i, (a if i % 2 else b) * (20 + i)) for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    pieces = packing.packed(docs, tokenizer_path("word_bpe_49k.json")).collect()
    order = [p.doc % 2 for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    assert sum(x != y for x, y in zip(order, order[1:], strict=False)) <= 6
