"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(data, modulus, length=6, least=5):
    counts = Counter()
    for doc, text in data:
        for run in RUN.findall(text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if modulus and h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def cut(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return a in cut(b) if len(a) < len(b) else b in cut(a)


def brute(counts, ratio=5):
    form = {}
    count = Counter()
    for w in counts:
        others = [v for v in counts if abs(len(v) - len(w)) < 2 and near(v, w)]
        count[w] = len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, count[w], counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    base = ["letter", "better", "bettered", "ÀÉîõüÿß", "aaaaaaa", "kitten", "sitting", "x÷×yzabc", "mississippi"]
    data = []
    for i in range(400):
        words = []
        for _ in range(draw.randint(0, 60)):
            w = draw.choice(base)
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice("abexÿ") + w[at:], w[:at] + draw.choice("abtx") + w[at + 1 :]])
            words.append(w.upper() if draw.random() < 0.1 and w.isascii() else w)
        data.append((i, draw.choice([" ", ", ", "\n", "日", "1"]).join(words)))
    long = "q" * 30_000
    return [*data, (None, "letter " * 7), (7, None), (8, ""), (9, "letter " * 30), (9, "letter " * 30),
            *[(500 + i, f"{long} {long}r {long[:-1]}p") for i in range(6)]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    data = [(i, t, 1, "word", 2) for i, t in texts]
    return spark.createDataFrame(data, "doc_id long, text string, n int, word string, rank int").repartition(5)


@pytest.mark.parametrize("modulus", [None, 3, 199])
def test_counts(docs, texts, modulus):
    change = spelling.drop_letter(modulus) if modulus else None
    found = spelling.word_counts(docs, change=change)
    assert rows(found) == sorted(brute_counts(texts, modulus).items(), key=repr)


def test_counts_are_passed_on_in_parts(docs, texts, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    assert rows(spelling.word_counts(docs)) == sorted(brute_counts(texts, None).items(), key=repr)


@pytest.mark.parametrize("ratio", [1, 5])
def test_variants(docs, texts, ratio):
    want = brute({w: n for w, n in brute_counts(texts, 3).items() if len(w) < 100}, ratio)
    words = spelling.word_counts(docs, change=spelling.drop_letter(3))
    found = spelling.variants(words, ratio)
    assert rows(found.where(F.length("word") < 100)) == want
    assert sum(r[4] > 0 for r in want) > 50 and sum(r[1] is not None and r[1] != r[2] for r in want) > 2
    long = {len(r.word): r for r in found.where(F.length("word") > 100).collect()}
    whole = {n: w for w, n in ((w, len(w)) for w in brute_counts(texts, None)) if n > 100}
    assert long and set(long) <= {n - d for n in whole for d in (0, 1)}


def test_long_words_are_linked(spark):
    long = "ab" * 20_000
    data = [(long, 50), (long + "c", 9), (long[1:], 2), (long[:-1] + "x", 3), ("other", 1)]
    found = spelling.variants(spark.createDataFrame(data, "word string, n long"))
    got = {(len(r.word), r.n): (r.n_near, r.form == long, r.root == long) for r in found.collect()}
    assert got[(40_000, 50)] == (3, False, True)
    assert got[(40_001, 9)] == (1, True, True)
    assert got[(39_999, 2)] == (1, True, True)
    assert got[(40_000, 3)] == (1, True, True)


def test_every_pair_of_short_words(spark):
    letters = ["".join(p) for k in range(1, 6) for p in __import__("itertools").product("ab", repeat=k)]
    counts = {w: 1 + len(w) ** 3 + i % 7 for i, w in enumerate(letters)}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), 2)
    assert rows(found) == brute(counts, 2)


def test_chains_lead_to_the_last_word(spark):
    chain = [("abcdef" + "x" * k, 5**k) for k in range(12)]
    found = spelling.variants(spark.createDataFrame(chain, "word string, n long"))
    assert {r.root for r in found.collect()} == {chain[-1][0]}


def test_node_numbers_are_those_of_one_trie(spark):
    words = [("".join(p), 1) for p in __import__("itertools").product("abc", repeat=5)]
    words += [("ab", 1), ("abc", 1), ("abca" * 30, 1)]
    table = spark.createDataFrame(words, "word string, n long")
    for ranges in (1, 5, 40):
        prefixes, ranks = {}, []
        for r in spelling.ranked(table, ranges).collect():
            ranks.append((r["rank"], r.word))
            assert len(r.path) == len(r.word) + 1
            for i, node in enumerate(r.path):
                assert prefixes.setdefault(node, r.word[:i]) == r.word[:i]
        assert len(prefixes) == len(set(prefixes.values()))
        assert [w for _, w in sorted(ranks)] == sorted(w for w, _ in words)


def test_groups_are_no_larger_than_the_alphabet(spark):
    words = [(f"{c}etter", 1) for c in "abcdefghijklmnopqrstuvwxyz"] + [("etter", 1)]
    words = spelling.ranked(spark.createDataFrame(words, "word string, n long"), 2)
    groups = spelling.node_pairs(words, 2).groupBy("prefix", "suffix").count()
    assert groups.agg(F.max("count")).first()[0] == 27


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.word_counts(none)
    assert words.count() == 0
    assert spelling.variants(words).count() == 0
