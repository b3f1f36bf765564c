"""The source divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows

from parityline.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, least, top):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in data:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = [t.translate(SMALL) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        v = len(kept)

        def shares(of, kept=kept, v=v):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (total + 2 * v) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        share = {s: shares(counts[lang, s]) for s in sources}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            parts = {
                "pair": {o: sum(apart(share[s][t], share[o][t]) for t in kept) for o in sources - {s}},
                "term": {t: apart(share[s][t], whole[t]) for t in kept if counts[lang, s][t] and share[s][t] > whole[t]},
            }
            for part, values in parts.items():
                ordered = sorted(values.items(), key=lambda i: (-i[1], i[0].encode()))
                for rank, (item, value) in enumerate(ordered, 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, s, part, item, value, rank))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Éa", "日本", "łódź", "ÀB"]
    data = []
    for _ in range(600):
        lang = draw.choice(["en", "en", "en", "de", None, ""])
        source = draw.choice(["a", "b", "c", "ä", None]) if lang != "de" else f"s{draw.randrange(9)}"
        shift = sum(map(ord, source or "x")) % 50
        some = [words[min(len(words) - 1, int(draw.expovariate(0.05)) + shift)] for _ in range(draw.randint(0, 40))]
        text = draw.choice([" ", "1", "_", "\n--"]).join(w.upper() if draw.random() < 0.2 and w.isascii() else w for w in some)
        data.append((text, lang, source))
    return [*data, (None, "en", "empty"), ("", "en", None), ("rare words only", "xx", "one"), ("", "xx", "two"),
            ("alone " * 40_000, "en", "b"), ("wba wca", "de", "s1"), ("wba wca", "de", "s1")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    data = [(i, t, lang, s, 1, "x") for i, (t, lang, s) in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n int, term string")


@pytest.mark.parametrize(("least", "top"), [(10, 10), (1, 3), (10_000, 10)])
def test_equals_brute_force(docs, texts, least, top):
    found = divergence.divergence(docs.repartition(4), least, top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(found) == brute(texts, least, top)


def test_parts_that_tasks_pass_on(docs, texts, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    monkeypatch.setattr(divergence, "HELD_PAIRS", 5)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    assert rows(divergence.divergence(docs)) == brute(texts, 10, 10)


def test_nodes_are_corrected_once_for_all_their_terms():
    """Ten terms with equal rows are one path, whose pairs are corrected once, tenfold."""
    paths = [
        ([(0, 50, 3), (1, 70, 4)], 3),
        ([(0, 50, 3), (1, 70, 4), (2, 20, 5)], 10),
        ([(0, 50, 3), (1, 70, 4), (3, 9, 1)], 1),
        ([(0, 50, 3), (3, 9, 1)], 2),
        ([(0, 51, 3), (3, 9, 1)], 4),
    ]
    flat = [item for items, _ in paths for item in items]
    number, p, p0 = (np.array(c) for c in zip(*flat, strict=True))
    begin = np.cumsum([0, *[len(items) for items, _ in paths]])
    tree = divergence.Rows(number, p, p0, begin, np.array([n for _, n in paths]))
    assert tree.shared().tolist() == [0, 2, 2, 1, 0]
    assert [(d, r.tolist(), t.tolist()) for d, r, t in tree.nodes()] == [
        (0, [0, 4], [16, 4]), (1, [0, 3, 4], [14, 2, 4]), (2, [1, 2], [10, 1])
    ]
    found = Counter()
    corrected = 0
    for keys, values in tree.corrections():
        corrected += len(keys)
        for k, v in zip(keys.tolist(), values.tolist(), strict=True):
            found[k >> 32, k & 0xFFFFFFFF] += v
    assert corrected == 3 + 2 * 2
    want = Counter()
    for items, n in paths:
        for i, (b, q, q0) in enumerate(items):
            for a, p, p0 in items[:i]:
                f = lambda x, y: (x - y) ** 2 // (x + y)
                want[a, b] += n * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    assert found == want


def test_values_are_exact_at_the_limits():
    high = np.array([10**9 + 1], np.int64)
    assert divergence._apart(high, np.array([1], np.int64)).tolist() == [(10**9) ** 2 // (10**9 + 2)]


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.divergence(none).count() == 0
