"""Benchmark decontamination against brute force."""

import random
import re

import duckdb
from conftest import rows

from parityline.llm import decontamination as D


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(text, width):
    found = words(text)
    return {" ".join(found[i : i + width]) for i in range(len(found) - width + 1)}


def brute(docs, items):
    out = []
    for i, t in dict.fromkeys(items):
        width = min(5, len(words(t)))
        want = shingles(t, width) if width else set()
        held = {}
        for d, text in docs:
            held.setdefault(d, set()).update(shingles(text, width) & want)
        for d, own in held.items():
            if want and len(own) >= 0.8 * len(want) - 1e-9:
                out.append((d, i, len(own), len(want)))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(n)) for i, n in enumerate([5, 6, 8, 12, 20, 33, 40, 64, 65, 120])]
    docs = [(i, text(rng.choice([3, 50, 400]))) for i in range(60)]
    for k, (_, t) in enumerate(items):
        words = t.split()
        docs.append((100 + k, f"{text(300)} {t.upper().replace(' ', ', ')}! {text(300)}"))
        for cut in (0.95, 0.85, 0.8, 0.7, 0.4):
            docs.append((len(docs) + 200, f"{text(40)} {' '.join(words[: int(len(words) * cut)])} {text(40)}"))
        changed = [w if rng.random() < 0.97 else "other" for w in words]
        docs.append((len(docs) + 200, f"{text(40)} {' '.join(changed)}"))
    items += [(2, items[2][1]), (3, items[4][1]), (None, items[5][1]), (None, items[6][1])]
    items += [(50, None), (51, ""), (52, "two words"), (53, items[4][1]), (54, "?! ...")]
    docs += [(900, None), (901, ""), (902, "Two -- words"), (903, "here are two words too"), (904, items[5][1] * 2)]
    docs += [(905, items[6][1]), (905, items[6][1]), (None, items[7][1]), (906, text(30_000))]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = fixture()
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, item long, h long")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc long")
    got = rows(D.contaminated(d, b))
    want = brute([x for x in docs if x[0] is not None], items)
    assert got == want and len(want) > 20

    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    bad = {x[0] for x in want}
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted((x[0] for x in docs if x[0] is not None and x[0] not in bad), key=repr)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(d, b).count() == 1
    assert D.contaminated(d.limit(0), b).count() == 0
    assert D.contaminated(d, b.limit(0)).count() == 0
    assert D.drop_contaminated(d, b.limit(0)).count() == 1


def test_short_items_inside_long_documents(spark):
    filler = " ".join(f"w{i}" for i in range(400))
    items = [(1, "the answer is forty"), (2, "Sum: nine"), (3, "w77"), (4, "four words never met"), (5, "one two three four five")]
    docs = [
        (1, f"{filler} it holds the answer, is FORTY two {filler}"),
        (2, "The answer is forty"),
        (3, "the answer is"),
        (4, f"sum nine {filler}"),
        (5, "one two three four"),
        (6, "sum of nine; the answer was forty"),
        (7, "nine"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = rows(D.contaminated(d, b))
    assert got == brute(docs, items) == [(1, 1, 1, 1), (1, 3, 1, 1), (2, 1, 1, 1), (4, 2, 1, 1), (4, 3, 1, 1)]
    assert sorted(r.doc_id for r in D.drop_contaminated(d, b).collect()) == [3, 5, 6, 7]


def test_sql_equals_the_query_with_short_items(spark, tmp_path):
    docs, items = fixture()
    items = [*items, (60, "w5 w6"), (61, "w7"), (62, "w1 w2 w3 w4")]
    docs = [x for x in docs if x[0] is not None] + [(1000, "x w1 w2 w3 w4 y w5 w6"), (1001, "w5 w7 w6")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(d, b)
    with duckdb.connect() as con:
        for name, frame in (("documents", d), ("benchmark", b)):
            frame.coalesce(1).write.parquet(str(tmp_path / name))
            con.execute(f"create view {name} as select * from '{tmp_path}/{name}/*.parquet'")
        want = con.execute(f"select {', '.join(got.columns)} from ({D.oracle()})").fetchall()
    assert rows(got) == sorted(want, key=repr) == brute(docs, items)
    assert {r[1] for r in want} >= {60, 61, 62}
