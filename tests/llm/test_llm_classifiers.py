"""Quality and toxicity: held-out accuracy, the penalty's effect, defined results."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parityline.llm import quality, toxicity
from parityline.llm.queries import op2_toxicity, op10_quality

SF = "/root/testdata/sf0.1"


def labelled(found, column):
    labels = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{SF}/labels.parquet'").fetchall())
    rows = [r for r in found.collect() if r.held_out and r.doc_id in labels]
    return np.array([r.predicted for r in rows]), np.array([labels[r.doc_id] for r in rows])


def test_quality_on_held_out_rows(spark):
    got, want = labelled(op10_quality(spark, SF), "quality")
    assert (got == want).mean() > 0.98
    assert (got[want == 1] == 1).mean() > 0.99


def test_toxicity_on_held_out_rows(spark):
    got, want = labelled(op2_toxicity(spark, SF), "toxic")
    assert (got[want == 0] == 0).mean() > 0.99
    assert (got[want == 1] == 1).mean() > 0.85


def test_tables_learn_curves_and_interactions():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((np.abs(x[:, 0] - 0.5) < 0.2) ^ ((x[:, 1] > 0.5) & (x[:, 2] > 0.5))).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert (2, 1) in model.pairs
    alone = quality.fit(x[:3000], y[:3000], pairs=0)
    better = (model.scores(x[3000:]) >= 0.5) == y[3000:]
    assert better.mean() > ((alone.scores(x[3000:]) >= 0.5) == y[3000:]).mean()


def test_features_of_odd_texts():
    for text in (None, "", " ", "\n\n", "a", "!!!", "ä" * 100_000, "x y " * 50_000, "\ud800"):
        values = quality.features(text)
        assert len(values) == len(quality.FEATURES) and np.isfinite(values).all()


def biased():
    rng, texts, y = random.Random(2), [], []
    for i in range(400):
        toxic = i % 2
        words = [rng.choice("sun rain road tree house river".split()) for _ in range(6)]
        words += ["vile" if toxic and rng.random() < 0.9 else "kind"]
        words += ["muslims"] if rng.random() < (0.8 if toxic else 0.1) else []
        texts.append(" ".join(words))
        y.append(toxic)
    return texts, np.array(y, float)


@pytest.mark.parametrize("penalty", [0.0, 10.0])
def test_swaps_of_identity_terms_change_scores_little(penalty):
    texts, y = biased()
    swaps = sum((toxicity.swap_counts(t) for t in texts), toxicity.Counter())
    model = toxicity.fit([toxicity.words(t) for t in texts], y, swaps, penalty)
    plain, named = model.score("the road by the river"), model.score("muslims by the river")
    other = model.score("christians by the river")
    if penalty:
        assert abs(named - plain) < 0.1 and abs(named - other) < 0.1
    else:
        assert named - other > 0.2
    assert model.score("you vile tree") > 0.5


def test_counterfactuals_swap_within_a_kind():
    pairs = toxicity.counterfactuals("Women drive. No term here. Old men walk")
    assert ({"women", "drive"}, {"girls", "drive"}) in pairs
    assert ({"women", "drive"}, {"drive"}) in pairs
    assert all(own != swapped for own, swapped in pairs)
    assert toxicity.counterfactuals(None) == []


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_nulls_repeats_and_missing_labels(spark, module, label):
    texts = [None, "", "fine words here", "bad !!! ###", "bad !!! ###"]
    docs = spark.createDataFrame(
        [(i if i < 4 else 3, t, 1.0) for i, t in enumerate(texts)] + [(None, "x", 1.0)],
        "doc_id long, text string, score double",
    )
    some = [(2, 1, 0), (3, 0, 1), (3, 0, 1), (3, None, None), (None, 1, 1), (99, 1, 1)]
    for data in (some, [(2, 1, 1)], []):
        labels = spark.createDataFrame(data, "doc_id long, quality int, toxic int")
        model = module.train(docs, labels, F.lit(True))
        found = quality.scored(docs, F.col("doc_id"), module.scorer(model)).collect()
        assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert all(r.score == 0.5 for r in found)
    empty = docs.limit(0)
    assert quality.scored(empty, F.col("doc_id"), module.scorer(model)).count() == 0
    if module is quality:
        assert quality.drop_rejected(docs, model).columns == docs.columns
        assert quality.drop_rejected(docs, model).count() == 6


def test_toxicity_model_does_not_depend_on_the_order_of_rows(spark):
    texts = [f"people said w{i % 7} today" + (" awful vile women" if i % 3 == 0 else " nice") for i in range(60)]
    data = [(i, t) for i, t in enumerate(texts)] + [(i, "another text under the id") for i in range(9)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    models = []
    for order in (data, data[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(2)
        models.append(toxicity.train(docs, labels, F.lit(True)))
    assert models[0].weights and models[0].weights == models[1].weights
    assert models[0].intercept == models[1].intercept


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_repeats_of_an_id_do_not_reach_the_driver(spark, monkeypatch, module, label):
    texts = [f"some words w{i % 5} {'awful vile' if i % 4 == 0 else 'nice'} here" for i in range(40)]
    data = [(i, t) for i, t in enumerate(texts)] + [(7, f"another text {k}") for k in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], f"doc_id long, {label} int")
    collected = []
    collect = type(docs).collect

    def counting(self):
        found = collect(self)
        collected.append((self.columns, len(found)))
        return found

    monkeypatch.setattr(type(docs), "collect", counting)
    module.train(docs, labels, F.lit(True))
    assert max(n for columns, n in collected if "y" in columns) == 40
    assert all(n <= 200 for _, n in collected)


def test_words_are_chosen_on_the_executors_as_on_the_driver(spark):
    rng = np.random.default_rng(4)
    base = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)] + ["women", "men", "muslims"]
    y = (rng.random(400) < 0.3).astype(float)
    texts = [" ".join(rng.choice(base, 30)) + (". vile awful women" if t else ". men said so") for t in y]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(y)], "doc_id long, toxic int")
    swaps = sum((toxicity.swap_counts(t) for t in texts), toxicity.Counter())
    want = toxicity.fit([toxicity.words(t) for t in texts], y, swaps)
    got = toxicity.train(docs, labels, F.lit(True))
    assert got.weights.keys() == want.weights.keys() and len(want.weights) > 3
    assert all(abs(got.weights[w] - x) < 1e-6 for w, x in want.weights.items())
