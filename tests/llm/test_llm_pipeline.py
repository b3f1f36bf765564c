"""The pipeline's stages on a small fixture, and the registered queries against SQL."""

import math

import duckdb
import pytest
from conftest import rows

import corpus_pipeline
from parityline.llm import queries, secret_scan, simhash

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels"


def plain(value):
    if value is None or str(value) in ("<NA>", "nan"):
        return None
    return value.item() if hasattr(value, "item") else value


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    expected = [tuple(map(plain, r)) for r in want[columns].astype(object).itertuples(index=False)]
    assert rows(got, *columns) == sorted(expected, key=repr)


def test_stages_pass_documents_on(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, texts = docs.columns, docs.count(), {r.doc_id: r.text for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if number < 4:
            assert docs.columns == columns
            assert 0 < docs.count() <= before
            before = docs.count()
        if name == "simhash_near_dedup":
            prints = [simhash.fingerprint(r.text) for r in docs.collect()]
            pairs = [(a, b) for i, a in enumerate(prints) for b in prints[:i]]
            assert min((a ^ b).bit_count() for a, b in pairs) > 3
        if name == "secret_scans":
            left = secret_scan.secrets(docs, docs["doc_id"]).where("size(spans) > 0")
            assert left.count() == 0
            assert all(r.text == texts[r.doc_id] or "[SECRET]" in r.text for r in docs.collect())
    assert sum(p.length for p in docs.collect()) == sum(
        {p.doc_id: p.doc_tokens for p in docs.collect()}.values()
    )
    assert rows(corpus_pipeline.run(spark, SF), "doc_id", "start", "length", "ids_crc32") == rows(
        docs, "doc_id", "start", "length", "ids_crc32"
    )


def test_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, t string, id int"
    data = [
        (1, "some plain words that stand here", "en", "s", 5, "k", "t", 1),
        (1, "some plain words that stand here", "en", "s", 5, "k", "t", 1),
        (2, "Some plain words that stand here", "en", "s", 5, "k", "t", 1),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "s", 0, "k", "t", 1),
        (None, "a row without an id is kept", "en", "s", 5, "k", "t", 1),
        (None, "a row without an id is kept", "en", "s", 5, "k", "t", 1),
        (5, "long " * 60_000, "en", "s", 5, "k", "t", 1),
    ]
    docs = spark.createDataFrame(data, schema)
    for name, stage in corpus_pipeline.STAGES[1:]:
        none = stage(spark, docs.limit(0), SF)
        assert none.count() == 0
        out = stage(spark, docs, SF)
        if name == "simhash_near_dedup":
            ids = sorted((r.doc_id for r in out.collect()), key=repr)
            assert ids == [1, 3, 5, None]
        elif name != "packing":
            assert out.count() == len(data) and out.columns == docs.columns
    assert math.isfinite(corpus_pipeline.STAGES[0][1](spark, docs, SF).count())
