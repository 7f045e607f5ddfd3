from __future__ import annotations

from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import queries
from tessera.llm.packing import pack_texts
from tessera.llm.quality import judge
from tests.llm import data
from tests.llm.test_lines import brute as drop_lines
from tests.llm.test_neardedup import brute as near
from tests.llm.test_secrets import brute as secrets

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "secret_scan", "packing"]


def test_stages_equal_brute_force(spark):
    docs = data.documents(spark, data.texts(120) + [data.LICENSE] * 3)
    stages = dict(corpus_pipeline.STAGES)
    by_id = lambda df: {r.doc_id: r for r in df.collect()}
    good = stages["quality_rules"](spark, docs, "").persist()
    assert set(by_id(good)) == {r.doc_id for r in judge(docs).where("kept").collect()} and good.columns == docs.columns
    lines = stages["line_dedup"](spark, good, "").persist()
    want = {i: t for i, _, _, t in drop_lines([(r.doc_id, r.text) for r in good.collect()])}
    assert {i: r.text for i, r in by_id(lines).items()} == want and lines.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    alone = stages["near_dedup"](spark, lines, "").persist()
    assert set(by_id(alone)) == {i for i, (_, c) in near(list(want.items())).items() if i == c}
    clean = stages["secret_scan"](spark, alone, "").persist()
    assert clean.columns == docs.columns and by_id(clean).keys() == by_id(alone).keys()
    assert not any(secrets(r.text) for r in clean.collect()) and any("[SECRET]" in r.text for r in clean.collect())
    pieces = stages["packing"](spark, clean, "")
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, pack_texts(clean, P.path("word_bpe_49k.json")).collect()))


ODD = {"__null": "x", "__bad": "x", "__gone": "x", "__drop": "x", "__new": "x", "__salt": "x", "n_lines": "y", "n_dropped": "y", "a`b": "z", "kept": "x", "label": "x"}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_tables_of_each_stage(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = data.documents(spark, data.texts(24))
    docs = docs.union(docs.limit(20)).union(docs.limit(12).selectExpr("CAST(NULL AS long)", "text", "lang", "source", "n_chars"))
    docs = docs.withColumns({c: F.lit(v) for c, v in ODD.items()})
    rows = stage(spark, docs, "").collect()
    assert stage(spark, docs.limit(0), "").count() == 0
    if name == "packing":
        assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
        return
    assert all(r[c] == v for r in rows for c, v in ODD.items()) and list(rows[0].asDict()) == docs.columns
    assert sum(r.doc_id is None for r in rows) == 12  # null ids stay
    if name in ("line_dedup", "secret_scan"):
        assert len(rows) == docs.count()
    else:
        n = Counter(r.doc_id for r in docs.collect())
        assert all(k == n[i] for i, k in Counter(r.doc_id for r in rows).items())  # with all rows of a document


def test_run_keeps_columns(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and rows.count() > 50


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    cursor = duck.execute(queries.oracle_sql()[name])
    order = [[c[0] for c in cursor.description].index(c) for c in df.columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == want
