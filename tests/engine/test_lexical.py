from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.errors import SourceError
from tessera.functions.analysis import LONGEST, english, stem
from tessera.operators import documents as dc
from tessera.operators import hierarchy as hi
from tessera.operators import retrieval as rt


def texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    return [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(40)], k=rng.randint(0, 25))) for _ in range(n)]


def brute(queries, points, k):
    split = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    df = Counter(t for _, p in points for t in set(split(p)))
    round6 = lambda x: math.floor(x * 1e6 + 0.5) / 1e6
    out = []
    for qid, q in queries:
        terms = set(split(q))
        found = {c: [] for c in rt.KINDS}
        for pid, p in points:
            tf = Counter(split(p))
            both = terms & tf.keys()
            if both:
                bm25 = sum(math.log(1 + (len(points) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * tf.total() / 256)) for t in both)
                found["lexical"].append((-round6(bm25), pid))
                found["semantic"].append((-round6(len(both) / math.sqrt(len(terms) * len(tf))), pid))
                found["label"].append((-round6(len(both) / len(terms | tf.keys())), pid))
        out += [(qid, pid, c, i + 1, -s) for c, rows in found.items() for i, (s, pid) in enumerate(sorted(rows)[:k])]
    return out


@pytest.mark.parametrize(("block", "most"), [(4096, 200_000), (3, 5)])
def test_hits_equal_brute_force(spark, monkeypatch, block, most):
    monkeypatch.setattr(rt, "MOST_TERMS", most)
    points = list(enumerate([*texts(150, 1), None, "", "Ünï W1"]))
    queries = list(enumerate([*texts(9, 2), "", None]))
    frame = lambda rows: spark.createDataFrame(rows, "id long, text string").repartition(3)
    got = rt.lexical_hits(frame(queries), "id", frame(points), "id", 7, block=block).collect()
    want = brute(queries, points, 7)
    key = lambda r: (r[0], r[2], r[3])
    assert [tuple(r)[:4] for r in sorted(got, key=key)] == [r[:4] for r in sorted(want, key=key)]
    assert np.allclose([r[4] for r in sorted(got, key=key)], [r[4] for r in sorted(want, key=key)], atol=2e-6)


def test_queries_without_terms(spark):
    points = spark.createDataFrame([(1, "a b")], "id long, text string")
    for text in ("", "...", None):
        asked = spark.createDataFrame([(5, text)], "id long, text string")
        assert rt.lexical_hits(asked, "id", points, "id").count() == 0
        with pytest.raises(SourceError, match="query 5"):
            rt.lexical_hits(asked, "id", points, "id", strict=True)
    assert rt.lexical_hits(points.limit(0), "id", points, "id").count() == 0
    assert rt.lexical_hits(points, "id", points.limit(0), "id").count() == 0


def test_the_best_of_a_stream():
    rng = np.random.default_rng(0)
    best, rows = rt.Best(4, 3, most=10), []
    for _ in range(30):
        group, ids, score = rng.integers(0, 4, 9), rng.integers(0, 1000, 9), rng.integers(0, 20, 9).astype(float)
        best.add(group, ids, score)
        rows += zip(group.tolist(), (-score).tolist(), ids.tolist(), strict=True)
    want = [x for g in range(4) for x in sorted(r for r in rows if r[0] == g)[:3]]
    group, ids, score = best.take()
    assert list(zip(group.tolist(), (-score).tolist(), ids.tolist(), strict=True)) == want


def test_english_terms():
    assert english("The Dogs' barking — isn't it? O’Neil " + "x" * (LONGEST + 1)) == ["dog", "bark", "isn't", "o'neil"]
    samples = {"consistency": "consist", "conspirators": "conspir", "kneeled": "kneel", "knavish": "knavish", "constancy": "constanc", "hopping": "hop", "hoping": "hope", "ties": "tie", "generously": "generous", "skies": "sky", "relational": "relat", "by": "by"}
    assert {w: stem(w) for w in samples} == samples


def test_a_cycle_is_named(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "a"), ("e", "d"), ("a", "r"), ("x", "r")], "child string, parent string")
    assert hi.cycle_trail(edges) == ["a", "c", "b", "a"]
    assert hi.cycle_trail(edges.where("child <> 'b'")) == []
    long = spark.createDataFrame([(f"n{i:03}", f"n{i - 1:03}") for i in range(1, 90)], "child string, parent string")
    assert hi.on_cycles(long).count() == 0  # as deep as it is


def test_a_task_holds_few_postings(spark, monkeypatch):
    """Rows that share common terms with many queries are scored in pieces, to equal scores."""
    made = rt.QueryBlock(range(50), [[f"w{i % 7}", "w7", "w8"] for i in range(50)])
    made.idf = np.linspace(0.1, 2.0, len(made.number))
    rows = [(i, 30, 9, [f"w{j}" for j in range(9)], [1 + (i + j) % 4 for j in range(9)]) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["id", "dl", "dt", "terms", "tfs"])
    whole = list(made.scores(batch, rt.KINDS))
    pieces, arange = [], np.arange
    monkeypatch.setattr(rt, "MOST_CELLS", 100)
    monkeypatch.setattr(rt.np, "arange", lambda *a: pieces.append(out := arange(*a)) or out)
    parts = list(made.scores(batch, rt.KINDS))
    monkeypatch.undo()
    assert max(map(len, pieces)) <= 100 + 50
    for x, y in zip(whole, parts, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(x, y, strict=True))


def test_texts_go_to_workers_in_bounded_batches(spark):
    """The session's default of 10,000 texts a batch is lowered by what sends texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(1, "a b")], "id long, text string")
    for call in (lambda: rt.lexical_hits(docs, "id", docs, "id"), lambda: dc.fit_column(docs, "id", [("b", "B", "text", 1)], 9)):
        before = spark.conf.get(name)
        spark.conf.set(name, "10000")
        call()
        assert int(spark.conf.get(name)) <= 1000
        spark.conf.set(name, before)


def test_document_counts_dont_shuffle_pairs(spark):
    """Terms are counted by term alone; rows that repeat an id, or have none, count once."""
    rows = [(1, "a b a"), (2, "A c"), (3, None), (4, "")]
    frame = lambda rows: spark.createDataFrame(rows, "id long, text string")
    made = rt.document_counts(frame(rows), "id")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == plan.count("Exchange hashpartitioning(term#") == 1
    assert {tuple(r) for r in made.collect()} == {("a", 2), ("b", 1), ("c", 1)}
    more = rt.document_counts(frame([*rows, (1, "b d"), (None, "a"), (None, "a e")]), "id")
    assert {tuple(r) for r in more.collect()} == {("a", 3), ("b", 1), ("c", 1), ("d", 1), ("e", 1)}
