from __future__ import annotations

import numpy as np
import pytest

from tessera.errors import ConstraintError, SourceError
from tessera.functions import remote as rm
from tessera.operators import constraints as ct
from tessera.operators import labels as lb


def test_retries():
    calls, slept = [], []

    def client(url, payload):
        calls.append(payload)
        return [(503, {}, None), (429, {"Retry-After": "99"}, None), (200, {}, "ok")][len(calls) - 1]

    assert rm.request(client, "u", 1, sleep=slept.append) == (200, "ok") and slept == [2.0, 30.0]
    with pytest.raises(SourceError, match="404"):
        rm.request(lambda u, p: (404, {}, None), "u", 1)
    with pytest.raises(SourceError, match="4 attempts"):
        rm.request(lambda u, p: (503, {}, None), "u", 1, sleep=lambda s: None)


def test_encoder_packs_and_splits():
    sizes = []

    def client(url, payload):
        n = len(payload["inputs"])
        sizes.append(n)
        return (rm.TOO_LARGE, {}, None) if n > 2 else (200, {}, [[3.0, 4.0]] * n)

    got = rm.RemoteEncoder("u", 2, client, most_items=4).encode(["a", "b", "c", "d", "e"])
    assert sizes == [4, 2, 2, 1] and np.allclose(got, [[0.6, 0.8]] * 5)
    assert list(rm.packed([5, 5, 20, 1], 8, 10)) == [[0, 1], [2], [3]]
    with pytest.raises(SourceError):
        rm.RemoteEncoder("u", 3, client).encode(["a"])
    with pytest.raises(SourceError):
        rm.RemoteEncoder("u", 2, lambda u, p: (rm.TOO_LARGE, {}, None)).encode(["a"])


def test_reranker():
    asked = []

    def client(url, payload):
        asked.append(payload)
        return 200, {}, {"results": [{"index": i, "relevance_score": float(len(d))} for i, d in enumerate(payload["documents"])][:2]}

    scores = rm.RemoteReranker("u", "Find", client=client)(["q", "q", "q", "r"], ["a", "bb", "c", "ddd"])
    assert scores == [1.0, 2.0, None, 3.0] and asked[0]["query"] == "Find\nq" and len(asked) == 2
    assert rm.ranked([{"index": 0, "relevance_score": 1}, {"index": 1, "relevance_score": 2}], 2) == [(1, 2.0), (0, 1.0)]
    for bad in ([{"index": 2, "relevance_score": 1}], [{"index": 0}], [{"index": 0, "relevance_score": float("nan")}], [{"index": 0, "relevance_score": 1}] * 2, {"x": 1}, [1]):
        with pytest.raises(SourceError):
            rm.ranked(bad, 2)


def test_gold(spark):
    gold = spark.createDataFrame([(1, ["a", "b"], ["a"]), (2, ["c", "c"], ["d"]), (3, [], [])], "job_id long, accepted array<string>, primary array<string>")
    names = spark.createDataFrame([("x", "b"), ("y", "c"), ("y", "d")], "label string, id string")
    fixed = lb.adjudicate(gold, spark.createDataFrame([(1, ["x"])], "job_id long, labels array<string>"), names)
    assert {r.job_id: (r.accepted, r.primary) for r in fixed.collect()}[1] == (["b"], [])
    with pytest.raises(ConstraintError, match="y"):
        lb.adjudicate(gold, spark.createDataFrame([(1, ["y"])], "job_id long, labels array<string>"), names)
    jobs = spark.createDataFrame([(1,), (2,)], "job_id long")
    concepts = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, label string")
    found = {r.constraint: r.n for r in ct.report(lb.gold_constraints(gold, jobs, concepts)).collect()}
    assert found == {"job_id references job_id": 1, "id references id": 1, "primary within accepted": 1, "labels differ": 1}
    assert tuple(lb.audit(gold).first()) == (3, 1, 4, 3)
    assert {r.job_id: r.titles for r in lb.titles(gold, concepts).collect()} == {1: "A; B", 2: f"{lb.MISSING}; {lb.MISSING}", 3: ""}
    assert lb.first_source(gold.limit(0), gold).count() == 3
    assert lb.show(concepts, "label", "id", "a").count() == 1
