from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.errors import ConstraintError, CycleError
from tessera.functions.encoders import HashEncoder, encode_batched, encode_column
from tessera.operators import canonical as cn
from tessera.operators import constraints as ct
from tessera.operators import documents as dc
from tessera.operators import evaluate as ev
from tessera.operators import hierarchy as hi
from tessera.operators import retrieval as rt


def test_fusion_scores_and_ties(spark):
    rows = [(0, "label", "a", 1), (0, "label", "b", 2), (0, "lexical", "b", 1), (0, "lexical", "c", 2)]
    hits = spark.createDataFrame([(q, ord(i), c, r, 1.0) for q, c, i, r in rows], "qid long, id long, channel string, rank long, score double")
    got = rt.rrf(hits, {"label": 1.0, "semantic": 1.0, "lexical": 1.0}).orderBy("rank").collect()
    assert [chr(r.id) for r in got] == ["b", "a", "c"] and got[0].fused == round(1 / 62 + 1 / 61, 6) and got[1].lexical_rank is None
    assert rt.rrf(hits, {"label": 1.0, "lexical": 1.0}, top=1).count() == 1


def test_fusion_equals_plain_python(spark):
    rng = random.Random(0)
    rows = []
    for q, c in itertools.product(range(5), rt.RRF_WEIGHTS):
        rows += [(q, i, c, r + 1, 0.0) for r, i in enumerate(rng.sample(range(30), 12))]
    got = rt.rrf(spark.createDataFrame(rows, "qid long, id long, channel string, rank long, score double")).collect()
    for q in range(5):
        ranks = {}
        for _, i, c, r, _ in (x for x in rows if x[0] == q):
            ranks.setdefault(i, {})[c] = r
        fused = {i: round(sum(rt.RRF_WEIGHTS[c] / (60 + x) for c, x in r.items()), 6) for i, r in ranks.items()}
        order = sorted(ranks, key=lambda i: (-fused[i], *(ranks[i].get(c, 10**9) for c in ("semantic", "label", "lexical")), i))
        assert [r.id for r in sorted((x for x in got if x.qid == q), key=lambda x: x.rank)] == order


def test_cosine_equals_numpy(spark):
    v = np.random.default_rng(0).standard_normal((90, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vec array<double>").repartition(3)
    u = rt.unit_rows(v)
    s = np.round(u @ u.T, 6)
    got = rt.cosine_top_k(df, df, 4, block=40).collect()
    for q in range(90):
        want = sorted((i for i in range(90) if i != q), key=lambda i: (-s[q, i], i))[:4]
        assert [r.id for r in sorted((x for x in got if x.qid == q), key=lambda x: x.rank)] == want
    records = df.withColumn("record", df.id % 3)
    best = {(r.qid, r.id): r.score for r in rt.maxsim(df, records, 1000, block=50).collect()}
    few = rt.maxsim(df, records.repartition(5), 2, block=50).collect()
    ranked = lambda q: sorted((-s, i) for (a, i), s in best.items() if a == q)[:2]
    assert sorted((r.qid, r["rank"], -r.score, r.id) for r in few) == [(q, k + 1, *x) for q in sorted({q for q, _ in best}) for k, x in enumerate(ranked(q))]
    assert all(abs(best[q, g] - s[q, g::3].max()) < 2e-6 for q in range(90) for g in range(3))


def test_vector_scores_are_bounded_and_exact(spark, monkeypatch):
    """A batch of points of any size is multiplied in slices of MOST_CELLS scores."""
    monkeypatch.setattr(rt, "MOST_CELLS", 7 * 60)
    seen, worth = [], rt._worth
    monkeypatch.setattr(rt, "_worth", lambda score, least, k: seen.append(score.shape) or worth(score, least, k))
    v = np.round(np.random.default_rng(1).standard_normal((60, 2)), 0)  # many ties, some zero vectors
    batch = [pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(v.tolist(), pa.list_(pa.float64()))], ["id", "vec"])]
    u, ids = rt.unit_rows(v), np.arange(60)
    best, records = rt.Best(60, 3, 100), rt.BestRecords(60, 3, 100)
    s = rt.rounded(u @ u.T)
    for own, w in rt._slices(batch, 60):
        score = u @ w.T
        a, b = rt._worth(score, best.least, 4)
        other = ids[a] != own[b]
        best.add(a[other], own[b[other]], rt.rounded(score[a[other], b[other]]))
        a, b = rt._worth(score, records.least, 3)
        records.add(np.repeat(a, 2), np.repeat(own[b] // 4, 2), np.repeat(rt.rounded(score[a, b]), 2))
    assert len(seen) == 18 and max(n * m for n, m in seen) <= rt.MOST_CELLS
    group, met, score = best.take()
    for q in range(60):
        want = sorted((i for i in range(60) if i != q), key=lambda i: (-s[q, i], i))[:3]
        assert met[group == q].tolist() == want and np.allclose(score[group == q], s[q, want], atol=2e-6)
    top = s.reshape(60, 15, 4).max(axis=2)
    group, met, score = records.take()
    for q in range(60):
        assert met[group == q].tolist() == sorted(range(15), key=lambda i: (-top[q, i], i))[:3]


def test_canonical_paths_equal_search(spark):
    rng = random.Random(3)
    for _ in range(3):
        n = 25
        edges = [(f"n{b:02d}", f"n{a:02d}") for b in range(2, n) for a in rng.sample(range(b), min(b, rng.randint(1, 3)))]
        ups = {}
        for c, p in edges:
            ups.setdefault(c, []).append(p)

        def best(x, ups=ups):
            if x in ("n00", "n01"):
                return (x,)
            return min(((*best(p), x) for p in ups[x]), key=lambda t: (-len(t), t))

        nodes = spark.createDataFrame([(f"n{i:02d}", "group", "x" if i < 2 else "xx", "l") for i in range(n)], "id string, type string, code string, label string")
        got = hi.canonical_paths(nodes, spark.createDataFrame(edges, "child string, parent string"), nodes.where("length(code) = 1"))
        assert {r.id: tuple(r.path) for r in got.collect()} == {f"n{i:02d}": best(f"n{i:02d}") for i in range(n)}


def test_hierarchy_faults(spark):
    nodes = spark.createDataFrame([("r", "group", "1", "R"), ("a", "group", "11", "A"), ("b", "occ", None, " "), ("c", "occ", "9", "C")], "id string, type string, code string, label string")
    edges = spark.createDataFrame([("a", "r"), ("a", "c"), ("c", "a"), ("r", "x")], "child string, parent string")
    found = {r.constraint: r.n for r in ct.report(hi.guards(nodes, edges)).collect()}
    assert found == {"label not blank": 1, "groups have codes, others none": 1, "parent exists": 1, "roots have no parent": 1, "others have a parent": 1}
    assert {r.id for r in hi.on_cycles(edges.where("parent <> 'x'")).collect()} == {"a", "c"}
    with pytest.raises(CycleError):
        hi.canonical_paths(nodes, edges, nodes.where("id = 'r'"))
    with pytest.raises(ConstraintError, match="parent exists: 1"):
        ct.enforce(hi.guards(nodes, edges))
    forest = spark.createDataFrame([("1", "a", None), ("2", "b", "1"), ("3", "c", "9"), ("4", "d", "5"), ("5", "e", "4"), ("6", " ", None)], "id string, name string, parent_id string")
    assert {r.id: r.state for r in hi.walk_up(forest).collect()} == {"1": "ok", "2": "ok", "3": "missing", "4": "cycle", "5": "cycle", "6": "missing"}


def test_dedup_keeps_latest_and_earlier(spark):
    rows = spark.createDataFrame([("a", "1", 0, "x"), ("a", "2", 1, "x"), ("a", "2", 2, "x"), ("b", "1", 3, "y"), ("b", "1", 4, "z")], "k string, d string, pos int, v string")
    assert {r.k: r.pos for r in cn.keep_latest(rows, "k", "d", "pos").collect()} == {"a": 1, "b": 3}
    assert [r.k for r in cn.conflicts(rows, "k", "d", "pos").collect()] == ["b"]


def test_constraints(spark):
    a = spark.createDataFrame([(1, ["x", "a"], ["a"]), (1, None, ["b"]), (2, ["q"], ["q"])], "id long, p array<string>, w array<string>")
    names = lambda *cs: {r.constraint: (r.n, r["keys"]) for r in ct.report(cs).collect()}
    assert names(ct.unique(a, "id"), ct.sorted_array(a, "p", "id"), ct.subset(a, "p", "w", "id"), ct.disjoint(a, "p", "w", "id")) == {"unique id": (1, ["1"]), "p sorted": (1, ["1"]), "p within w": (1, ["1"]), "p and w disjoint": (2, ["1", "2"])}
    b = a.where("id = 2")
    assert names(ct.equal_rows(b, b, "id"), ct.equal_rows(b, b.limit(0), "id"))["equal rows by id"][0] == 1


def test_rerank_decide_and_metrics(spark):
    c = spark.createDataFrame([(0, 1, 1, 0.3), (0, 2, 2, 0.2), (0, 3, 3, 0.1), (1, 4, 1, 0.5)], "qid long, id long, rank long, fused double")
    s = spark.createDataFrame([(0, 1, 0.5), (0, 2, 0.95)], "qid long, id long, rerank_score double")
    r = ev.attach_rerank(c, s).orderBy("qid", "rank").collect()
    assert [x.rerank_rank for x in r] == [2, 1, None, None] and [x.id for x in r] == [1, 2, 3, 4]
    q = spark.createDataFrame([(0,), (1,), (2,)], "qid long")
    made = {x.qid: x for x in ev.decide(ev.attach_rerank(c, s), q).collect()}
    assert made[0].status == "mapped" and made[0].best_id == 2 and made[1].abstain_reason == made[2].abstain_reason == "nothing scored"
    low = {x.qid: x for x in ev.decide(ev.attach_rerank(c, s), q, 0.96).collect()}
    assert low[0].abstain_reason == "best score 0.9500 is under 0.96"
    gold = spark.createDataFrame([(0, 2), (1, 9)], "qid long, id long")
    m = ev.first_hits(c, gold, q).agg(*ev.metric_columns()).first()
    assert (m.n, m.hit_1, m.hit_5, m.mrr_10, m.zero_hit) == (3, 0.0, round(1 / 3, 6), round(1 / 6, 6), round(2 / 3, 6))
    p = {x.policy: x for x in ev.policy_metrics(ev.policies(ev.attach_rerank(c, s)), gold, q).collect()}
    assert (p["rank<=1"].tp, p["rank<=1"].fp, p["rank<=1"].fn) == (1, 0, 1) and p["margin>=0.2"].f1 == round(2 / 3, 6)
    with pytest.raises(Exception, match="one finite score"):
        ev.rerank_scores(spark.createDataFrame([(0, 1, "a", "b")], "qid long, id long, query string, document string"), lambda: lambda q, d: []).collect()


def test_blend_of_flat_lists(spark):
    c = spark.createDataFrame([(0, 1, 1, 0.3, None), (0, 2, 2, 0.3, 0.9)], "qid long, id long, rank long, fused double, rerank_score double")
    got = {(r.weight, r.id): (r.score, r.blend_rank) for r in ev.blend(c, (0.0, 1.0)).collect()}
    assert got == {(0.0, 1): (0.0, 1), (0.0, 2): (0.0, 2), (1.0, 1): (0.0, 2), (1.0, 2): (1.0, 1)}


def test_concentration_and_sample(spark):
    counts = spark.createDataFrame([(i, i + 1) for i in range(40)], "concept long, n long")
    row = ev.concentration(counts, 80).first()
    assert row.upper_median == 21 and row.singletons == 1 and row.at_most_3 == 3 and row.catalog_share == 0.5
    rows = spark.createDataFrame([(i, "en" if i % 10 else "es", f"s{i % 3}") for i in range(300)], "id long, lang string, source string")
    one = [r.id for r in ev.stratified_sample(rows, "id", ["lang", "source"], 50, minimums={("lang", "es"): 20}).collect()]
    two = [r.id for r in ev.stratified_sample(rows.repartition(7), "id", ["lang", "source"], 50, minimums={("lang", "es"): 20}).collect()]
    assert sorted(one) == sorted(two) and len(one) == 50 and sum(i % 10 == 0 for i in one) >= 20


def test_fit_to_budget():
    parts = [dc.Section("title", "Title", "t " * 10, 90), dc.Section("body", "Body", "w " * 200, 10)]
    done = dc.fit(parts, 64, "Find")
    assert done.tokens <= 64 and done.shortened == ("body",) and done.truncated and "t t t" in done.text and done == dc.fit(parts, 64, "Find")
    whole = dc.fit(parts, 1000)
    assert not whole.truncated and whole.tokens == whole.tokens_before
    assert dc.fit([dc.Section("t", "T", "w " * 100, 1)], 1).tokens <= 8


def test_encoder(spark):
    class Small(HashEncoder):
        def encode(self, texts):
            if len(texts) > 2:
                raise MemoryError
            return super().encode(texts)

    assert np.allclose(encode_batched(Small(8), ["a", "b", "c c", ""]), HashEncoder(8).encode(["a", "b", "c c", ""]))
    rows = encode_column(spark.createDataFrame([(1, "x"), (2, None)], "id long, t string"), "id", "t")
    assert rt.norm_report(rows).where("NOT ok").count() == 0
