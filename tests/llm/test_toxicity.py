from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity as tox
from tests.llm import data


def best_by_all_pairs(scores):
    """Maximal segments by their definition: repeated best, left parts and right parts."""

    def split(low, high):
        found = [(sum(scores[a:b]), a, b) for a, b in itertools.combinations(range(low, high + 1), 2)]
        found = [f for f in found if f[0] > 1e-12]
        if not found:
            return []
        top = max(f[0] for f in found)
        _, a, b = min((f for f in found if f[0] > top - 1e-9), key=lambda f: f[2] - f[1])
        return split(low, a) + [(a, b)] + split(b, high)

    return split(0, len(scores))


def test_segments_equal_definition():
    rng = random.Random(0)
    for _ in range(200):
        n = rng.randint(1, 14)
        scores = [rng.choice([1.7, 2.3, 0.9, -1.1]) + rng.random() / 50 if rng.random() < 0.4 else -0.31 for _ in range(n)]
        items = [(i, s) for i, s in enumerate(scores) if s != -0.31]
        got = [(a, b) for a, b, _ in tox.segments(items, -0.31)]
        assert got == best_by_all_pairs(scores)


def test_scale_solves_its_equation():
    x = tox.scale([(0.01, 3.0), (0.002, -1.0)], -0.1)
    assert abs(0.01 * math.exp(3 * x) + 0.002 * math.exp(-x) + 0.988 * math.exp(-0.1 * x) - 1) < 1e-6


def corpus(spark, n=900):
    rng = random.Random(1)
    clean = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(30, 200))]
        bad = i % 7 == 0
        if bad:
            for w in rng.sample(["vile", "wretch", "scoundrel", "knaveish", "knavery"], 3):
                words[rng.randrange(len(words))] = w.upper() + "!"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(n, None), (n + 1, ""), (None, "vile wretch scoundrel")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels + [(0, 1, None), (5000, 0, 1)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    rows = tox.score_toxicity(data.clashing(docs), labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.predicted == (r.doc_id % 7 == 0) for r in test) >= 0.98 * len(test)
    empty = {r.doc_id: r.score for r in rows if r.doc_id in (900, 901)}
    assert empty[900] == empty[901] < 0.5


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = corpus(spark, 300)
    turned = labels.withColumn("toxic", F.when(tox.held_out(5), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, tox.score_toxicity(docs, x).collect()), key=repr) for x in (labels, turned))
    assert a == b


def test_odd_tables(spark):
    docs, labels = corpus(spark, 60)
    assert tox.score_toxicity(docs.limit(0), labels).count() == 0
    rows = tox.score_toxicity(docs, labels.limit(0)).collect()
    assert len({r.score for r in rows}) == 1
    model = tox.Model({"vile": 3.0}, -0.01, 4.0)
    assert [p[:2] for p in tox.passages("a vile b " + "c " * 500 + "vile vile", model)] == [(1, 2), (503, 505)]
    assert tox.passages("a b", model) == [] and model.scan(b"") == (0.0, 0, 0, 0.0)
    long = "c " * 300_000 + "vile vile " + "c " * 300_000
    assert [p[:2] for p in tox.passages(long, model)] == [(300_000, 300_002)]
    curve = tox.fit_curve(np.array([0.0] * 50 + [2.0] * 50), np.array([0.0] * 49 + [1.0] + [1.0] * 49 + [0.0]))
    assert curve[0] < 0 < curve[1]


def brute_counts(rows):
    """token: toxic and other documents, toxic and other uses; and the same of all."""
    found, whole = {}, [0, 0, 0, 0]
    for r in rows:
        words = tox.tokens(bytes(r.t))
        met, k = {}, 0 if r.toxic else 1
        for i, w in enumerate(words):
            if sum(words[j] == w and counts for j, counts in met.items() if j >= i - tox.REACH) < tox.USES:
                met[i] = True
                for b in {w, w[:4], w[:5], w[:6], w[:7], w[:8]}:
                    row = found.setdefault(b, [set(), set(), 0, 0])
                    row[k].add(r[0])
                    row[2 + k] += 1
        whole[k] += 1
        whole[2 + k] += len(met)
    return {b: (len(x), len(y), m, n) for b, (x, y, m, n) in found.items()}, whole


def brute_model(rows):
    found, (d1, d0, t1, t0) = brute_counts(rows)
    table = {}
    for b, (x, y, m, n) in found.items():
        share, prior = (x + y) / (d1 + d0), 50 * (t1 + t0) / (d1 + d0)
        own = prior * (m + n) / (t1 + t0)
        odds = math.log((m + own) / (t1 + prior)) - math.log((n + own) / (t0 + prior))
        sure = abs(odds) - 3 * math.sqrt(1 / (x + 50 * share) + 1 / (y + 50 * share))
        if x + y >= 3 and sure > 0:
            table[b] = math.copysign(sure, odds)
    uses = {}
    for r in rows:
        for _, s in tox.Model(table).items(tox.tokens(bytes(r.t))):
            uses.setdefault(s, [0, 0])[0 if r.toxic else 1] += 1
    high = sum(m for s, (m, _) in uses.items() if s > 0) / t1
    low = sum(max(n, 0.05) for s, (_, n) in uses.items() if s > 0) / t0
    rest = min(math.log(1 - high) - math.log(1 - low), -1e-3)
    return tox.Model(table, rest, tox.scale([(max(n, 0.05) / t0, s) for s, (_, n) in sorted(uses.items())], rest))


def brute_evidence(model, text):
    words = tox.tokens(text)
    scores = [model.rest] * len(words)
    for i, s in model.items(words):
        scores[i] = s
    sums = sorted((sum(scores[a:b]) for a, b in best_by_all_pairs(scores)), reverse=True)
    if not sums:
        return 0.0
    n, lam = len(words), model.scale
    ps = [1 - math.exp(-n * math.exp(-lam * sums[0]))]
    for r in range(2, len(sums) + 1):
        if lam * sums[r - 1] <= math.log(n):
            break
        t = sum(lam * s - math.log(n) for s in sums[:r])
        ps.append(2**r * math.exp(-t) * t ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)))
    return -math.log10(min(ps))


def test_the_model_equals_brute_force(spark):
    docs, labels = corpus(spark, 300)
    rows = tox.labelled(docs, labels, tox.MOST_LABELLED, 5).collect()
    model = tox.learn(docs, labels)
    want = brute_model(rows)
    assert model.table.keys() == want.table.keys() and model.table and all(abs(model.table[k] - want.table[k]) < 1e-9 for k in want.table)
    assert abs(model.rest - want.rest) < 1e-9 and abs(model.scale - want.scale) < 1e-6
    halves = [brute_model([r for r in rows if r.half == h]) for h in (0, 1)]
    evidence = [halves[1 - r.half].scan(bytes(r.t))[0] for r in rows]
    curve = tox.fit_curve(np.round(evidence, 2), np.array([float(r.toxic) for r in rows]))
    assert np.allclose(curve, (model.intercept, model.slope), atol=1e-6)
    scored = {r.doc_id: r.score for r in tox.score_toxicity(docs, labels).collect()}
    some = [r for r in docs.where("doc_id < 300").collect() if len(r.text) < 450][:25]
    assert len(some) > 10
    for r in some:
        e = brute_evidence(want, r.text.encode())
        assert abs(scored[r.doc_id] - 1 / (1 + math.exp(-curve[0] - curve[1] * math.log1p(e)))) < 1e-6


def test_more_passages_are_more_evidence():
    model = tox.Model({"vile": 3.0, "wretch": 3.0}, -0.05, 2.0)
    clean = "c " * 400
    one, two = ((clean + "vile wretch ") * k + clean for k in (1, 2))
    assert model.scan(two.encode())[0] > model.scan(one.encode())[0] + 0.5
    long = tox.Model({"abcdefghijk": 3.0}, -0.05, 2.0)  # letters past the eighth count
    assert long.scan(b"x abcdefghijk y")[0] > 0 and long.scan(b"x abcdefghixx y")[0] == 0


def test_labelled_rows(spark):
    docs, labels = corpus(spark, 300)
    copies = docs.where("doc_id < 40").selectExpr("doc_id + 100000 AS doc_id", "concat(text, ' too') AS text")
    again = labels.where("doc_id < 40").selectExpr("doc_id + 100000 AS doc_id", "quality", "toxic")
    own = {r["__id"] for r in tox.labelled(docs, labels, 10**6, 5).collect()}
    more = tox.labelled(docs.union(docs).union(copies), labels.union(again), 10**6, 5).collect()
    assert own == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5}
    assert len([r for r in more if r["__id"] >= 100000]) <= 12  # held-out originals' and those cut anew
    assert own == {r["__id"] for r in more if r["__id"] < 100000} and len(more) == len({r["__id"] for r in more})
    assert tox.labelled(docs, labels, 50, 5).count() <= 50


def test_repeated_rows_change_nothing(spark):
    docs, labels = corpus(spark, 200)
    a = {r.doc_id: r.score for r in tox.score_toxicity(docs, labels).collect()}
    rows = tox.score_toxicity(docs.union(docs).union(docs), labels.union(labels)).collect()
    assert len(rows) == 3 * docs.count() and all(abs(a[r.doc_id] - r.score) < 1e-12 for r in rows)


def test_later_passages_repeat_earlier_words():
    model = tox.Model({"vile": 3.0, "wretch": 3.0, "knave": 3.0}, -0.05, 2.0)
    passage, clean = "vile wretch knave ", "c " * 500
    text = (passage + clean) * 4
    assert [p[:2] for p in tox.passages(text, model)] == [(503 * i, 503 * i + 3) for i in range(4)]
    assert model.scan(text.encode())[1:3] == (4, 12)
    early = ("vile " + clean + "wretch " + clean + "knave " + clean) * 2
    assert (3006, 3009) in [p[:2] for p in tox.passages(early + passage, model)]
    assert len(model.items(("vile " * 40).split())) == tox.USES  # a burst
