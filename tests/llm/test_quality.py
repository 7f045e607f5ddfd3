from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality as q
from tests.llm import data


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    odd = ["a b c a b c", "a a a a", "a a a", "x y z x y", "l\nl\n\n l\nl", "#*$%&|<>", "☃ ☃ ☃ ☃ é", "w " * 200]
    docs = data.clashing(data.documents(spark, data.texts() + odd))
    rows = q.with_counts(docs, "doc_id").collect()
    given = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert len(rows) == len(given)
    for r in rows:
        assert tuple(r[c] for c in q.COUNTS) == counts(given[r.doc_id])


def features(c):
    n_words, chars, symbols, dup, rep = c
    return [math.log(max(chars, 1) / max(n_words, 1)), math.sqrt(symbols / max(chars, 1)), math.sqrt(rep / max(n_words, 1)), math.sqrt(dup / max(n_words, 1))]


FLOORS = np.diag([v**2 for _, v in q.FEATURES.values()])


def spread(x, w):
    """Mean, and what a half-set is judged by: its covariance, corrected, with floors."""
    m = (w[:, None] * x).sum(0) / w.sum()
    return m, q.CONSISTENCY * ((w[:, None] * x).T @ x / w.sum() - np.outer(m, m)) + FLOORS


def nearest(x, m, cov):
    """Weights of the exact half-set: ties at its edge have equal parts."""
    d = ((x - m) @ np.linalg.inv(cov) * (x - m)).sum(1)
    half = math.ceil(q.SHARE * len(x))
    edge = np.sort(d)[half - 1]
    tie = np.isclose(d, edge, rtol=1e-6, atol=1e-12)
    below = (d < edge) & ~tie
    return below + tie * (half - below.sum()) / tie.sum()


def drawn(groups, best):
    """The models of groups from their half-sets, by the same priors."""
    sums = {g: (w.sum(), w @ groups[g], (w[:, None] * groups[g]).T @ groups[g]) for g, w in best.items()}
    add = lambda parts: tuple(sum(p[i] for p in parts) for i in range(3))
    prior = lambda own, wide: tuple(own[i] + q.PRIOR_ROWS * wide[i] / wide[0] for i in range(3))
    whole = add(list(sums.values()))
    out = {}
    for g, own in sums.items():
        lang = prior(add([s for h, s in sums.items() if h[0] == g[0]]), whole)
        n, s, p = prior(own, lang)
        out[g] = s / n, q.CONSISTENCY * (p / n - np.outer(s / n, s / n)) + FLOORS
    return out


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    vocabulary = [word() for _ in range(400)]
    out = []
    for i in range(420):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 150))]
        if i % 9 == 0:
            words = [w + rng.choice(["***", "###", "$$$"]) for w in words]
        if i % 50 == 0:
            words = words[:10] * 12
        out.append(" ".join(words))
    return out + [None, ""]


def grouped(rows):
    groups = {}
    for lang, source, *f in rows:
        groups.setdefault((lang, source), []).append(f)
    return {k: np.array(v) for k, v in groups.items()}


def found_halves(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, f0 double, f1 double, f2 double, f3 double")
    out = {}
    for r in q.half_sets(df.repartition(3)).collect():
        cov = np.zeros((4, 4))
        for i in range(4):
            for j in range(i + 1):
                cov[i, j] = cov[j, i] = r[f"l{i}{j}"]
        low = np.tril(cov)
        out[r.lang, r.source] = r, np.array([r[f"m{i}"] for i in range(4)]), low @ low.T
    return out


def test_half_sets_equal_exhaustive_search(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(6):
        n = 8 + k
        x = rng.normal([1.5, 0.2, 0.3, 0.1], [0.2, 0.05, 0.1, 0.03], (n, 4))
        x[: n // 5] += rng.normal(0.8, 0.2, (n // 5, 4))  # outliers
        rows += [(None if k == 5 else f"l{k % 2}", f"s{k}", *map(float, v)) for v in x]
    groups, found = grouped(rows), found_halves(spark, rows)
    least = 0
    for g, x in groups.items():
        half = math.ceil(q.SHARE * len(x))
        dets = [np.linalg.slogdet(spread(x[list(c)], np.ones(half))[1])[1] for c in itertools.combinations(range(len(x)), half)]
        r, m, cov = found[g]
        assert abs(r.n - half) < 1e-9 and abs(np.linalg.slogdet(cov)[1] - r.logdet) < 1e-9
        assert min(dets) - 1e-9 <= r.logdet <= min(dets) + 0.15
        least += r.logdet < min(dets) + 1e-9
        # It is its own half-set: a further step changes nothing.
        again = spread(x, nearest(x, m, cov))
        assert np.linalg.slogdet(again[1])[1] >= r.logdet - q.LEAST_GAIN
    assert least >= 4


def test_ties_at_the_edge_have_equal_parts(spark):
    rows = [("en", "a", 1.0, 0.1, 0.2, 0.1)] * 30 + [("en", "a", 1.4, 0.1, 0.2, 0.1)] * 6 + [("en", "a", 0.6, 0.1, 0.2, 0.1)] * 4
    r, m, _ = found_halves(spark, rows)["en", "a"]
    assert r.n == 30 and abs(m[0] - 1.0) < 1e-9  # the 30 alike, whatever the others do
    rows = [("en", "a", 1.0, 0.1, 0.2, 0.1)] * 20 + [("en", "a", 1.01, 0.1, 0.2, 0.1)] * 20
    r, m, _ = found_halves(spark, rows)["en", "a"]
    assert r.n == 30 and min(abs(m[0] - x) for x in (1.01 - 0.01 / 3, 1.0 + 0.01 / 3)) < 1e-9  # 20 of one, 10 parts of 20


def test_distances_equal_numpy(spark, mixed):
    docs = data.documents(spark, mixed, langs=("en", "de", "en"))
    rows = {r.doc_id: r for r in q.judge(docs.repartition(5)).collect()}
    own = {}
    for r in docs.collect():
        c = counts(r.text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        assert rows[r.doc_id].base_failed == failed
        if failed:
            assert not rows[r.doc_id].kept and rows[r.doc_id].distance is None
        else:
            own[r.doc_id] = (r.lang, r.source, *features(c))
    groups, best = grouped(own.values()), {}
    for g, (r, m, cov) in found_halves(spark, list(own.values())).items():
        best[g] = nearest(groups[g], m, cov)
        assert np.allclose(spread(groups[g], best[g])[0], m, atol=1e-3)
    models = drawn(groups, best)
    for i, (lang, source, *f) in own.items():
        m, cov = models[lang, source]
        want = (f - m) @ np.linalg.inv(cov) @ (f - m)
        assert abs(rows[i].distance - want) < 0.05 * want + 0.05
        assert rows[i].kept == (rows[i].distance <= q.CUT)
    assert not any(rows[i].kept for i in own if i % 9 == 0) and sum(rows[i].kept for i in own if i % 9) > 0.97 * sum(i % 9 > 0 for i in own)


def test_small_and_empty_tables(spark):
    docs = data.clashing(data.documents(spark))
    docs = docs.withColumns({"__gone": F.lit("x"), "__lang": F.lit("x"), "a`b": F.lit("x")})
    rows = q.judge(docs.union(docs.limit(3))).collect()
    assert len(rows) == docs.count() + 3 and all(not (r.kept and r.base_failed) for r in rows)
    assert q.judge(docs.limit(0)).count() == 0
    kept = q.keep_good(docs)
    own = {r.doc_id for r in q.judge(docs).where("kept").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == own
    assert {r.doc_id for r in q.keep_good(docs.repartition(3), most=2).collect()} == own
    one = docs.where("doc_id = 66").withColumn("lang", F.lit(None).cast("string"))
    assert q.judge(one).count() == 1


def test_chi_square():
    assert abs(q.chi2_tail(9.487729, 4) - 0.05) < 1e-6 and abs(q.chi2_point(0.05, 4) - 9.487729) < 1e-4
