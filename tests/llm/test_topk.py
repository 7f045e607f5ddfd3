from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.llm.topk import Searcher, int_vectors, statistics, top_k


def brute(rows, k=5, step=50):
    import math

    v = {i: [math.floor(256 * float(x)) for x in e] for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in v:
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q and len(v[c]) == len(v[q]))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24).astype(np.float32).tolist()) for i in range(420)]
    rows[7] = (7, None)
    rows[9] = (9, [float("nan")] + [0.0] * 23)
    rows[11] = (11, [None] + [0.5] * 23)
    rows[13] = (13, [float("inf")] + [0.5] * 23)
    for i in range(20, 40):
        rows[i] = (i, rows[20][1])  # ties
    rows += [(1000, [0.1, 0.2]), (1001, [0.3, 0.4]), (1050, []), (1051, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    v = int_vectors(df.repartition(4))
    for block in (4096, 3):
        got = top_k(v, v.where("vec_id % 50 = 0"), block=block)
        assert sorted(map(tuple, got.collect())) == brute(rows)
    assert top_k(v.limit(0), v.limit(0)).count() == 0


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (3, [1.0, 1.0]), (3, [2.0, 1.0]), (50, [0.0, 1.0]), (None, [9.0, 9.0])]
    v = int_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(tuple(r) for r in top_k(v, v.where("vec_id % 50 = 0")).where("vec_id IS NOT NULL").collect())
    # The least of a query's vectors asks; a repeated candidate counts each time; own rows don't.
    q = np.array([128, 128])
    want = sorted([(-int(q @ [512, 256]), 3), (-int(q @ [256, 256]), 3), (-int(q @ [0, 256]), 50)])
    assert [(i, s) for a, _, i, s in got if a == 0] == [(i, -s) for s, i in want]


def test_bounds_never_fall_short_and_prune():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 64)) * 100
    v = (centres[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 64)) * 10).round()
    for s in (1, 4, 16, 64):
        m, d, _ = statistics(v, s)
        assert (m @ m[:50].T + d @ d[:50].T >= v @ v[:50].T - 1e-6).all()
    searcher = Searcher(np.arange(0, 3000, 50), v[::50], 5)
    searcher.feed(np.arange(3000), v)
    assert searcher.exact < 0.5 * 60 * 3000
