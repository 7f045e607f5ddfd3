from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import ctw
from tests.llm import data

D = ctw.DEPTH


def brute_tree(texts):
    """Context-tree weighting by its recursion, in plain Python; returns bit predictor."""
    nodes = {}
    for t in texts:
        b = bytes([255] * D) + t + b"\xff"
        for i in range(D, len(b)):
            for k in range(8):
                bit, so_far = (b[i] >> (7 - k)) & 1, (k, b[i] >> (8 - k))
                for d in range(D + 1):
                    nodes.setdefault((b[i - d : i][::-1], so_far), [0, 0])[bit] += 1

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted, stop = {}, {}
    for (context, so_far), (a, b) in sorted(nodes.items(), key=lambda x: -len(x[0][0])):
        own = log_kt(a, b)
        if len(context) == D:
            weighted[context, so_far] = own
        else:
            below = sum(weighted.get((context + bytes([c]), so_far), 0.0) for c in range(256))
            weighted[context, so_far] = np.logaddexp(own, below) - math.log(2)
            stop[context, so_far] = 1 / (1 + math.exp(min(700, below - own)))

    def log10(context, byte):
        total = 0.0
        for k in range(8):
            bit, so_far = (byte >> (7 - k)) & 1, (k, byte >> (8 - k))
            p = None
            for d in range(D, -1, -1):
                a, b = nodes.get((context[:d], so_far), (0, 0))
                own = ((b if bit else a) + 0.5) / (a + b + 1)
                w = 0.5 if d < D and (context[:d], so_far) not in stop else stop.get((context[:d], so_far))
                p = own if d == D else w * own + (1 - w) * p
            total += math.log10(p)
        return total

    def score(t):
        b = bytes([255] * D) + t + b"\xff"
        return sum(log10(b[i - D : i][::-1], b[i]) for i in range(D, len(b)))

    return score


def low(text):
    return (text or "").encode().lower()


def test_scores_equal_brute_force(spark):
    docs = data.clashing(data.documents(spark, data.texts(14)))
    docs = docs.union(docs.limit(2))
    rows = ctw.score_texts(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    train = [low(t) for i, t in texts if zlib.crc32(str(i).encode()) % 10]
    score = brute_tree(train)
    words = Counter()
    for t in train:
        words.update(w for w in re.split(rb"[\x20\x09-\x0D]+", t) if w)
        words["end"] += 1
    n, v = sum(words.values()), len(words)
    want = {}
    for i, t in texts:
        own = [w for w in re.split(rb"[\x20\x09-\x0D]+", low(t)) if w] + ["end"]
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want[i] = (len(own), sum(words[w] > 0 for w in own), base, score(low(t)) if len(low(t)) < 3000 else None)
    assert len(rows) == len(texts)
    for r in rows:
        k, known, base, s = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (k, known, n, zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9
        assert s is None or abs(r.score - s) < 2e-4 * abs(s) + 1e-3


def test_both_ways_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 5000)
    docs = data.clashing(data.documents(spark))
    docs = docs.union(docs.limit(9)).repartition(3)
    key = lambda r: (r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score)
    a = sorted(map(key, ctw.score_texts(docs).collect()))
    assert len(a) == docs.count()
    assert a == sorted(map(key, ctw.score_texts(docs, most_words=3).collect()))
    assert a == sorted(map(key, ctw.score_texts(docs, most_cells=3).collect()))


def test_probabilities_sum_to_one(spark):
    texts = [low(t) for t in data.texts() if t]
    keys, n = np.unique(np.concatenate([ctw.cells(t) for t in texts]), return_counts=True)
    contexts = [int(keys[0]) >> 8, int(keys[len(keys) // 2]) >> 8, 0x0101020304, 0x6161616101]
    asked = {c: (np.uint64(c) << np.uint64(8)) | np.arange(256, dtype=np.uint64) for c in contexts}
    n = dict(zip(keys.tolist(), n.tolist(), strict=True))
    rows = [(int(k), n.get(int(k), 0)) for k in {*n, *(int(k) for q in asked.values() for k in q)}]
    found = {r.key: r.v for r in ctw.cell_scores(spark.createDataFrame(rows, "key long, n long")).collect()}
    assert len(found) == len(rows)
    for q in asked.values():
        assert abs(sum(10.0 ** found[int(k)] for k in q) - 1) < 1e-4


def test_without_training_texts(spark):
    docs = data.documents(spark, ["ab"])
    held = docs.selectExpr(f"CAST({next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)} AS long) AS doc_id", "text")
    row = ctw.score_texts(held).first()
    assert row.train_tokens == 0 and row.n_known == 0 and row.score == pytest.approx(-24 * math.log10(2), abs=1e-4) and row.base_score == 0
    assert ctw.score_texts(docs.limit(0)).count() == 0


def test_block_probabilities():
    for a, b in ((0, 0), (1, 0), (3, 5), (150, 60), (5000, 3), (100000, 90000)):
        want = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert abs(float(ctw.log_kt(np.array([a]), np.array([b]))[0]) - want) < 1e-6 * max(1, abs(want))
