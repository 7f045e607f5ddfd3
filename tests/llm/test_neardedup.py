from __future__ import annotations

import random
import re

import numpy as np

from tessera.llm import common
from tessera.llm import neardedup as nd
from tessera.llm.components import components
from tessera.llm.shingles import shingle_set, word_hashes
from tests.llm import data


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, base, share):
    return " ".join(rng.choice(words) if rng.random() < share else w for w in base)


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    out = data.texts(36)
    for size, share in ((60, 0.02), (25, 0.035), (12, 0.05)):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        out += [edited(rng, words, base, rng.random() * share) for _ in range(size)]
        out += [" ".join(base), " ".join(base).upper()]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(10, 60))) for _ in range(30)]
    return out + ["a b c", "A  b\nc", "a b"]


def test_components_equal_brute_force(spark):
    docs = data.clashing(data.documents(spark, corpus()))
    rows = nd.near_duplicates(docs.repartition(6)).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(want)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 7)
    monkeypatch.setattr(nd, "MOST", 5)  # joins instead of broadcasts
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    docs = data.documents(spark, corpus())
    rows = nd.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_a_stray_among_many_copies_costs_rows_in_proportion(spark):
    n = 20_000
    banded = spark.range(n + 1).selectExpr("7L AS band", "id AS doc").union(spark.range(3).selectExpr("8L AS band", "id AS doc"))
    labels = spark.range(n).selectExpr("id AS node", "0L AS label")
    rows = nd._strays(banded, labels)
    assert rows.count() == n + 1 and rows.where("label <> lead").count() == 1  # bucket 8 is one component
    dealt = nd._cells(rows)
    assert dealt.count() <= 1.01 * n + 2 * n / nd.BLOCK
    # The stray meets every member once.
    met = dealt.where("left").select("cell").join(dealt.where("NOT left AND lead"), "cell")
    assert met.count() == met.select("doc").distinct().count() == n


def test_strays_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 4)
    banded = spark.range(40).selectExpr("7L AS band", "id AS doc")
    labels = spark.range(10).selectExpr("id AS node", "0L AS label")
    dealt = nd._cells(nd._strays(banded, labels))
    x = dealt.where("left").selectExpr("cell", "doc AS x")
    pairs = {(r.x, r.doc) for r in x.join(dealt.where("NOT left"), "cell").collect()}
    assert pairs == {(a, b) for a in range(10, 40) for b in range(40)}


def test_hot_joins(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = common.materialize(spark.range(3000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id"), "rows")
    params = spark.range(-1, 2000).selectExpr("id AS k", "id * 2 AS v")
    got = common.hot_join(rows, params, "k", written=True, share=0.1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(params, "k").collect()))
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()


def test_long_words_dont_collide():
    a, b = bytearray(b"a"), bytearray(b"b")
    for _ in range(11):  # Thue-Morse words: equal for every polynomial modulo 2**64
        a, b = a + b, b + a
    assert word_hashes(bytes(a))[0] != word_hashes(bytes(b))[0]


def test_odd_tables(spark):
    docs = data.documents(spark, [None, "", " \n", "one two three four five six", "one two three four five six"])
    rows = {r.doc_id: r for r in nd.near_duplicates(docs.union(docs)).collect()}
    assert [rows[i].component_id for i in range(5)] == [0, 1, 2, 3, 3] and [rows[i].n_shingles for i in range(5)] == [0, 0, 0, 2, 2]
    assert nd.near_duplicates(docs.limit(0)).count() == 0
    nulls = docs.selectExpr("CAST(NULL AS long) AS doc_id", "text")
    assert all(r.component_id is None and r.kept for r in nd.near_duplicates(nulls).collect())


def test_hashes_follow_words():
    assert (word_hashes(b"Ab  cd\tab\x0b") == word_hashes(b"aB cd ab")).all() and len(word_hashes(b" \n")) == 0
    a, b = word_hashes(b"ab"), word_hashes(b"abc")
    assert a[0] != b[0] and len(shingle_set(b"a a a a a a a a")) == 1


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for shared in (500, 800, 950):
        x, y = np.unique(pool[:1000]), np.unique(np.concatenate([pool[1000 - shared : 1000], pool[1000 : 2000 - shared]]))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        p, q = (nd.bit_planes(nd.minima(s)).view(np.uint64) for s in (x, y))
        n = nd._LONGS
        diff = (p[:n] ^ q[:n]) | (p[n:] ^ q[n:])
        assert abs(nd.estimate(int(np.bitwise_count(diff).sum())) - true) < 0.06


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 520)] + [(7, 7), (None, 3)]
    rows = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert rows == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def small_pairs(sizes, each, seed=5):
    """Texts in pairs of exactly 0.75: 3 n of 4 n shingles are shared, the second text is the first without its end."""
    rng = random.Random(seed)
    out = []
    for n in sizes:
        for _ in range(each):
            base = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(4 * n + 4)]
            out += [" ".join(base), " ".join(base[: 3 * n + 4])]
    return out


def test_small_pairs_at_the_threshold(spark):
    docs = data.documents(spark, small_pairs(range(1, 6), 60))
    rows = nd.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
        i: (len(shingles(t)), i - i % 2) for i, t in docs.select("doc_id", "text").collect()
    }


def test_small_pairs_left_for_the_blocks(spark, monkeypatch):
    none = lambda pairs: pairs.limit(0).select("a", "b")
    monkeypatch.setattr(nd, "_best", none)  # no links by hubs
    docs = data.documents(spark, small_pairs(range(1, 6), 20))
    assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in nd.near_duplicates(docs).collect())


def test_estimates_of_small_pairs():
    rng = np.random.default_rng(3)
    for n in (4, 8, 20):
        lost = 0
        for _ in range(300):
            x = rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
            p, q = (nd.bit_planes(nd.minima(s)).view(np.uint64) for s in (x, x[: n * 3 // 4]))
            diff = (p[: nd._LONGS] ^ q[: nd._LONGS]) | (p[nd._LONGS :] ^ q[nd._LONGS :])
            lost += nd.estimate(int(np.bitwise_count(diff).sum())) < nd.MIN_ESTIMATE
        assert lost <= 1
