from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import common
from tessera.llm.linededup import MOST_BITS, TwiceFilter, bits_for, dedup_lines, digest, twice_chunks, whole_filter
from tests.llm import data

STRIP = " \t\n\x0b\x0c\r"


def brute(rows):
    docs = defaultdict(set)
    key = lambda x: x.strip(STRIP).encode().lower().decode()
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40 and i is not None:
                docs[key(line)].add(i)
    keep = {k: max(v) for k, v in docs.items() if len(v) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or keep.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_equals_brute_force(spark, most):
    extra = ["É" * 40, "É" * 39 + "x", "  " + data.LICENSE.upper() + "\t", data.LICENSE + "\n" + data.LICENSE + "\n", None]
    docs = data.documents(spark, data.texts() + extra + ["É" * 40] * 5)
    docs = docs.union(docs.limit(20)).union(docs.limit(3).selectExpr("CAST(NULL AS long)", "text", "lang", "source", "n_chars"))
    got = dedup_lines(data.clashing(docs).repartition(5), filter_bits=1 << 18, most_keys=most)
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=repr)
    assert rows == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=repr)
    assert got.columns[-2:] == ["n_lines", "n_dropped"]


def test_other_columns_keep_their_names_and_values(spark):
    docs = data.clashing(data.documents(spark)).withColumnsRenamed({"t": "__new", "n": "__drop", "rep": "__id", "band": "a`b"})
    for most in (1_000_000, 0):
        got = dedup_lines(docs, counts=False, most_keys=most)
        assert got.columns == docs.columns and {r.n_lines for r in got.select("n_lines").collect()} == {"x"}


def test_the_filter_grows_with_the_table():
    sizes = [bits_for(n) for n in (0, 10**3, 10**5, 10**6, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == 1 << 24 and sizes[2] < sizes[3] and sizes[-1] == MOST_BITS


def test_a_hot_line_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    docs = data.documents(spark, data.texts() + [data.LICENSE] * 30)
    got = dedup_lines(docs, filter_bits=1 << 18, most_keys=0).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_empty_table(spark):
    assert dedup_lines(data.documents(spark).limit(0)).count() == 0


def test_filter_misses_no_repeat():
    rng = np.random.default_rng(0)
    keys = [digest(bytes(rng.integers(0, 256, 50, dtype=np.uint8))) for _ in range(3000)]
    a, b = TwiceFilter(1 << 18), TwiceFilter(1 << 18)
    a.add(keys[:2000])
    a.add(keys[:10])
    b.add(keys[1500:])
    twice = a.twice | b.twice | (a.once & b.once)
    from tessera.llm.linededup import bit_positions

    hit = TwiceFilter._has(twice, bit_positions(keys, 1 << 18)).all(axis=1)
    assert hit[:10].all() and hit[1500:2000].all() and hit.mean() < 0.35
    assert hashlib.blake2b(b"x", digest_size=16).digest() == digest(b"x")


def test_driver_holds_a_packed_filter(spark):
    line = "a line that two documents share, of forty characters and more"
    docs = data.documents(spark, [line, line, "another line of forty characters and more, alone"]).repartition(3)
    chunks = twice_chunks(docs, MOST_BITS, 40)
    assert 1 <= len(chunks) <= 4 and sum(map(len, chunks.values())) < 2000  # not the 64 MB of the whole
    from tessera.llm.linededup import bit_positions

    bits = whole_filter(chunks, MOST_BITS)
    assert len(bits) == MOST_BITS // 8 and TwiceFilter._has(bits, bit_positions([digest(line.encode())], MOST_BITS)).all()
