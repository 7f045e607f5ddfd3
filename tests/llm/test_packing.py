from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tessera.llm import packing
from tessera.llm.packing import Limits, Packer, pack_texts
from tessera.llm.tokens import WordTokenizer
from tests.llm import data

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("text", ["", "It's 'S 'll. don't, x.y ,,. a  b", "ÀÉ H̱ ẖ ß İ ΑΣ. ΑΣ", "☃☃ a ☃", "<|endoftext|>. <|endoftext|>", "a\x1cb \x85c d e", "o'. 's, 12. 1,2 x1."])
def test_words_give_the_texts_ids(text):
    t = WordTokenizer(PATH)
    assert t.ids([text.encode()])[0] == np.array(t._one(text), np.uint32).tobytes()
    assert t.ids([text.encode()])[0] == np.array(t._one(text), np.uint32).tobytes()  # from the store


def test_a_full_store_changes_nothing():
    t, small = WordTokenizer(PATH), WordTokenizer(PATH, most=3)
    given = [x.encode() for x in data.texts() if x]
    assert [t.ids([x]) for x in given] == [small.ids([x]) for x in given]


def test_latin_words_go_to_the_model_alone(monkeypatch):
    t, sent = WordTokenizer(PATH), []
    letters = [chr(c) for c in range(0x41, 0x130) if chr(c).isalpha()]
    marks = [a + b for a in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" for b in ("", ".", "##")]
    words = letters + ["word" + m for m in marks] + ["caf\u00e9" + m for m in marks] + ["\u00c0\u00c9\u00ff\u00f1oas", "stra\u00dfe!?", "w" * 3000]
    odd = ["don't.", "'s.", "x'", "a'.", "o''", "a.b.c,", "1a.", "a1#", "a....", "\u0130.", "\u0391\u03a3.", "e\u0301.", "\u00e9\u0301,", "=\u0338", "a=\u0338", "\u2603.", "\u2603\u2603,"]
    real = t._encode
    monkeypatch.setattr(t, "_encode", lambda pairs: (sent.extend(x for _, x in pairs), real(pairs)))
    for some in (words, odd, words + odd):
        text = " ".join(some)
        for _ in range(2):  # the second time from the store
            assert t.ids([text.encode()])[0] == np.array(t._one(text), np.uint32).tobytes()
            assert [t.ids([w.encode()])[0] for w in some] == [np.array(t._one(w), np.uint32).tobytes() for w in some]
        if some is words:
            assert not sent


def test_a_word_is_kept_without_its_marks():
    t = WordTokenizer(PATH)
    some = ["word word. Word, (word) caf\u00e9 caf\u00e9!? WORD..."] * 3
    assert t.ids([x.encode() for x in some]) == [np.array(t._one(x), np.uint32).tobytes() for x in some]
    assert sorted(x.decode() for x in t.known) == ["(word", "caf\u00e9", "word"]


def test_odd_bytes_and_heads():
    t, rng = WordTokenizer(PATH), np.random.default_rng(4)
    parts = [bytes([c]) for c in b" \t\n\x0b\x0c\r\x1c\x1f.,'#1aZ"] + [b"\xc3\x89", b"\xc3\x97", b"\xc4\xaf", b"\xc4\xb0", b"\xcc\x81", b"\xc3", b"\x80", b"\xff"]
    texts = [b"", b" ", b"\n.", b"\xc3", b"a", b".", *(b"".join(rng.choice(parts, 30)) for _ in range(500))]
    alone = [np.array(t._one(x.decode("utf-8", "replace")), np.uint32).tobytes() for x in texts]
    assert t.ids(texts) == alone and t.ids([]) == []
    heads = [max(0, x.find(b"\n")) for x in texts]
    found = t.ids_and_heads(texts, heads)
    assert [n for _, n in found] == [len(t._one(x[:h].decode("utf-8", "replace"))) for x, h in zip(texts, heads, strict=True)]
    assert [ids for ids, _ in found] == alone


def check(rows, limits=Limits()):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == list(np.cumsum([0] + [p["length"] for p in pieces])[:-1])
        used = sum(p["length"] for p in pieces)
        assert used <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p["loss_tokens"] for p in pieces) <= limits.loss_tokens
        assert pieces[0]["sequence_length"] == (used if used & (used - 1) == 0 else limits.tokens)
    return by


def test_every_id_once(spark):
    docs = data.clashing(data.documents(spark))
    rows = [r.asDict() for r in pack_texts(docs.repartition(3), PATH).collect()]
    check(rows)
    t = WordTokenizer(PATH)
    for r in docs.select("doc_id", "text").collect():
        ids = t._one(r.text or "") + [2]
        own = sorted((x for x in rows if x["doc_id"] == r.doc_id), key=lambda x: x["start"])
        at = 0
        for x in own:
            assert x["start"] == at and x["doc_tokens"] == len(ids)
            assert x["ids_crc32"] == zlib.crc32(np.array(ids[at : at + x["length"]], np.uint32).tobytes())
            at += x["length"]
        assert at == len(ids)
    padded = sum(s[0]["sequence_length"] - sum(p["length"] for p in s) for s in check(rows).values())
    assert padded == 0


def test_empty_and_repeated_rows(spark):
    docs = data.documents(spark, ["a b c", None])
    assert pack_texts(docs.limit(0), PATH).count() == 0
    assert pack_texts(docs.union(docs), PATH).count() >= 4


def test_limits_hold_together():
    limits = Limits(tokens=64, segments=4, loss_tokens=40)
    packer = Packer(limits, 0, pool=32)
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 100, 300)
    for i, n in enumerate(sizes):
        packer.add(i, bytes(4 * int(n)), int(n) * (i % 3) // 2)
    packer.finish()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "sequence_length"]
    rows = [dict(zip(names, r, strict=True)) for r in packer.out]
    check(rows, limits)
    assert [sum(r["length"] for r in rows if r["doc_id"] == i) for i in range(300)] == sizes.tolist()


def packed(examples, limits, pool=64):
    packer = Packer(limits, 0, pool)
    for i, (n, prompt) in enumerate(examples):
        packer.add(i, bytes(4 * n), prompt)
    packer.finish()
    by = {}
    for key, start, n, _, _, sequence, _, loss, _ in packer.out:
        by.setdefault(sequence, []).append((key, start, n, loss))
    return by


def test_each_limit_binds():
    rng = np.random.default_rng(1)
    limits = Limits(tokens=64, segments=4, loss_tokens=56)
    short = packed([(3, 3)] * 200, limits).values()
    assert any(len(s) == 4 and sum(p[2] for p in s) < 64 for s in short)
    answers = packed([(50, 0)] * 40, limits).values()
    assert all(sum(p[2] for p in s) <= 32 for s in answers)  # 56 answers would need prompts
    mixed = packed([(int(n), int(n * f)) for n, f in zip(rng.integers(5, 150, 400), rng.random(400) / 3, strict=True)], limits).values()
    assert any(sum(p[2] for p in s) == 64 for s in mixed) and any(sum(p[3] for p in s) == 56 for s in mixed)


def test_the_product_is_not_largest_fit(monkeypatch):
    rng = np.random.default_rng(2)
    examples = [(int(n), int(n * f)) for n, f in zip(rng.integers(5, 60, 500), rng.random(500), strict=True)]
    limits = Limits(tokens=64, segments=8, loss_tokens=40)
    by_product = packed(examples, limits)
    monkeypatch.setattr(packing, "product", lambda limits, need, *_: need)
    assert by_product != packed(examples, limits)


def test_choices_equal_brute_force():
    limits = Limits(tokens=64, segments=4, loss_tokens=48)
    rng = np.random.default_rng(3)
    examples = [(int(n), int(n * f)) for n, f in zip(rng.integers(5, 60, 40), rng.random(40), strict=True)]
    first = packed(examples, limits, pool=64)[0]
    asks = [(min(n, 64, p + 48), p) for n, p in examples]  # of a large one, a part
    pool = {i: (n, max(0, n - p)) for i, (n, p) in enumerate(asks)}
    left = [64, 4, 48]
    for key, start, n, _ in first:
        fit = {i: d for i, d in pool.items() if d[0] <= left[0] and d[1] <= left[2]}
        if not fit or left[1] == 1:
            break
        dot = {i: d[0] / 64 * left[0] / 64 + 1 / 4 * left[1] / 4 + d[1] / 48 * left[2] / 48 for i, d in fit.items()}
        assert start == 0 and n == asks[key][0] and dot[key] >= max(dot.values()) - 1e-12
        left = [left[0] - pool[key][0], left[1] - 1, left[2] - pool[key][1]]
        if asks[key][0] < examples[key][0]:
            break  # its rest is in the pool now
        del pool[key]


@pytest.mark.parametrize("wrong", [{"tokens": 0}, {"segments": 0}, {"loss_tokens": 0}])
def test_limits_below_one_are_refused(wrong):
    with pytest.raises(ValueError):
        Limits(**wrong)


def test_the_prompt_bears_no_loss(spark):
    docs = data.documents(spark, ["two words\nan answer", "no line end", "\nall answer", None])
    rows = {r.doc_id: r for r in pack_texts(docs.coalesce(1), PATH, limits=Limits(64, 8, 64)).collect() if r.start == 0}
    t = WordTokenizer(PATH)
    assert rows[0].loss_tokens == rows[0].length - min(rows[0].length, len(t._one("two words")))
    assert all(rows[i].loss_tokens == rows[i].length for i in (1, 2, 3))


def test_a_long_text_is_cut_through(spark, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 5000)
    docs = data.documents(spark, ["ask me\n" + "word " * 40_000, "short"])
    rows = [r.asDict() for r in pack_texts(docs.coalesce(1), PATH).collect()]
    check(rows)
    assert sum(r["length"] for r in rows) > 40_000


def test_loss_column(spark):
    docs = spark.createDataFrame([(0, "a b c", True), (1, "d e f g", False), (2, "h", None)], "doc_id long, text string, own boolean")
    rows = {r.doc_id: r.loss_tokens for r in pack_texts(docs.coalesce(1), PATH, loss_col="own").collect() if r.start == 0}
    assert rows[0] > 0 and rows[1] == 0 and rows[2] == 0


def test_a_pool_of_tiny_texts(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, '') AS text").coalesce(1)
    rows = [r.asDict() for r in pack_texts(docs, PATH).collect()]
    assert sorted(r["doc_id"] for r in rows) == list(range(5000)) and all(r["length"] == 1 for r in rows)
    assert all(s[0]["sequence_length"] == len(s) for s in check(rows).values())
