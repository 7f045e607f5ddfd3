from __future__ import annotations

import zlib
from array import array

import public_tokenizers as P
import pytest

from tessera.llm.pieces import SPACE, Automaton, PieceModel, encode_texts
from tests.llm import data

PATH = P.path("piece_bpe_32k.model")


def best_by_table(model, pieces, text):
    """Plain Viterbi over all substrings."""
    score = {p: s for p, s, _ in pieces}
    best = [0.0] + [float("-inf")] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - 20), j):
            s = score.get(text[i:j], model.unknown if j - i == 1 else None)
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PATH)


def test_automaton_finds_all_ends():
    words = ["he", "she", "his", "hers", "e"]
    a = Automaton(words)
    node, found = 0, []
    for ch in "ushers":
        while node and ch not in a.next[node]:
            node = a.fail[node]
        node = a.next[node].get(ch, 0)
        found.append([words[w] for w in a.ends(node)])
    assert found == [[], [], [], ["she", "he", "e"], [], ["hers"]]


def test_best_scores_and_round_trip(model):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PATH)
    pieces = [(sp.id_to_piece(i), sp.get_score(i), i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    odd = ["", " ", "a", "  two  spaces ", "new\n\nline", "日本語 ☃ é", "x" * 300, "tab\tand\x0bmore"]
    for text in [t for t in data.texts(24) if t][:20] + odd:
        raw, score = model.encode(text)
        ids = array("I")
        ids.frombytes(raw)
        assert model.decode(ids) == text.encode()
        if text and len(text) < 1000:
            marked = SPACE + text.replace(" ", SPACE)
            assert score == best_by_table(model, pieces, marked)
            assert model.best(marked) == (list(ids), score)


def test_without_bytes_unknown_is_one_id():
    m = PieceModel([(SPACE + "a", -1.0, 3), ("b", -2.0, 4)], {}, -20.0, 0)
    ids = array("I")
    ids.frombytes(m.encode("ab☃")[0])
    assert ids.tolist() == [3, 4, 0]


def test_query_rows(spark):
    import hashlib

    docs = data.clashing(data.documents(spark))
    rows = {r.doc_id: r for r in encode_texts(docs.union(docs.limit(2)), PATH).collect()}
    assert len(rows) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert rows[0].n_pieces == 0 and rows[0].ids_crc32 == zlib.crc32(b"")
    assert encode_texts(docs.limit(0), PATH).count() == 0
