"""Op 7, SentencePiece encoding and decoding by an Aho-Corasick automaton.

The automaton holds all pieces. One pass over a text follows it character by character;
at each position the output links name every piece that ends there, and each relaxes the
best score of that position (Viterbi). A character that no piece covers costs `unknown`
and is written as its UTF-8 bytes' pieces.

Where no piece has a space mark after another character, a text can be cut before each
space run, and the parts' best paths put together are the text's. Parts already encoded
are kept in a store that starts anew when full and never changes a result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator, Sequence
from functools import cache

import hashlib
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import kept_store, lean, small_batches

SPACE = "▁"
SCHEMA = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, score double, decoded_sha256 string"


class Automaton:
    """Aho-Corasick over (word, payload) pairs: goto, failure and output links."""

    def __init__(self, words: Sequence[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.word = [-1]  # the word that ends at a node
        for i, word in enumerate(words):
            node = 0
            for ch in word:
                child = self.next[node].get(ch)
                if child is None:
                    child = self.next[node][ch] = len(self.next)
                    self.next.append({})
                    self.word.append(-1)
                node = child
            if node and self.word[node] < 0:
                self.word[node] = i
        self.fail = [0] * len(self.next)
        self.output = [0] * len(self.next)  # the nearest node down the failures with a word
        queue = deque(self.next[0].values())
        while queue:
            node = queue.popleft()
            for ch, child in self.next[node].items():
                f = self.fail[node]
                while f and ch not in self.next[f]:
                    f = self.fail[f]
                f = self.next[f].get(ch, 0)
                self.fail[child] = f
                self.output[child] = f if self.word[f] >= 0 else self.output[f]
                queue.append(child)

    def ends(self, node: int) -> list[int]:
        """All words that end at a node, longest first."""
        out = []
        if self.word[node] >= 0:
            out.append(self.word[node])
        node = self.output[node]
        while node:
            out.append(self.word[node])
            node = self.output[node]
        return out


class PieceModel:
    """Pieces and scores of a SentencePiece model file, read as a unigram model."""

    def __init__(self, pieces: Sequence[tuple[str, float, int]], byte_ids: dict[int, int], unknown: float, unk_id: int, most: int = 400_000) -> None:
        """pieces: (text, score, id) of ordinary pieces; byte_ids: byte -> id, or empty."""
        self.score = [s for _, s, _ in pieces]
        self.id = [i for _, _, i in pieces]
        self.length = [len(p) for p, _, _ in pieces]
        self.bytes, self.unknown, self.unk_id, self.most = byte_ids, unknown, unk_id, most
        self.automaton = Automaton([p for p, _, _ in pieces])
        a = self.automaton
        #: For each node what ends there as (length, score, id).
        self.ends = [tuple((self.length[w], self.score[w], self.id[w]) for w in a.ends(n)) for n in range(len(a.next))]
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p, _, _ in pieces)
        self.known: dict[str, tuple[bytes, float]] = {}
        self.text = {i: p.encode() for p, _, i in pieces} | {i: None for i in byte_ids.values()}
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.plain = {i: p.replace(SPACE, " ").encode() for p, _, i in pieces} | {i: bytes([b]) for b, i in byte_ids.items()}
        self.plain[unk_id] = b" \xe2\x81\x87 "

    @staticmethod
    @cache
    def load(path: str) -> PieceModel:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [(sp.id_to_piece(i), sp.get_score(i), i) for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        return PieceModel(plain, byte_ids, min(s for _, s, _ in plain) - 10.0, sp.unk_id())

    def best(self, text: str) -> tuple[list[int], float]:
        """The ids of the best path over a text whose spaces are marked, and its score.
        Of equal paths the one with the longer last piece is taken."""
        nexts, fail, ends_at = self.automaton.next, self.automaton.fail, self.ends
        low = float("-inf")
        best = [0.0]
        last: list[tuple[int, int]] = [(0, 0)]
        node = 0
        for i, ch in enumerate(text):
            step = nexts[node].get(ch)
            while step is None and node:
                node = fail[node]
                step = nexts[node].get(ch)
            node = step or 0
            top, came = low, (1, -1)
            single = False
            for length, score, piece in ends_at[node]:
                s = best[i + 1 - length] + score
                single |= length == 1
                if s > top:
                    top, came = s, (length, piece)
            if not single and best[i] + self.unknown > top:
                top, came = best[i] + self.unknown, (1, -1)
            best.append(top)
            last.append(came)
        ids: list[int] = []
        i = len(text)
        while i:
            length, piece = last[i]
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(text[i - 1].encode("utf-8", "replace")))
            else:
                ids.append(self.unk_id)
            i -= length
        return ids[::-1], best[-1]

    _parts = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def encode(self, text: str) -> tuple[bytes, float]:
        """Ids as native uint32 bytes, and the path's score. A text that isn't empty gets
        a space mark in front."""
        if not text:
            return b"", 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.apart:
            ids, score = self.best(marked)
            return array("I", ids).tobytes(), score
        if len(self.known) > self.most:
            self.known.clear()
        out, total, known = [], 0.0, self.known
        for part in self._parts.findall(marked):
            found = known.get(part)
            if found is None:
                ids, score = self.best(part)
                found = (array("I", ids).tobytes(), score)
                if len(part) <= 64:
                    known[part] = found
            out.append(found[0])
            total += found[1]
        return b"".join(out), total

    def decode(self, ids: Sequence[int]) -> bytes:
        """UTF-8 bytes of the text: pieces in a row, marks as spaces, without the first."""
        text = b"".join(map(self.plain.__getitem__, ids))
        return text[1:] if text.startswith(b" ") else text


kept_store(PieceModel.load.cache_clear)


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """One row a document: number of pieces and of byte pieces among them, crc32 of the
    ids (little-endian uint32), the path's score, and the SHA-256 of the text decoded
    from the ids.

    Null text is empty and has no pieces. Rows that share an id are encoded each; a null
    id stays null; an empty table gives no rows; other columns are not read."""
    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.load(model_path)
        is_byte = model.byte_of
        for batch in batches:
            for b in range(0, batch.num_rows, 256):
                out = []
                for text in batch.column(1).slice(b, 256).to_pylist():
                    raw, score = model.encode(text)
                    ids = array("I")
                    ids.frombytes(raw)
                    decoded = model.decode(ids)
                    n_bytes = sum(map(is_byte.__contains__, ids))
                    out.append((len(ids), n_bytes, zlib.crc32(raw), score, hashlib.sha256(decoded).hexdigest()))
                n, nb, crc, score, sha = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b, 256), pa.array(n, pa.int64()), pa.array(nb, pa.int64()), pa.array(crc, pa.int64()), pa.array(score, pa.float64()), pa.array(sha, pa.string())],
                    [x.split()[0] for x in SCHEMA.split(", ")],
                )

    return rows.mapInArrow(lean("pieces", run), SCHEMA)
