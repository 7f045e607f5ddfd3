"""Token ids of whole texts by a public tokenizer, one white-space word at a time."""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Iterable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tessera.llm.common import kept_store

#: Letters from here on may change with their neighbours, or with composition.
NOT_LATIN = "\u0130"
#: ASCII marks that are one piece in a row after a letter (an apostrophe may join what
#: follows); of so many, or fewer, the ids are kept.
MARKS, MOST_MARKS = "".join(c for c in string.punctuation if c != "'"), 3


def _byte_level() -> dict[int, str]:
    """The character that a byte-level vocabulary has for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LEVEL = _byte_level()


def _table(chars: Iterable[int]) -> np.ndarray:
    """For each byte, whether it is one of these."""
    return np.isin(np.arange(256), list(chars))


IS_MARK = _table(MARKS.encode())
IS_LETTER = _table(string.ascii_letters.encode())
#: Second bytes of the letters after U+00BF by their first byte: \u00c0 to \u00ff without \u00d7 and
#: \u00f7, and \u0100 to \u012f.
LATIN = {0xC3: _table(set(range(0x80, 0xC0)) - {0x97, 0xB7}), 0xC4: _table(range(0x80, 0xB0))}


def _words(texts: list[bytes]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Where each text's words begin among all, and all words, ASCII case folded."""
    folded = [text if b"\xcc" in text or b"\xcd" in text else text.lower() for text in texts]
    # Large types: one text's ids may have more bytes than 32 bits count. White space at
    # a text's ends makes empty words, which have no ids.
    words = pc.ascii_split_whitespace(pa.array(folded, pa.large_binary()).view(pa.large_string()))
    return words.offsets.to_numpy(), words.values.dictionary_encode()


def _parts(values: pa.Array, copied: bool = True) -> tuple[np.ndarray, bytes | memoryview]:
    """Where the values of a whole large array begin and end, and their bytes."""
    _, offsets, data = values.buffers()
    raw = memoryview(data or b"")
    return np.frombuffer(offsets, np.int64)[: len(values) + 1], raw.tobytes() if copied else raw


def _marks_at_end(at: np.ndarray, raw: bytes) -> np.ndarray:
    """For each word, how many marks come after its last Latin letter, if it ends in such
    a letter and at most MOST_MARKS marks; else 0."""
    data, start, end = np.frombuffer(b"\0\0" + raw, np.uint8), at[:-1] + 2, at[1:] + 2
    n = np.zeros(len(start), np.int64)
    for _ in range(MOST_MARKS + 1):
        n += (end - n > start) & IS_MARK[data[end - n - 1]]
    last = end - n - 1
    letter = IS_LETTER[data[last]]
    for lead, seconds in LATIN.items():
        letter |= (last > start) & (data[last - 1] == lead) & seconds[data[last]]
    return np.where((n <= MOST_MARKS) & (last >= start) & letter, n, 0)


class WordTokenizer:
    """Encodes texts through a store of words already encoded.

    The tokenizer folds case, drops white space and never joins what white space
    separates, so a text's ids are its words' ids in a row. ASCII case is folded first
    (unless a combining mark might compose differently then). Arrow splits a batch and finds
    its distinct words, and puts their ids in their places; Python sees each distinct word
    once. One that ends in a Latin letter and a few marks is what comes before the marks, and
    the marks. A word of Latin letters is one piece, which the model takes as it is; other
    new words of a batch are encoded in one call, between separators that can be found again
    in the ids.
    The store has two halves of `most` words: when one is full it becomes the old half,
    whose words move over as they are met again, and the old one before it goes. What
    the store holds never changes a result."""

    def __init__(self, path: str, most: int = 300_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Words of Latin letters are one piece each and need no normaliser but lower().
        self.model = self.tokenizer.model
        self.most = most
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    @staticmethod
    @cache
    def shared(path: str) -> WordTokenizer:
        """One for each worker process and path."""
        return WordTokenizer(path)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """For each UTF-8 text its ids, as little-endian uint32 bytes."""
        return [ids for ids, _ in self.ids_and_heads(texts, [0] * len(texts))]

    def ids_and_heads(self, texts: list[bytes], heads: list[int]) -> list[tuple[bytes, int]]:
        """The ids of each text, and how many of them its first head bytes have; these
        must end before white space, or be none."""
        if not texts:
            return []
        first, coded = _words(texts)
        found = pa.array(self._found(*_parts(coded.dictionary)), pa.large_binary()).take(coded.indices)
        del coded
        at, raw = _parts(found, copied=False)
        ends = at[first].tolist()
        n = [len(text[:head].split()) + text[:1].isspace() if head else 0 for text, head in zip(texts, heads, strict=True)]
        head_ends = at[first[:-1] + n].tolist()
        return [(bytes(raw[i:j]), (k - i) // 4) for i, j, k in zip(ends[:-1], ends[1:], head_ends, strict=True)]

    def _found(self, at: np.ndarray, raw: bytes) -> list[bytes]:
        """The ids of each of some distinct words: those of what comes before the marks at
        its end, and those of the marks."""
        if len(self.known) > self.most:
            self.old, self.known = self.known, {}
        known, marks = self.known, self.marks
        cut = _marks_at_end(at, raw)
        words = [raw[i:j] for i, j in zip(at[:-1].tolist(), (at[1:] - cut).tolist(), strict=True)]
        found = list(map(known.get, words))
        if gaps := [i for i, ids in enumerate(found) if ids is None]:
            self._learn({words[i] for i in gaps})
            for i in gaps:
                found[i] = known[words[i]]
        cuts = np.flatnonzero(cut)
        ends = at[cuts + 1]
        for i, j, k in zip(cuts.tolist(), (ends - cut[cuts]).tolist(), ends.tolist(), strict=True):
            end = raw[j:k]
            if end not in marks:
                marks[end] = np.array(self._one(end.decode()), np.uint32).tobytes()
            found[i] += marks[end]
        return found

    def _learn(self, new: set[bytes]) -> None:
        known, old = self.known, self.old
        other = []
        for word in new:
            if (found := old.get(word)) is not None:
                known[word] = found
                continue
            text = word.decode("utf-8", "replace")
            if text.isalpha() and (text.isascii() or max(text) < NOT_LATIN):
                known[word] = self._latin(text)
            else:
                other.append((word, text))
        self._encode(other)

    def _latin(self, text: str) -> bytes:
        """The ids of a word of Latin letters."""
        piece = text.lower()
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(BYTE_LEVEL)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _encode(self, pairs: list[tuple[bytes, str]], mark: str = "☃☃") -> None:
        """Stores the ids of each (word, text), 2000 in a call between marks."""
        cut = np.array(self._one(mark), np.uint32)
        k = len(cut)
        for i in range(0, len(pairs), 2000):
            some = pairs[i : i + 2000]
            texts = [t if "☃" not in t else "a" for _, t in some]
            line = f" {mark} ".join(["", *texts, ""])
            ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            hit = ids[: len(ids) - k + 1] == cut[0]
            for j in range(1, k):
                hit &= ids[j : len(ids) - k + 1 + j] == cut[j]
            at = np.flatnonzero(hit)
            if len(at) == len(some) + 1:
                raw, ends = ids.tobytes(), (4 * at).tolist()
                for (word, _), a, b in zip(some, ends[:-1], ends[1:], strict=True):
                    self.known[word] = raw[a + 4 * k : b]
                some = [x for x in some if "☃" in x[1]]
            for word, text in some:  # what looks like the mark itself is encoded alone
                self.known[word] = np.array(self._one(text), np.uint32).tobytes()

    def _one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


kept_store(WordTokenizer.shared.cache_clear)
