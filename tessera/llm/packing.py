"""Op 1, packing: vector bin packing with the dot-product heuristic.

Every example asks for three things at once: tokens, one segment, and loss-bearing
tokens. A sequence (bin) offers `Limits`, which bind separately: a response without
prompts to go with it runs out of loss, short texts run out of segments. The next example
is the one whose demand has the largest dot product with what the open bin has left, both
in units of the limits; when none fits whole, or one segment is left, the one is cut that
fills most of the bin. Of an example larger than a bin, the next part as large as one asks
for a place. A bin that can't be filled gives back what it holds beyond a power of two.

An example is an instruction and its response: tokens up to the first `prompt_end` of a
text bear no loss, those after it do; a text without one bears loss throughout.

A task packs its own rows from a bounded pool (of POOL examples and POOL_TOKENS tokens),
so there is no shuffle and memory doesn't grow with the input. Its last tokens, and those
of a pool full of tiny pieces, go to sequences whose lengths are powers of two, which need
no padding. What lies in which sequence depends on how rows are dealt over tasks and on
their order; of equal products the example that is first in the pool wins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, small_batches
from tessera.llm.tokens import WordTokenizer

END_ID = 2


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most; each at least 1."""

    tokens: int = 4096
    segments: int = 16
    loss_tokens: int = 3968

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError(f"limits must be at least 1: {self}")


POOL, POOL_TOKENS = 1024, 2_000_000
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long, sequence_length long"
)


def product(limits: Limits, need: np.ndarray, need_loss: np.ndarray, tokens: int, segments: int, loss: int) -> np.ndarray:
    """Dot products of demands with what a sequence has left, in units of the limits."""
    return need * (tokens / limits.tokens**2) + need_loss * (loss / limits.loss_tokens**2) + segments / limits.segments**2


class Packer:
    """Packs examples (key, ids as little-endian uint32 bytes, ids that bear no loss)."""

    def __init__(self, limits: Limits, first_id: int, pool: int = POOL) -> None:
        self.limits, self.next_id, self.most = limits, first_id, pool
        self.keys: list = []
        self.ids: list[bytes] = []
        room = pool + limits.segments  # a closed sequence may give pieces back
        self.starts = np.zeros(room, np.int64)
        self.left = np.zeros(room, np.int64)
        self.free = np.zeros(room, np.int64)  # of those left, the first that bear no loss
        self.n = self.held = 0
        self.out: list[tuple] = []

    def add(self, key: int | None, ids: bytes, prompt: int = 0) -> None:
        """Takes an example in whose first `prompt` ids bear no loss."""
        if self.n >= self.most:
            self._drain(self.most // 2)
            while self.n >= self.most:  # of tiny pieces even a full pool fills no sequence
                self._fill_rest()
        self._put(key, ids, 0, len(ids) // 4, prompt)
        while self.held > POOL_TOKENS:
            self._fill(self.limits.tokens)

    def finish(self) -> None:
        self._drain(0)
        while self.n:
            self._fill_rest()

    def _put(self, key: int | None, ids: bytes, start: int, n: int, free: int) -> None:
        if n:
            i = self.n
            self.keys[i:], self.ids[i:] = [key], [ids]
            self.starts[i], self.left[i], self.free[i] = start, n, min(free, n)
            self.n, self.held = i + 1, self.held + n

    def _fill_rest(self) -> None:
        self._fill(min(self.limits.tokens, 1 << (self.held.bit_length() - 1)))

    def _drain(self, keep: int) -> None:
        while self.n > keep and self.held >= self.limits.tokens:
            self._fill(self.limits.tokens)

    def _fill(self, size: int) -> None:
        """Fills and closes one sequence of at most `size` tokens."""
        tokens, segments, loss = size, self.limits.segments, self.limits.loss_tokens
        taken = []
        while tokens and segments and self.n:
            n = self.n
            need, free = self.left[:n], self.free[:n]
            ask = np.minimum(need, np.minimum(self.limits.tokens, free + self.limits.loss_tokens))
            ask_loss = np.maximum(ask - free, 0)
            fits = (ask <= tokens) & (ask_loss <= loss)
            score = product(self.limits, ask, ask_loss, tokens, segments, loss)
            best = int(np.argmax(np.where(fits, score, -1.0)))
            if segments == 1 or not fits[best]:
                # Of those that fill as much, the one with the shortest prompt: prompts are scarce.
                best = int(np.lexsort((free, -np.minimum(need, np.minimum(tokens, free + loss))))[0])
            n_free = int(free[best])
            take = min(int(ask[best]), tokens, n_free + loss)
            if not take:
                break
            taken.append((self.keys[best], self.ids[best], int(self.starts[best]), take, min(n_free, take)))
            tokens, segments, loss = tokens - take, segments - 1, loss - max(0, take - n_free)
            self.held -= take
            if take == need[best]:
                self._remove(best)
            else:
                self.starts[best] += take
                self.left[best] -= take
                self.free[best] = max(0, n_free - take)
        self._close(taken, size - tokens)

    def _remove(self, i: int) -> None:
        last = self.n = self.n - 1
        for column in (self.starts, self.left, self.free):
            column[i] = column[last]
        self.keys[i], self.ids[i] = self.keys[last], self.ids[last]
        self.keys.pop(), self.ids.pop()

    def _close(self, pieces: list[tuple], used: int) -> None:
        """Closes a sequence; one that isn't full gives back what is over a power of two."""
        length = used if used == self.limits.tokens else 1 << (used.bit_length() - 1)
        over = used - length
        while over:
            key, ids, start, n, free = pieces.pop()
            back = min(over, n)
            over -= back
            if back < n:
                pieces.append((key, ids, start, n - back, min(free, n - back)))
            self._put(key, ids, start + n - back, back, max(0, free - (n - back)))
        at = 0
        for key, ids, start, n, free in pieces:
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])
            self.out.append((key, start, n, crc, len(ids) // 4, self.next_id, at, n - free, length))
            at += n
        self.next_id += 1

    def rows(self) -> pa.RecordBatch:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        columns = list(zip(*self.out, strict=True)) or [()] * len(names)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack_texts(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_col: str | None = None,
    prompt_end: str | None = "\n",
    limits: Limits = Limits(),
    end_id: int = END_ID,
) -> DataFrame:
    """One row for each piece of each text's ids (its tokens, then end_id).

    prompt_end: of a text that holds it, the tokens before bear no loss (None: all do).
    loss_col: boolean column, true where a row bears loss at all (null: false). Null and
    empty texts are one id, end_id. Rows that share an id are examples of their own; a
    null id stays null. An empty table gives no rows. Other columns are not read. Sequence
    ids are unique: the task's number in the high bits. sequence_length is the length with
    padding: there is none unless the token limit isn't a power of two."""
    small_batches(docs)
    loss = F.coalesce(F.col(loss_col), F.lit(False)) if loss_col else F.lit(True)
    rows = docs.select(
        F.col(id_col).cast("long").alias("k"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"),
        loss.cast("boolean").alias("l"),
    )
    end = int(end_id).to_bytes(4, "little")
    cut = prompt_end.encode() if prompt_end else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.shared(tokenizer_path)
        packer = Packer(limits, TaskContext.get().partitionId() << 40)
        for batch in batches:
            keys, losses = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = batch.column(1).to_pylist()
            heads = [max(0, t.find(cut)) if cut else 0 for t in texts]
            for key, (ids, prompt), bears in zip(keys, encode.ids_and_heads(texts, heads), losses, strict=True):
                packer.add(key, ids + end, prompt if bears else len(ids) // 4 + 1)
            if packer.out:
                yield packer.rows()
        packer.finish()
        if packer.out:
            yield packer.rows()

    return rows.mapInArrow(lean("packing", run), SCHEMA)
