"""Op 9, language-model scoring by context-tree weighting over bytes.

Bytes are coded bit by bit, high bit first. Each bit has one node for each depth of
context, 0 to DEPTH bytes, told apart by the bits of the byte so far; a node estimates by
Krichevsky and Trofimov, and P_w = P_e / 2 + product of its children's P_w / 2 mixes all
depths. Block probabilities depend on counts alone, so training is one aggregation of the
counts of (context, byte) cells over all texts; cells met in held-out texts alone count 0.

The tree is never in one place. Its cells are dealt by their nearest MIDDLE bytes; each
task weighs the nodes of its contexts from DEPTH up to MIDDLE and sends what their parents
need. The level above is dealt in the same way; the two top levels, 2**17 rows at most
whatever the corpus, are weighed on the driver.
On the way down each node turns the deeper levels' probability of a one, p, into a + b * p,
which gives every cell its log10 probability: a table that grows with the corpus.

Scoring looks that table up, a byte at a time. Up to `most_cells` cells (and `most_words`
words, for the base score) it is broadcast. Beyond, texts are put in blocks of some MB, each
block asks for its distinct keys once, and keys meet the table in a join. Both ways read
the same table with the same code, so scores are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, materialize, runs, small_batches
from tessera.llm.shingles import word_hashes

#: Bytes of context; those that cells are dealt by, of which there are at most 2**24.
DEPTH, MIDDLE = 5, 3
#: A byte that UTF-8 never holds: the end, and what stands before the start.
END = 0xFF
#: What is broadcast at most: 12 bytes a cell, 16 a word.
MOST_CELLS, MOST_WORDS = 4_000_000, 4_000_000
#: Bytes of texts that ask for their keys together, in the join.
BLOCK_BYTES = 8 << 20
#: Stands for the end of a text among hashed words.
END_WORD = np.uint64(0xE0D0E0D0E0D0E0D1)
WORDS, CELLS = 0, 1


def cells(text: bytes) -> np.ndarray:
    """For each byte of a lower-cased text and its end: the last DEPTH bytes, the nearest
    highest, and the byte."""
    b = np.empty(len(text) + DEPTH + 1, np.uint64)
    b[:DEPTH] = END
    b[DEPTH:-1] = np.frombuffer(text, np.uint8)
    b[-1] = END
    key = b[DEPTH:].copy()
    n = len(key)
    for d in range(1, DEPTH + 1):
        key |= b[DEPTH - d : DEPTH - d + n] << np.uint64(8 * (DEPTH + 1 - d))
    return key


def words_of(text: bytes) -> np.ndarray:
    return np.append(word_hashes(text), END_WORD)


_HALF = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 256) - 0.5))]) + 0.5 * np.log(np.pi)
_WHOLE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 256)))])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x of 100 or more, by Stirling's series."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov block probability of a zeros and b ones."""

    def half(n: np.ndarray) -> np.ndarray:
        return np.where(n < 200, _HALF[np.minimum(n, 255)], _log_gamma(np.maximum(n, 100) + 0.5))

    n = a + b
    whole = np.where(n < 200, _WHOLE[np.minimum(n, 255)], _log_gamma(np.maximum(n, 100) + 1.0))
    return half(a) + half(b) - whole - np.log(np.pi)


# -------------------------------------------------------------------------- tree


def _sums(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some, at = np.unique(ids, return_inverse=True)
    return some, np.bincount(at, values, len(some))


def _value(ids: np.ndarray, keys: np.ndarray, values: np.ndarray, default: float) -> np.ndarray:
    """values at the places of ids in keys (sorted)."""
    if not len(keys):
        return np.full(len(ids), default)
    at = np.minimum(np.searchsorted(keys, ids), len(keys) - 1)
    return np.where(keys[at] == ids, values[at], default)


class Levels:
    """The levels `low` to `high` of the tree, for whole contexts of depth `low`.

    keys: cells (context << 8 | byte) at depth `high`, sorted; n: their counts. A node is
    named context << 8 | 1 and the bits so far. below: for each node at depth `high` the
    sum of its children's logs (ids, sums), None if they are the deepest level."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, low: int, high: int, below: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        self.keys, self.low, self.high, self.below = keys.astype(np.uint64), low, high, below
        self.depths = range(low, high + 1)
        self.cells = {d: _sums(self._at(d), n) for d in self.depths}
        self.upto = {d: np.concatenate([[0], np.cumsum(n.astype(np.int64))]) for d, (_, n) in self.cells.items()}
        #: (depth, bit) -> the nodes, their zeros and ones, the weight of their own estimate.
        self.nodes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        ups = [self._up(k) for k in range(8)]
        #: The sums that the nodes at depth low - 1 need.
        self.up = _sums(np.concatenate([u[0] for u in ups]), np.concatenate([u[1] for u in ups]))

    def _at(self, depth: int) -> np.ndarray:
        near = self.keys >> np.uint64(8 * (self.high + 1 - depth)) if depth else np.zeros_like(self.keys)
        return (near << np.uint64(8)) | (self.keys & np.uint64(255))

    @staticmethod
    def _named(cell: np.ndarray, k: int) -> np.ndarray:
        byte = cell & np.uint64(255)
        return (cell ^ byte) | np.uint64(1 << k) | (byte >> np.uint64(8 - k))

    @staticmethod
    def _parent(ids: np.ndarray) -> np.ndarray:
        """A node's context without its farthest byte, and the same bits."""
        return ((ids >> np.uint64(16)) << np.uint64(8)) | (ids & np.uint64(255))

    def _up(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        children: tuple[np.ndarray, np.ndarray] | None = self.below
        for depth in reversed(self.depths):
            keys, upto = self.cells[depth][0], self.upto[depth]
            first = np.unique((keys >> np.uint64(8 - k)) << np.uint64(8 - k))
            a, b, c = (upto[np.searchsorted(keys, first + np.uint64(x))] for x in (0, 1 << (7 - k), 1 << (8 - k)))
            ids, mixed, weight = self._named(first, k), log_kt(b - a, c - b), np.ones(len(first))
            if children is not None:
                deeper = _value(ids, *children, 0.0)
                weight = 1.0 / (1.0 + np.exp(np.clip(deeper - mixed, -700, 700)))
                mixed = np.logaddexp(mixed, deeper) - np.log(2.0)
            self.nodes[depth, k] = ids, b - a, c - b, weight
            children = _sums(self._parent(ids), mixed)
        return children

    def _down(self, k: int, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes of bit k at depth `high`, and the a and b of each."""
        for depth in self.depths:
            ids, zeros, ones, weight = self.nodes[depth, k]
            a, b = np.zeros(len(ids)), np.ones(len(ids))
            if above is not None:
                parent = self._parent(ids)
                a, b = _value(parent, above[0], above[1], 0.0), _value(parent, above[0], above[2], 1.0)
            own = weight * (ones + 0.5) / (zeros + ones + 1.0)
            above = ids, a + b * own, b * (1 - weight)
        return above

    def down(self, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, a, b) of the nodes at depth `high`, given those at depth low - 1."""
        parts = [self._down(k, above) for k in range(8)]
        ids, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(ids)
        return ids[order], a[order], b[order]

    def log10(self, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> np.ndarray:
        """log10 probabilities of the cells, where `high` is the deepest level."""
        total = np.zeros(len(self.keys))
        for k in range(8):
            ids, one, _ = self._down(k, above)
            p = one[np.searchsorted(ids, self._named(self.keys, k))]
            bit = (self.keys >> np.uint64(7 - k)) & np.uint64(1)
            total += np.log10(np.where(bit == 1, p, 1.0 - p))
        return total


def _chunks(batches: Iterator[pa.RecordBatch], group: str, most: int = 200_000) -> Iterator[pa.Table]:
    """Rows in tables of whole groups, of about `most` rows; batches are sorted by group."""
    held: list[pa.Table] = []
    for t in runs(batches, group):
        held.append(t)
        if sum(len(x) for x in held) >= most:
            yield pa.concat_tables(held)
            held = []
    if held:
        yield pa.concat_tables(held)


def _numbers(t: pa.Table, name: str, kind: int, as_kind: type = np.uint64) -> np.ndarray:
    column = t.filter(pc.equal(t.column("kind"), kind)).column(name).to_numpy()
    return column.astype(as_kind)


_SUMS = "kind int, id long, v double"


def _sum_rows(levels: Levels) -> Iterator[pa.RecordBatch]:
    """What the level above needs: counts of its cells (CELLS) and sums of logs (0)."""
    keys, n = levels.cells[levels.low]
    counts = _sums(levels._parent(keys), n)
    for kind, (ids, v) in ((CELLS, counts), (0, levels.up)):
        kinds = pa.array(np.full(len(ids), kind, np.int32))
        yield pa.RecordBatch.from_arrays([kinds, pa.array(ids.view(np.int64)), pa.array(v.astype(float))], ["kind", "id", "v"])


def _middle(t: pa.Table) -> Levels:
    """Levels 2 to MIDDLE - 1 out of summed rows, which are sorted by kind and id."""
    return _levels(t, 2, MIDDLE - 1)


def _levels(t: pa.Table, low: int, high: int) -> Levels:
    below = _numbers(t, "id", 0), _numbers(t, "v", 0, float)
    return Levels(_numbers(t, "id", CELLS), _numbers(t, "v", CELLS, float), low, high, below)


def cell_scores(own: DataFrame) -> DataFrame:
    """(key, v): the log10 probability of each cell of own (key, n)."""
    group = F.shiftright("key", 8 * (DEPTH + 1 - MIDDLE))
    dealt = own.select(group.alias("g"), "key", "n").repartition("g").sortWithinPartitions("g", "key")

    def deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(batches, "g"):
            yield from _sum_rows(Levels(t.column("key").to_numpy(), t.column("n").to_numpy(), MIDDLE, DEPTH))

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("kind", "id").agg(F.sum("v").alias("v"))

    sums = materialize(summed(dealt.mapInArrow(lean("ctw", deep), _SUMS)), "tree")
    near = F.shiftright("id", 8 * (MIDDLE - 2))
    dealt = sums.select(near.alias("g"), "kind", "id", "v").repartition("g").sortWithinPartitions("g", "kind", "id")

    def above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(batches, "g"):
            yield from _sum_rows(_middle(t))

    # 256 contexts of 256 cells and 255 nodes at most.
    top = summed(dealt.mapInArrow(lean("ctw", above), _SUMS)).orderBy("kind", "id").toArrow()
    roots = own.sparkSession.sparkContext.broadcast(_levels(top, 0, 1).down(None))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(batches, "g"):
            ids, a, b = _middle(t).down(roots.value)
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(a), pa.array(b)], ["id", "a", "b"])

    nodes = dealt.mapInArrow(lean("ctw", descend), "id long, a double, b double")
    # The nodes just above MIDDLE go to each group of theirs: 255 rows a group at most.
    groups = own.select(group.alias("g")).distinct()
    nodes = groups.join(nodes, F.shiftright("g", 8) == F.shiftright("id", 8))
    nodes = nodes.select("g", F.lit(0).alias("kind"), F.col("id").alias("key"), F.lit(0).cast("long").alias("n"), "a", "b")
    some = own.select(group.alias("g"), F.lit(CELLS).alias("kind"), "key", "n", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    both = nodes.union(some).repartition("g").sortWithinPartitions("g", "kind", "key")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(batches, "g"):
            ids, first = np.unique(_numbers(t, "key", 0), return_index=True)
            parents = ids, _numbers(t, "a", 0, float)[first], _numbers(t, "b", 0, float)[first]
            keys = _numbers(t, "key", CELLS)
            v = Levels(keys, _numbers(t, "n", CELLS, np.int64), MIDDLE, DEPTH).log10(parents)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(v.astype(np.float32))], ["key", "v"])

    return both.mapInArrow(lean("ctw", score), "key long, v float")


# ---------------------------------------------------------------------- training


def held_out(folds: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = _sums(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    return keys, n.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): words and cells of a task's texts, memory bounded; those of
    held-out texts count 0."""
    most = 1_500_000
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WORDS: [], CELLS: []}

    def out(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(keys), kind, np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(n)], ["kind", "key", "n"])

    def add(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        held[kind].append((keys, n))
        if sum(len(k) for k, _ in held[kind][1:]) > most:
            held[kind] = [_merged(held[kind])]
            if len(held[kind][0][0]) > most:
                yield out(kind, *held[kind].pop())

    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            texts = [t.lower() for t in batch.column(0).slice(i, 256).to_pylist()]
            trains = batch.column(1).slice(i, 256).to_pylist()
            for train in {*trains}:
                some = [t for t, x in zip(texts, trains, strict=True) if x == train]
                for kind, f in ((WORDS, words_of), (CELLS, cells)):
                    if train or kind == CELLS:
                        keys, n = np.unique(np.concatenate([f(t) for t in some]), return_counts=True)
                        yield from add(kind, keys, n * train)
    for kind, parts in held.items():
        if parts:
            yield out(kind, *_merged(parts))


def train(docs: DataFrame, folds: int) -> DataFrame:
    """kind, key, n: how often each word (of texts that aren't held out) and each cell (of
    all texts; n of those that aren't held out) occurs, in the shared folder."""
    rows = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("t"), (~held_out(folds)).alias("train"))
    counts = rows.mapInArrow(lean("ctw", _count), "kind int, key long, n long")
    return materialize(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


# ----------------------------------------------------------------------- scoring


class Lookup:
    """Values of keys; 0 for keys that it doesn't hold."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys.view(np.uint64))
        self.keys, self.values = keys.view(np.uint64)[order], values[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        some, back = np.unique(keys, return_inverse=True)
        return _value(some, self.keys, self.values, 0)[back]


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double, n_bytes long"


def _score(ids: pa.Array, raw: list[bytes], words: Lookup, table: Lookup, size: float) -> pa.RecordBatch:
    texts = [t.lower() for t in raw]
    sums = lambda x, parts: np.add.reduceat(x, np.cumsum([0] + [len(p) for p in parts])[:-1])
    parts, own = [cells(t) for t in texts], [words_of(t) for t in texts]
    c = words.of(np.concatenate(own)).astype(float)
    columns = [
        ids, pa.array([len(w) for w in own], pa.int64()), pa.array(sums((c > 0).astype(np.int64), own)),
        pa.array(sums(np.log10((c + 0.1) / size), own)), pa.array(sums(table.of(np.concatenate(parts)).astype(float), parts)),
        pa.array([len(t) for t in texts], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SCORED.split(", ")])


def score_texts(docs: DataFrame, *, folds: int = 10, most_cells: int = MOST_CELLS, most_words: int = MOST_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the
    tree's probability of the text and its end), bits_per_byte (over the text's bytes and
    its end); one row a row of docs.

    Null text is empty: its end alone. Rows that share an id are scored each and train as
    often; a null id trains. Without training rows every bit costs one bit. An empty table
    gives no rows; columns other than doc_id and text are not read. most_cells and
    most_words choose how the table reaches the texts, never a score."""
    small_batches(docs)
    spark = docs.sparkSession
    counts = train(docs, folds)
    words = counts.where(F.col("kind") == WORDS).select("key", "n")
    whole = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    size = whole.n + 0.1 * (whole.v + 1)
    table = materialize(cell_scores(counts.where(F.col("kind") == CELLS).select("key", "n")), "cell-scores")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    if whole.v <= most_words and table.count() <= most_cells:
        some, known = table.toArrow(), words.toArrow()
        held = spark.sparkContext.broadcast((Lookup(known["key"].to_numpy(), known["n"].to_numpy()), Lookup(some["key"].to_numpy(), some["v"].to_numpy())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    yield _score(part.column(0), part.column(1).to_pylist(), *held.value, size)

        scored = rows.mapInArrow(lean("ctw", run), _SCORED)
    else:
        scored = _by_blocks(rows, words, table, size)
    return scored.select(
        "doc_id", held_out(folds).alias("held_out"), "n_tokens", "n_known", F.lit(whole.n).cast("long").alias("train_tokens"),
        "base_score", "score", (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def _by_blocks(rows: DataFrame, words: DataFrame, table: DataFrame, size: float) -> DataFrame:
    """Scores of rows (doc_id, t) whose keys come by a join. Of a key, a block asks once,
    however often it occurs, so no key has more rows than there are blocks."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            names = []
            for n in pc.binary_length(batch.column(1)).to_pylist():
                if held and held + n > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += n + 1
                names.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *batch.columns], ["block", "doc_id", "t"])

    texts = materialize(rows.mapInArrow(lean("ctw", number), "block long, doc_id long, t binary"), "blocks")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "block"):
            own = [t.lower() for t in group.column("t").to_pylist()]
            for kind, f in ((WORDS, words_of), (CELLS, cells)):
                keys = np.unique(np.concatenate([f(t) for t in own]))
                same = lambda x, as_kind: pa.array(np.full(len(keys), x, as_kind))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([same(group.column("block")[0].as_py(), np.int64), same(kind, np.int32), pa.array(keys.view(np.int64))], ["block", "kind", "key"])

    asked = texts.select("block", "t").mapInArrow(lean("ctw", ask), "block long, kind int, key long")
    told = words.select(F.lit(WORDS).alias("kind"), "key", F.col("n").cast("double").alias("v"))
    told = told.union(table.select(F.lit(CELLS).alias("kind"), "key", F.col("v").cast("double")))
    answers = asked.join(told, ["kind", "key"]).select("block", "kind", "key", "v", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("t"))
    both = answers.unionByName(texts.select("block", F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("key"), F.lit(0.0).alias("v"), "doc_id", "t"))
    dealt = both.repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "block"):
            held = [Lookup(_numbers(group, "key", kind, np.int64), _numbers(group, "v", kind, float)) for kind in (WORDS, CELLS)]
            own = group.filter(pc.equal(group.column("kind"), -1))
            for batch in own.to_batches(max_chunksize=256):
                yield _score(batch.column("doc_id"), batch.column("t").to_pylist(), *held, size)

    return dealt.mapInArrow(lean("ctw", run), _SCORED)
