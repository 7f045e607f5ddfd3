"""Op 10, line dedup: two Bloom filters pick the lines worth shuffling.

1. Each task keeps the hashes of its documents' long lines in a filter of those seen
   once; a hash whose bits are all there already goes to the filter of those seen
   twice. Over tasks, twice = twice | twice' | (once & once'): a bit that two tasks
   have set. So a key of two documents is always in the merged filter.
2. Lines in the twice-filter are suspected repeats. Only their digests shuffle, and
   the number of documents and the largest id of each are counted exactly.
3. Every document is read again and loses its confirmed lines.

The filters are sized by the number of documents, up to MOST_BITS (64 MB each in a task,
compressed in the broadcast); a corpus too large for them makes more suspects, in the end
all long lines' digests, never a different result. Confirmed keys are broadcast up to
`most_keys`; beyond that suspects meet them in a join and lost keys go to their documents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, code_points, free_name, hot_join, keyed_join, lean, materialize, small_batches, text_udf

CHUNK_BITS = 1 << 18
#: Bits a document, for some 32 long lines, and the bounds of a filter.
DOC_BITS, LEAST_BITS, MOST_BITS = 256, 1 << 24, 1 << 29
MIN_CHARS, MIN_DOCS = 40, 5


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z lower-cased."""
    return line.strip(SPACES).lower()


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_digests(text: bytes, min_chars: int) -> list[bytes | None]:
    """For each line of a text the digest of its key, None if that is too short."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line_key(line)
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or code_points(key) >= min_chars)
        out.append(digest(key) if long else None)
    return out


def bit_positions(digests: list[bytes], filter_bits: int) -> np.ndarray:
    """Two bits a digest, one row each."""
    words = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return (words % np.uint64(filter_bits)).astype(np.int64)


class TwiceFilter:
    """Bloom filters of the hashes seen once and twice, as bytes of bits."""

    def __init__(self, filter_bits: int) -> None:
        self.bits = filter_bits
        self.once = np.zeros(filter_bits // 8, np.uint8)
        self.twice = np.zeros(filter_bits // 8, np.uint8)

    def add(self, digests: list[bytes]) -> None:
        """Adds the distinct keys of some documents, repeats between documents kept."""
        if not digests:
            return
        at = bit_positions(digests, self.bits)
        _, first, times = np.unique(at, axis=0, return_index=True, return_counts=True)
        again = at[first[times > 1]]
        at = at[first]
        seen = self._has(self.once, at).all(axis=1)
        self._set(self.twice, at[seen])
        self._set(self.twice, again)
        # Bits met by two keys count as well, or two tasks' bits wouldn't add up.
        self._set(self.once, at)

    @staticmethod
    def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    @staticmethod
    def _set(bits: np.ndarray, at: np.ndarray) -> None:
        np.bitwise_or.at(bits, at.ravel() >> 3, (1 << (at.ravel() & 7)).astype(np.uint8))


def _packed(bits: np.ndarray) -> bytes:
    return zlib.compress(bits.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


def twice_chunks(docs: DataFrame, filter_bits: int, min_chars: int) -> dict[int, bytes]:
    """The merged filter of keys that two documents may share: its chunks with a bit set, by
    number and packed. Only tasks ever unpack it; the driver holds what it weighs packed."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = TwiceFilter(filter_bits)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                found: list[bytes] = []
                for text in batch.column(0).slice(i, 512).to_pylist():
                    found.extend({d for d in long_digests(text, min_chars) if d})
                both.add(found)
        size = CHUNK_BITS // 8
        for c in range(filter_bits // CHUNK_BITS):
            once, twice = both.once[c * size : (c + 1) * size], both.twice[c * size : (c + 1) * size]
            if once.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "once": [_packed(once)], "twice": [_packed(twice)]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                once, twice = _unpacked(row["once"]), _unpacked(row["twice"])
                if row["chunk"] in held:
                    a, b = held[row["chunk"]]
                    held[row["chunk"]] = a | once, b | twice | (a & once)
                else:
                    held[row["chunk"]] = once, twice
        for c, (_, twice) in held.items():
            if twice.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "twice": [_packed(twice)]})

    text = docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    parts = text.mapInArrow(lean("linededup", build), "chunk int, once binary, twice binary")
    merged = parts.repartition("chunk").mapInArrow(lean("linededup", merge), "chunk int, twice binary")
    return {row["chunk"]: bytes(row["twice"]) for row in merged.collect()}  # filter_bits at most, whatever the input


def whole_filter(chunks: dict[int, bytes], filter_bits: int) -> np.ndarray:
    """The filter of such chunks, filter_bits / 8 bytes."""
    out = np.zeros(filter_bits // 8, np.uint8)
    size = CHUNK_BITS // 8
    for c, packed in chunks.items():
        out[c * size : (c + 1) * size] = _unpacked(packed)
    return out


def bits_for(n_docs: int) -> int:
    """The size of the filters for so many documents: a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (n_docs * DOC_BITS).bit_length()))


def suspects(docs: DataFrame, filter_bits: int, min_chars: int) -> DataFrame:
    """(key binary, doc_id): keys of long lines that two documents may share, once for each
    of a document's rows."""
    twice = docs.sparkSession.sparkContext.broadcast(twice_chunks(docs, filter_bits, min_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = whole_filter(twice.value, filter_bits)
        for batch in batches:
            ids: list[int | None] = []
            keys: list[bytes] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = list({d for d in long_digests(text, min_chars) if d})
                ids.extend([doc] * len(own))
                keys.extend(own)
            if keys:
                hit = TwiceFilter._has(bits, bit_positions(keys, filter_bits)).all(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"]).filter(pa.array(hit))

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(lean("linededup", run), "key binary, doc_id long")


def confirmed_keys(found: DataFrame, min_docs: int) -> DataFrame:
    """(key binary, keep long): each key of suspects in min_docs documents or more, and the
    largest id that holds it."""
    # Repeated rows of a document count once; a hot key's documents are dealt by (key, doc_id).
    pairs = found.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    counts = pairs.groupBy("key").agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("keep"))
    return counts.where(F.col("n") >= min_docs).select("key", "keep")


def drop_lines(text: bytes, doc: int | None, keep: dict[bytes, int], min_chars: int) -> tuple[bytes, int, int]:
    """The text without its confirmed lines, its lines before, and those dropped."""
    lines = text.split(b"\n")
    found = long_digests(text, min_chars)
    left = [x for x, d in zip(lines, found, strict=True) if d is None or keep.get(d, doc) == doc]
    return b"\n".join(left), len(lines), len(lines) - len(left)


def dedup_lines(
    docs: DataFrame,
    *,
    filter_bits: int | None = None,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    most_keys: int = 1_000_000,
    counts: bool = True,
) -> DataFrame:
    """docs with text replaced, and n_lines, n_dropped (long) added if counts is true.

    A key of at least min_chars code points in at least min_docs documents loses its
    lines in all but the document with the largest doc_id. Null text is one empty line
    and becomes empty; an empty table stays empty. Rows with a null doc_id take no part
    in counts and keep their lines. Rows that repeat a doc_id count as one document.
    Only doc_id and text go through Python; other columns pass through, whatever their
    names, but n_lines and n_dropped are replaced if counts is true."""
    small_batches(docs)
    docs = docs.drop("n_lines", "n_dropped") if counts else docs
    bits = bits_for(docs.count()) if filter_bits is None else filter_bits
    found = suspects(docs, bits, min_chars)
    keys = materialize(confirmed_keys(found, min_docs), "line-keys")
    few = keys.limit(most_keys + 1).count() <= most_keys
    own = free_name(docs, "__drop")
    if few:
        table = keys.toArrow()
        held = docs.sparkSession.sparkContext.broadcast(
            (b"".join(b"".join(c.to_pylist()) for c in table["key"].chunks), table["keep"].to_numpy().tobytes())
        )
        rows = docs.withColumn(own, F.lit(None).cast("array<binary>"))
    else:
        # What a document loses is bounded by its own lines; a common line stays where it is.
        found = materialize(found.where("doc_id IS NOT NULL"), "suspects")
        lost = hot_join(found, keys, "key", written=True).where("doc_id <> keep")
        lost = materialize(lost.groupBy("doc_id").agg(F.collect_set("key").alias(own)), "lost-lines")
        id_name = free_name(docs, "__id")
        rows = docs.withColumn(id_name, F.col("doc_id").cast("long"))
        rows = keyed_join(rows, lost.withColumnRenamed("doc_id", id_name), [id_name], most=0, salts=8).drop(id_name)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        if few:
            raw, ids = held.value
            keep = {raw[16 * i : 16 * i + 16]: k for i, k in enumerate(np.frombuffer(ids, np.int64).tolist())}
        for columns in batches:
            out: list[tuple[bytes, int, int]] = []
            for doc, text, drop in zip(*(c.to_pylist() for c in columns), strict=True):
                if not few:
                    keep = {k: doc + 1 for k in drop or ()}
                out.append(drop_lines(text, doc, keep if doc is not None else {}, min_chars))
            text, n, gone = zip(*out, strict=True) if out else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(text, pa.binary()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], ["text", "n_lines", "n_dropped"])

    done = text_udf("linededup", run, "struct<text: binary, n_lines: bigint, n_dropped: bigint>")
    new = free_name(rows, "__new")
    rows = rows.withColumn(new, done(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary"), F.col(own)))
    rows = rows.withColumn("text", F.col(new)["text"].cast("string"))
    if counts:
        rows = rows.withColumns({c: F.col(new)[c] for c in ("n_lines", "n_dropped")})
    return rows.drop(new, own)
