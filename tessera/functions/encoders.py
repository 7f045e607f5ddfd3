"""Encoder and tokenizer plug-ins, with deterministic stand-ins for tests.

A dense encoder maps texts to unit vectors of its dimension; models and remote services
are plug-ins of the same shape, called in Arrow batches on the executors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.errors import SourceError
from tessera.functions.plugins import resolve


class DenseEncoder(Protocol):
    dimension: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashEncoder:
    """Vectors from the hashes of a text's words: texts that share words are near."""

    def __init__(self, dimension: int = 64) -> None:
        self.dimension = dimension

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        for row, text in zip(out, texts, strict=True):
            for word in text.casefold().split() or [""]:
                seed = int.from_bytes(hashlib.sha256(word.encode()).digest()[:8], "big")
                row += np.random.default_rng(seed).standard_normal(self.dimension)
        return out / np.linalg.norm(out, axis=1, keepdims=True)


class LocalEncoder:
    """A model in a folder that every executor has: `model.onnx` over input_ids and
    attention_mask, and `tokenizer.json`. Token vectors are averaged over the text."""

    def __init__(self, folder: str, most_tokens: int = 512, session: Any = None, tokenizer: Any = None) -> None:
        if session is None:
            try:
                from onnxruntime import InferenceSession
                from tokenizers import Tokenizer
            except ImportError as e:
                raise SourceError("a local model needs onnxruntime and tokenizers") from e
            session, tokenizer = InferenceSession(f"{folder}/model.onnx"), Tokenizer.from_file(f"{folder}/tokenizer.json")
        self.session, self.tokenizer = session, tokenizer
        self.tokenizer.enable_truncation(most_tokens)
        self.tokenizer.enable_padding()
        self.dimension = int(self.session.get_outputs()[0].shape[-1])

    def encode(self, texts: list[str]) -> np.ndarray:
        made = self.tokenizer.encode_batch(texts)
        ids, mask = (np.array([getattr(e, f) for e in made], np.int64) for f in ("ids", "attention_mask"))
        hidden = np.asarray(self.session.run(None, {"input_ids": ids, "attention_mask": mask})[0], float)
        mean = (hidden * mask[:, :, None]).sum(1) / np.maximum(mask.sum(1), 1)[:, None]
        norm = np.linalg.norm(mean, axis=1, keepdims=True)
        return mean / np.where(norm > 0, norm, 1.0)


def _remote(rest: str) -> Callable[[], DenseEncoder]:
    from tessera.functions.remote import RemoteEncoder

    url, _, dimension = rest.rpartition("#")
    if not url or not dimension.isdigit():
        raise SourceError(f"remote:{rest}: write remote:URL#DIMENSION")
    return lambda: RemoteEncoder(url, int(dimension))


#: Makers of encoders by name; called once a task.
ENCODERS: dict[str, Callable[[], DenseEncoder]] = {"hash": HashEncoder}
SCHEMES = {"remote": _remote, "local": lambda folder: lambda: LocalEncoder(folder)}


def encoder_of(name: str) -> Callable[[], DenseEncoder]:
    return resolve("encoder", name, ENCODERS, SCHEMES)


def encode_batched(encoder: DenseEncoder, texts: list[str], size: int = 64) -> np.ndarray:
    """Encodes in batches and halves a batch that runs out of memory."""
    out, i = [], 0
    while i < len(texts):
        try:
            out.append(np.asarray(encoder.encode(texts[i : i + size]), float))
            i += size
        except MemoryError:
            if size == 1:
                raise
            size //= 2
    vectors = np.concatenate(out) if out else np.zeros((0, encoder.dimension))
    if vectors.shape != (len(texts), encoder.dimension) or not np.isfinite(vectors).all():
        raise ValueError("the encoder must give one finite vector of its dimension for each text")
    norms = np.linalg.norm(vectors, axis=1)
    if len(norms) and np.abs(norms - 1).max() > 1e-3:
        raise ValueError("the encoder must give unit vectors")
    return vectors


def encode_column(rows: DataFrame, id_col: str, text_col: str, encoder: str = "hash") -> DataFrame:
    """id, vec (array<double>) of each row's text, by an encoder's name (see encoder_of)."""
    make = encoder_of(encoder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for batch in batches:
            vectors = encode_batched(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(vectors), pa.list_(pa.float64()))], ["id", "vec"])

    return rows.select(F.col(id_col).cast("string").alias("id"), F.coalesce(text_col, F.lit("")).alias("t")).mapInArrow(run, "id string, vec array<double>")
