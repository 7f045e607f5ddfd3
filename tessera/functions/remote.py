"""Optional plug-ins that call model services over HTTP: a dense encoder and a reranker.

Nothing here runs without a URL; clients are injected, so tests need no network. Retries
wait as the service asks (Retry-After) or with doubling pauses, at most MOST_WAIT."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np

from tessera.errors import SourceError

MOST_WAIT = 30.0
#: Status codes worth another try.
TRANSIENT = frozenset({408, 425, 429, 500, 502, 503, 504})
TOO_LARGE = 413

#: (url, payload) -> (status, headers, body)
Client = Callable[[str, object], tuple[int, dict[str, str], object]]


def urllib_client(timeout: float = 60.0) -> Client:
    def call(url: str, payload: object) -> tuple[int, dict[str, str], object]:
        request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as r:
                return r.status, dict(r.headers), json.loads(r.read())
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), None
        except (urllib.error.URLError, TimeoutError) as e:
            return 503, {}, str(e)

    return call


def wait_of(headers: dict[str, str], attempt: int, base: float = 2.0) -> float:
    """Seconds before the next attempt, counted from 0."""
    asked = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
    try:
        return min(MOST_WAIT, max(0.0, float(asked)))
    except ValueError:
        return min(MOST_WAIT, base * 2**attempt)


def request(client: Client, url: str, payload: object, attempts: int = 4, sleep: Callable[[float], None] = time.sleep) -> tuple[int, object]:
    """Status and body; transient failures are tried again, TOO_LARGE is handed back."""
    for attempt in range(attempts):
        status, headers, body = client(url, payload)
        if status == 200 or status == TOO_LARGE:
            return status, body
        if status not in TRANSIENT:
            raise SourceError(f"{url}: status {status}")
        if attempt < attempts - 1:
            sleep(wait_of(headers, attempt))
    raise SourceError(f"{url}: status {status} after {attempts} attempts")


def packed(sizes: Sequence[int], most_items: int, most_tokens: int) -> Iterator[list[int]]:
    """Positions in batches of at most so many items and tokens, in order; an item above
    the token limit is a batch of its own."""
    batch: list[int] = []
    total = 0
    for i, n in enumerate(sizes):
        if batch and (len(batch) == most_items or total + n > most_tokens):
            yield batch
            batch, total = [], 0
        batch.append(i)
        total += n
    if batch:
        yield batch


@dataclass
class RemoteEncoder:
    """A DenseEncoder over a service that takes {"inputs": [...]} and gives vectors."""

    url: str
    dimension: int
    client: Client = field(default_factory=urllib_client)
    count: Callable[[list[str]], list[int]] = lambda texts: [len(t.split()) for t in texts]
    most_items: int = 32
    most_tokens: int = 16_384
    sleep: Callable[[float], None] = time.sleep

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        for batch in packed(self.count(texts), self.most_items, self.most_tokens):
            self._fill(out, batch, texts)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms > 0, norms, 1.0)

    def _fill(self, out: np.ndarray, batch: list[int], texts: list[str]) -> None:
        status, body = request(self.client, self.url, {"inputs": [texts[i] for i in batch]}, sleep=self.sleep)
        if status == TOO_LARGE:
            if len(batch) == 1:
                raise SourceError(f"{self.url}: one text is too large")
            half = len(batch) // 2
            self._fill(out, batch[:half], texts)
            self._fill(out, batch[half:], texts)
            return
        vectors = np.asarray(body, float)
        if vectors.shape != (len(batch), self.dimension) or not np.isfinite(vectors).all():
            raise SourceError(f"{self.url}: {vectors.shape} isn't {len(batch)} vectors of {self.dimension}")
        out[batch] = vectors


@dataclass
class RemoteReranker:
    """A scorer over a service that takes a query and documents and gives
    [{"index": i, "relevance_score": s}]; documents left out have no score."""

    url: str
    instruction: str = ""
    top_n: int | None = None
    client: Client = field(default_factory=urllib_client)
    sleep: Callable[[float], None] = time.sleep

    def rerank(self, query: str, documents: list[str]) -> list[tuple[int, float]]:
        payload = {"query": f"{self.instruction}\n{query}" if self.instruction else query, "documents": documents, "top_n": self.top_n or len(documents)}
        status, body = request(self.client, self.url, payload, sleep=self.sleep)
        if status != 200:
            raise SourceError(f"{self.url}: status {status}")
        return ranked(body, len(documents))

    def __call__(self, queries: list[str], documents: list[str]) -> list[float | None]:
        """Scores of pairs; pairs of one query in a row go together."""
        out: list[float | None] = [None] * len(queries)
        start = 0
        for end in range(1, len(queries) + 1):
            if end == len(queries) or queries[end] != queries[start]:
                for i, s in self.rerank(queries[start], documents[start:end]):
                    out[start + i] = s
                start = end
        return out


def ranked(body: object, n: int) -> list[tuple[int, float]]:
    """(index, score) by score and then index, checked: different indexes below n and
    finite numbers."""
    items = body.get("results") if isinstance(body, dict) else body
    if not isinstance(items, list):
        raise SourceError("the reranker gave no list")
    found: dict[int, float] = {}
    for item in items:
        i, s = (item.get("index"), item.get("relevance_score")) if isinstance(item, dict) else (None, None)
        if type(i) is not int or not 0 <= i < n or i in found or isinstance(s, bool) or not isinstance(s, int | float) or not abs(s) < float("inf"):
            raise SourceError(f"the reranker gave {item!r}")
        found[i] = float(s)
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))
