"""Op 4, secret scans: a trigram inverted index chooses what each rule must read.

From each rule's regex a Boolean query over trigrams is derived: every text that
matches holds them. For each block of documents (an index segment) the postings of
the trigrams that some rule asks for are made in one pass over the block's bytes, the
rules' queries are answered by intersecting and uniting postings, and the candidates
are verified with the regex over their whole texts. A rule without mandatory trigrams
scans every document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, small_batches, text_udf

#: Most strings that a part of a regex is spelled out into.
MOST = 128

# --------------------------------------------------------------------- queries


@dataclass(frozen=True)
class Query:
    """A Boolean query: all of `trigrams` and of `parts` ("and"), or one part ("or").
    An empty "and" asks for nothing: every text may match."""

    op: str = "and"
    trigrams: frozenset[bytes] = frozenset()
    parts: tuple[Query, ...] = ()

    @property
    def any(self) -> bool:
        return self.op == "and" and not self.trigrams and not self.parts

    def wanted(self) -> set[bytes]:
        return set(self.trigrams).union(*[p.wanted() for p in self.parts])

    def answer(self, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        """Which of the n texts satisfy it."""
        found = [postings[t] for t in sorted(self.trigrams)] + [p.answer(postings, n) for p in self.parts]
        if self.op == "or":
            return np.logical_or.reduce(found) if found else np.zeros(n, bool)
        return np.logical_and.reduce(found) if found else np.ones(n, bool)


def _all(parts: Sequence[Query]) -> Query:
    parts = [p for p in parts if not p.any]
    if len(parts) == 1:
        return parts[0]
    plain = frozenset().union(*[p.trigrams for p in parts if p.op == "and"])
    nested = tuple(dict.fromkeys(q for p in parts for q in (p.parts if p.op == "and" else (p,))))
    return Query("and", plain, nested)


def _one_of(parts: Sequence[Query]) -> Query:
    if not parts or any(p.any for p in parts):
        return Query()
    parts = tuple(dict.fromkeys(parts))
    # A part that asks for all that another does, and more, adds no text.
    parts = tuple(p for p in parts if not any(q is not p and not q.parts and q.op == "and" and q.trigrams <= p.trigrams for q in parts))
    return parts[0] if len(parts) == 1 else Query("or", frozenset(), parts)


def _spelled(words: frozenset[bytes]) -> Query:
    """The query of a text that holds one of the words."""
    return _one_of([Query("and", frozenset(w[i : i + 3] for i in range(len(w) - 2))) for w in sorted(words)])


@dataclass
class _Part:
    """What is known of a part: all the strings it matches, or else its query."""

    words: frozenset[bytes] | None = None
    query: Query = field(default_factory=Query)

    def asks(self) -> Query:
        return _all([self.query, _spelled(self.words)]) if self.words is not None else self.query


def _sequence(parts: Sequence[_Part]) -> _Part:
    queries: list[Query] = []
    run: frozenset[bytes] = frozenset([b""])
    whole = True
    for p in parts:
        if p.words is not None and len(run) * len(p.words) <= MOST:
            run = frozenset(a + b for a in run for b in p.words)
            continue
        whole = False
        queries += [_spelled(run), p.query]
        run = p.words if p.words is not None else frozenset([b""])
    return _Part(run) if whole else _Part(None, _all([*queries, _spelled(run)]))


def _derive(tree: Sequence) -> _Part:
    from re import _constants as c

    parts: list[_Part] = []
    for op, arg in tree:
        if op is c.LITERAL:
            parts.append(_Part(frozenset([chr(arg).lower().encode()])))
        elif op is c.IN:
            chars: set[bytes] | None = set()
            for kind, value in arg:
                if kind is c.LITERAL:
                    chars.add(chr(value).lower().encode())
                elif kind is c.RANGE and value[1] - value[0] < MOST:
                    chars |= {chr(x).lower().encode() for x in range(value[0], value[1] + 1)}
                else:
                    chars = None
                    break
            # A wide class would spell out more than it tells.
            parts.append(_Part(frozenset(chars)) if chars is not None and len(chars) <= 8 else _Part())
        elif op is c.SUBPATTERN:
            parts.append(_derive(arg[3]))
        elif op is c.BRANCH:
            some = [_derive(x) for x in arg[1]]
            words = [p.words for p in some]
            if None not in words and len(joined := frozenset().union(*words)) <= MOST:
                parts.append(_Part(joined))
            else:
                parts.append(_Part(None, _one_of([p.asks() for p in some])))
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            low, high, inner = arg
            once = _derive(inner)
            if (low, high) == (0, 1) and once.words is not None:
                parts.append(_Part(once.words | {b""}))
            elif low and once.words is not None and len(once.words) ** low <= MOST:
                spelled = _sequence([once] * low)
                parts += [spelled] if high == low else [spelled, _Part()]
            else:
                parts.append(_Part(None, once.asks() if low else Query()))
        elif op is c.AT or op in (c.ASSERT_NOT,):
            continue
        else:
            parts.append(_Part())
    return _sequence(parts)


def trigram_query(pattern: str) -> Query:
    """The trigrams, A-Z lower-cased, that every match of the pattern holds."""
    from re import _parser

    return _derive(_parser.parse(pattern)).asks()


# ----------------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a regex over whole texts, whose matches count where their
    group `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @cached_property
    def regex(self) -> re.Pattern[str]:
        return re.compile(self.pattern)

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that don't overlap, in code points, too short ones dropped."""
        return [m.span() for m in self.regex.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


def _either_case(words: str) -> str:
    return "".join(f"[{x.upper()}{x}]" if x.isalpha() else x for x in words)


BASE_RULES = (
    Rule(
        "assign",
        f"({_either_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
_GAP = r"[\x20\x09-\x0D]+"
#: Published shapes of keys; of a private key the whole block.
MORE_RULES = (
    Rule("github", "gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----({_GAP}[A-Za-z0-9+/]{{16,}}=*)*(({_GAP}[A-Za-z0-9+/=]+)?{_GAP}-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1),
)
RULES = BASE_RULES + MORE_RULES

# ----------------------------------------------------------------------- index


class Segment:
    """Inverted index of one block of UTF-8 texts for the trigrams that rules ask for."""

    _lower = np.arange(256, dtype=np.uint32)
    _lower[65:91] += 32

    def __init__(self, wanted: set[bytes]) -> None:
        self.wanted = sorted(wanted)
        self.codes = np.array([int.from_bytes(t, "big") for t in self.wanted], np.uint32)
        self.begins = np.zeros(1 << 16, bool)
        self.begins[self.codes >> 8] = True

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        """For each wanted trigram which texts hold it. data: the texts' bytes in a row."""
        n = len(offsets) - 1
        held = np.zeros((len(self.wanted), n), bool)
        step = 1 << 20
        for i in range(0, max(0, len(data) - 2) if self.wanted else 0, step):
            b = self._lower[data[i : i + step + 2]]
            two = (b[:-1] << 8) | b[1:]
            at = np.flatnonzero(self.begins[two[:-1]])  # most positions end here
            code = (two[at] << 8) | b[at + 2]
            which = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[which] == code
            at, which = at[hit] + i, which[hit]
            doc = np.searchsorted(offsets, at, "right") - 1
            inside = at + 3 <= offsets[doc + 1]
            held[which[inside], doc[inside]] = True
        return dict(zip(self.wanted, held, strict=True))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def spans_of(texts: list[bytes], rules: Sequence[Rule], segment: Segment) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, number of the rule, end), by start and then rule."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    postings = segment.postings(np.frombuffer(b"".join(texts), np.uint8), offsets)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    asked = [rule.query.answer(postings, len(texts)) for rule in rules]
    for i in np.flatnonzero(np.logical_or.reduce(asked)).tolist():
        text = texts[i].decode("utf-8", "replace")  # of one text at a time
        for k, rule in enumerate(rules):
            if asked[k][i]:
                out[i].extend((a, k, b) for a, b in rule.spans(text))
    for spans in out:
        spans.sort()
    return out


def _blocks(batches: Iterator[pa.RecordBatch], column: int, rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            part = batch.slice(i, rows)
            yield part, part.column(column).to_pylist()


def _segment(rules: Sequence[Rule]) -> Segment:
    return Segment(set().union(*[r.query.wanted() for r in rules]))


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row a document: counts of the base kinds, base_sha256 over the base spans
    and spans, all of them, each as kind:start:end by start and then kind as listed.

    Null and empty texts have no spans. Rows that share an id are reported each;
    a null id stays null. An empty table gives no rows; other columns are not read."""
    small_batches(docs)
    names = [r.kind for r in rules]
    base = {r.kind for r in BASE_RULES}
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _segment(rules)
        for part, texts in _blocks(batches, 1):
            found = spans_of(texts, rules, segment)
            said = [[(names[k], f"{names[k]}:{a}:{b}") for a, k, b in x] for x in found]
            counts = [pa.array([sum(k == kind for k, _ in x) for x in said], pa.int64()) for kind in ("assign", "access", "hex")]
            sha = [hashlib.sha256(",".join(s for k, s in x if k in base).encode()).hexdigest() for x in said]
            spans = [",".join(s for _, s in x) for x in said]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *counts, pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                [x.split()[0] for x in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(lean("secrets", run), SCHEMA)


def redact_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """docs with each span (overlapping ones as one) of its text replaced by the mark.

    Null text stays null and empty text empty; rows that share an id are redacted each; an
    empty table stays empty. Only text goes through Python: all other columns, whatever
    their names, pass through untouched."""
    small_batches(docs)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segment = _segment(rules)
        for batch in batches:
            out: list[bytes | None] = []
            for i in range(0, len(batch), 256):
                texts = batch.slice(i, 256).to_pylist()
                for text, spans in zip(texts, spans_of([t or b"" for t in texts], rules, segment), strict=True):
                    if spans:
                        whole, pieces, end = text.decode("utf-8", "replace"), [], 0
                        for a, b in merged((a, b) for a, _, b in spans):
                            pieces += [whole[end:a], mark]
                            end = b
                        text = "".join([*pieces, whole[end:]]).encode()
                    out.append(text)
            yield pa.array(out, pa.binary())

    return docs.withColumn("text", text_udf("secrets", run, "binary")(F.col("text").cast("binary")).cast("string"))


def merged(spans: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


# ------------------------------------------------------------------------- SQL


def oracle_sql(rules: Sequence[Rule] = RULES) -> str:
    """DuckDB: each rule cuts the text at its matches, and lengths add up to positions."""
    kinds = []
    for k, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        length = f"length(regexp_extract(x, '{pattern}', {r.group}))" if r.group else "length(x)"
        kinds.append(
            f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, p, e FROM (
  SELECT doc_id, x, i, sum(length(x)) OVER (PARTITION BY doc_id ORDER BY i) - length(x) AS p,
    sum(length(x)) OVER (PARTITION BY doc_id ORDER BY i) AS e
  FROM (SELECT doc_id, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM (
    SELECT doc_id, string_split(regexp_replace(t, '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS c FROM d)))
  WHERE i % 2 = 0 AND {length} >= {r.least}"""
        )
    union = "\nUNION ALL ".join(kinds)
    text = "kind || ':' || CAST(p AS BIGINT) || ':' || CAST(e AS BIGINT)"
    base = "kind IN ('assign', 'access', 'hex')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({union})
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
  count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg({text}, ',' ORDER BY p, k) FILTER (WHERE {base}), '')) AS base_sha256,
  coalesce(string_agg({text}, ',' ORDER BY p, k) FILTER (WHERE kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""
