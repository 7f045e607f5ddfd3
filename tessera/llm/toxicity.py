"""Op 2, toxicity: maximum-scoring segments of token log-odds.

Learning (labelled rows only, at most `most_labelled` ids of them, those with the smallest
hashes): tokens are whole words and their beginnings of 4 to 8 characters, so that inflected
words share their stem's evidence. Each gets the log-odds of its rate in toxic against other
documents under a Dirichlet prior centred on the corpus frequency, moved towards 0 by SURE
standard errors of its document counts, so that tokens without evidence score nothing. A
word scores as its strongest token; words without one share one slightly negative score,
the log-odds of their total rate. Words come in bursts, so of one word USES uses count
within REACH tokens, wherever in a text these are.

Scoring: one linear pass finds all maximal scoring segments of a text. With the scale
lambda at which the clean token distribution's expected exp(lambda * score) is 1, a
segment of score S in n tokens has E = n exp(-lambda S) and extreme-value probability
1 - exp(-E). Several segments are aggregated by the statistics of their sum: the best r
have T = sum(lambda S - ln n) and probability exp(-T) T^(r-1) / (r! (r-1)!), times 2^r for
the choice of r. The document's evidence is -log10 of the least of these, and a logistic
curve turns it into a score. The curve is fitted on evidence that each half of the
labelled rows gets from the other half's table.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, materialize, small_batches
from tessera.llm.shingles import mix, shingle_set

PRIOR_DOCS, SURE, MIN_DOCS = 50.0, 3.0, 3
#: Labelled documents that are learned from, and entries of the table (some 30 MB, the
#: strongest; 20,000 documents have given under 1,000) that is broadcast.
MOST_LABELLED, MOST_TOKENS = 20_000, 300_000
#: Of one word so many uses count within REACH tokens: words come in bursts.
USES, REACH = 2, 50
BEGINNINGS = range(4, 9)
SIGNIFICANT = 0.05
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b" " * len(_MARKS))


def tokens(text: bytes) -> list[str]:
    """Lower-cased (A-Z) runs between white space and ASCII marks."""
    return text.translate(_FOLD).decode("utf-8", "replace").split()


def beginnings(word: str) -> set[str]:
    """The tokens of a word: its beginnings and itself."""
    return {word, *[word[:k] for k in BEGINNINGS]}


def counted(words: Sequence[str], at: Iterable[int]) -> list[int]:
    """Of the positions `at`, in order, those whose word has fewer than USES counted uses
    in the REACH tokens before."""
    met: dict[str, list[int]] = {}
    out = []
    for i in at:
        own = met.setdefault(words[i], [])
        if len(own) < USES or i - own[-USES] > REACH:
            own.append(i)
            out.append(i)
    return out


def held_out(folds: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))


def segments(items: Sequence[tuple[int, float]], rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence in which position i
    scores s for (i, s) of items, in order, and `rest` (not positive) elsewhere."""
    found: list[list[float]] = []  # start, end, sum before, sum after
    total, last = 0.0, 0
    for i, s in items:
        total += rest * (i - last)
        last = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total]
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k -= 1
            if k < 0 or found[k][3] >= new[3]:
                found.append(new)
                break
            new = [found[k][0], new[1], found[k][2], new[3]]
            del found[k:]
    return [(int(a), int(b), high - low) for a, b, low, high in found]


def scale(rates: Sequence[tuple[float, float]], rest: float) -> float:
    """The lambda > 0 with sum of rate * exp(lambda * score) = 1; rates: (rate, score) of
    the clean tokens in the table, all others score `rest`."""
    other = 1.0 - sum(r for r, _ in rates)

    def excess(x: float) -> float:
        return sum(r * math.exp(min(700.0, x * s)) for r, s in rates) + other * math.exp(x * rest) - 1.0

    low, high = 1e-6, 50.0
    if excess(high) < 0:
        return high
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if excess(mid) > 0 else (mid, high)
    return low


@dataclass
class Model:
    """Token scores, the score of all others, lambda, and the logistic curve."""

    table: dict[str, float]
    rest: float = 0.0
    scale: float = 1.0
    intercept: float = -3.0
    slope: float = 3.0

    @cached_property
    def gate(self) -> frozenset[str]:
        """The first letters of all tokens: most words need no look at the table."""
        return frozenset(t[: BEGINNINGS[0]] for t in self.table)

    def items(self, words: Sequence[str]) -> list[tuple[int, float]]:
        """(position, score) of the words that have one."""
        gate, table, cut = self.gate, self.table, BEGINNINGS[0]
        out = []
        for i in counted(words, [i for i, w in enumerate(words) if w[:cut] in gate]):
            found = [table[b] for b in beginnings(words[i]) if b in table]
            if found:
                out.append((i, max(found, key=lambda s: (abs(s), s))))
        return out

    def chance(self, score: float, n: int) -> float:
        """Extreme-value probability of a segment of a score in n clean tokens."""
        return -math.expm1(-n * math.exp(-self.scale * score))

    def evidence(self, scores: Sequence[float], n: int) -> float:
        """-log10 of the probability of the best segments' sum, for the best number of them."""
        if not scores:
            return 0.0
        ordered = sorted(scores, reverse=True)
        least = max(math.log(self.chance(ordered[0], n) or 1e-300), -690.0)
        total = 0.0
        for r, s in enumerate(ordered, 1):
            own = self.scale * s - math.log(n)
            if own <= 0:  # of no segment that clean text has by chance
                break
            total += own
            if r > 1:
                least = min(least, r * math.log(2) - total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r))
        return -least / math.log(10)

    def scan(self, text: bytes) -> tuple[float, int, int, float]:
        """Evidence, number of significant segments, their tokens, and the best score."""
        words = tokens(text)
        found = segments(self.items(words), self.rest)
        if not found:
            return 0.0, 0, 0, 0.0
        good = [(a, b) for a, b, s in found if self.chance(s, len(words)) <= SIGNIFICANT]
        scores = [s for _, _, s in found]
        return self.evidence(scores, len(words)), len(good), sum(b - a for a, b in good), max(scores)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.intercept + self.slope * np.log1p(evidence))))


def fit_curve(evidence: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None, steps: int = 100) -> tuple[float, float]:
    """Intercept and slope of a logistic curve of log(1 + evidence), by Newton's method
    with a weak ridge."""
    x = np.column_stack([np.ones(len(evidence)), np.log1p(evidence)])
    n = np.ones(len(evidence)) if weight is None else weight
    w, ridge = np.zeros(2), np.diag([1e-3, 0.1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (label - p)) - ridge @ w)
        size = np.abs(step).max()
        w += step * min(1.0, 2.0 / max(size, 1e-9))
        if size < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1]))


def labelled(docs: DataFrame, labels: DataFrame, most: int, folds: int) -> DataFrame:
    """__id, t, toxic and half (0 or 1) of at most `most` labelled ids that aren't held
    out, one row each: of an id's texts the least. Copies would count as evidence again
    and again, so of texts with the same least shingle hash the least id stays."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(folds))
    own = own.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max("toxic").alias("toxic"))
    own = own.orderBy(F.xxhash64("__id"), "__id").limit(most)  # so many rows are broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce("text", F.lit("")).cast("binary").alias("t")).join(F.broadcast(own), "__id")
    texts = texts.groupBy("__id", "toxic").agg(F.min("t").alias("t"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column("t").to_pylist()]
            least = pa.array([mix(s).min().view(np.int64) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, least], [*batch.schema.names, "least"])

    alike = texts.select("__id", F.col("toxic").cast("int").alias("toxic"), "t").mapInArrow(lean("toxicity", sketch), "__id long, toxic int, t binary, least long")
    alike = alike.groupBy(F.coalesce("least", "__id").alias("k"), F.col("least").isNull().alias("none")).agg(F.min_by(F.struct("__id", "t", "toxic"), "__id").alias("r"))
    return alike.select("r.*").withColumn("half", F.pmod(F.xxhash64("__id"), F.lit(2)).cast("int"))


_COUNTS = "token string, half int, d1 long, d0 long, t1 long, t0 long"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each token and half of a task's rows: toxic and other documents, toxic and other uses."""
    most = 300_000
    found: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0, 0, 0])

    def out() -> pa.RecordBatch:
        columns = [pa.array([v[k] for v in found.values()], pa.int64()) for k in range(4)]
        names = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int32())]
        batch = pa.RecordBatch.from_arrays([*names, *columns], [x.split()[0] for x in _COUNTS.split(", ")])
        found.clear()
        return batch

    for batch in batches:
        for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            k = 0 if toxic else 1
            words = tokens(text)
            uses = Counter(words[i] for i in counted(words, range(len(words))))
            own: Counter[str] = Counter()
            for w, n in uses.items():
                for b in beginnings(w):
                    own[b] += n
            own[""] = uses.total()  # documents and uses in all
            for b, n in own.items():
                row = found[b, half]
                row[k] += 1
                row[2 + k] += n
            if len(found) > most:
                yield out()
    if found:
        yield out()


_FOUR = ("d1", "d0", "t1", "t0")


def _table(counts: DataFrame, whole: tuple[int, int, int, int]) -> dict[str, float]:
    """The scores of the tokens of counts (token, d1, d0, t1, t0), of whole documents and uses."""
    d1, d0, t1, t0 = whole
    if not d1 or not d0:
        return {}
    share = (F.col("d1") + F.col("d0")) / (d1 + d0)
    # The prior's weight in uses is what its documents hold on average.
    weight = PRIOR_DOCS * (t1 + t0) / (d1 + d0)
    uses = weight * (F.col("t1") + F.col("t0")) / max(t1 + t0, 1)
    odds = F.log((F.col("t1") + uses) / (t1 + weight)) - F.log((F.col("t0") + uses) / (t0 + weight))
    error = F.sqrt(1 / (F.col("d1") + PRIOR_DOCS * share) + 1 / (F.col("d0") + PRIOR_DOCS * share))
    sure = F.signum(odds) * F.greatest(F.abs(odds) - SURE * error, F.lit(0.0))
    some = counts.where((F.col("token") != "") & (F.col("d1") + F.col("d0") >= MIN_DOCS))
    some = some.select("token", sure.alias("s")).where("s <> 0")
    return {r.token: r.s for r in some.orderBy(F.desc(F.abs("s")), "token").limit(MOST_TOKENS).collect()}


def _calibrate(model: Model, toxic: dict[float, int], clean: dict[float, int], t1: int, t0: int) -> None:
    """Sets the score of other words and lambda from the uses of each score in toxic and
    clean texts (t1 and t0 uses in all)."""
    # A clean rate is at least what the prior leaves for a token never met in clean text.
    low = [(max(clean.get(s, 0), 0.05) / max(t0, 1), s) for s in sorted({*toxic, *clean})]
    high = sum(n for s, n in toxic.items() if s > 0) / max(t1, 1)
    rest = math.log1p(-min(high, 0.9)) - math.log1p(-min(sum(r for r, s in low if s > 0), 0.9))
    model.rest = min(rest, -1e-3)
    model.scale = scale(low, model.rest)


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, folds: int = 5) -> Model:
    """The model of the labelled rows outside fold 0; without toxic or without other rows
    a table that scores every text alike."""
    rows = materialize(labelled(docs, labels, most, folds), "labelled")
    counts = rows.select("t", "toxic", "half").mapInArrow(lean("toxicity", _counts), _COUNTS)
    counts = materialize(counts.groupBy("token", "half").agg(*[F.sum(c).alias(c) for c in _FOUR]), "tokens")
    halves = [counts.where(F.col("half") == h) for h in (0, 1)]
    both = counts.groupBy("token").agg(*[F.sum(c).alias(c) for c in _FOUR])
    whole = {r.half: tuple(r[c] for c in _FOUR) for r in counts.where("token = ''").collect()}
    whole = [whole.get(h, (0, 0, 0, 0)) for h in (0, 1)]
    whole.append(tuple(map(sum, zip(*whole, strict=True))))
    if not whole[2][0] or not whole[2][1]:
        return Model({})
    # Numbers 0 and 1: learned from one half; 2: from both.
    models = [Model(_table(c, w)) for c, w in zip([*halves, both], whole, strict=True)]
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast([m.table for m in models])

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Model(t) for t in held.value]
        found: Counter[tuple[int, float, int]] = Counter()
        for batch in batches:
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = tokens(text)
                for k in (half, 2):
                    found.update((k, s, 1 if toxic else 0) for _, s in own[k].items(words))
        columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int32(), pa.float64(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found.values(), pa.int64())], ["model", "s", "toxic", "n"])

    rates = rows.select("t", "toxic", "half").mapInArrow(lean("toxicity", used), "model int, s double, toxic int, n long")
    rates = rates.groupBy("model", "s", "toxic").agg(F.sum("n").alias("n")).collect()  # scores of tables at most
    for k, model in enumerate(models):
        toxic, clean = ({r.s: r.n for r in rates if r.model == k and r.toxic == x} for x in (1, 0))
        _calibrate(model, toxic, clean, whole[k][2], whole[k][3])
    final = models[2]
    told = spark.sparkContext.broadcast(models)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = [told.value[1 - half].scan(t)[0] for t, half in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(evidence, pa.float64())], ["label", "evidence"])

    scored = rows.select("t", F.col("toxic").cast("double"), "half").mapInArrow(lean("toxicity", judged), "label double, evidence double")
    # Evidence is under 300, so that the groups are few.
    bins = scored.groupBy("label", F.round("evidence", 2).alias("e")).agg(F.count(F.lit(1)).alias("n")).orderBy("e", "label").collect()
    final.intercept, final.slope = fit_curve(*(np.array([r[c] for r in bins], float) for c in ("e", "label", "n")))
    return final


SCHEMA = "doc_id long, score double, n_segments long, toxic_tokens long, best_segment double"


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= 0.5), and the number, tokens
    and best score of significant segments, one row for each row of docs.

    Null and empty texts have no evidence and get the curve's value there. Rows that share
    an id are scored each, and one of them is learned from; a null id is never held out;
    labels may lack or repeat ids (the largest label counts). Without labels of both kinds
    all texts score alike. Empty tables give no rows; documents' other columns are not
    read."""
    small_batches(docs)
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, most, folds))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.scan(t) for t in batch.column(1).to_pylist()]
            evidence, n, length, best = zip(*found, strict=True) if found else ((), (), (), ())
            score = model.value.score(np.array(evidence, float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(n, pa.int64()), pa.array(length, pa.int64()), pa.array(best, pa.float64())],
                ["doc_id", "score", "n_segments", "toxic_tokens", "best_segment"],
            )

    scored = rows.mapInArrow(lean("toxicity", run), SCHEMA)
    return scored.select("doc_id", held_out(folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_segments", "toxic_tokens", "best_segment")


def passages(text: str, model: Model) -> list[tuple[int, int, float]]:
    """Significant toxic passages of a text as (first token, end token, score)."""
    words = tokens(text.encode())
    return [f for f in segments(model.items(words), model.rest) if model.chance(f[2], len(words)) <= SIGNIFICANT]
