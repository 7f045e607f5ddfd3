"""Op 3, quality rules: robust multivariate outliers, DataFrame functions only.

Each document's words, symbols, repeated lines and repeated word windows are counted
over its whole text; rows that fail the base rules are rejected. For the others the
transformed counts form a vector, and the minimum-covariance-determinant estimate of
each (lang, source) group gives its Mahalanobis distance; far vectors are rejected.

The estimate takes concentration steps from several starts: the group's mean and
covariance, its medians and quartile ranges, and random subsets of some DRAWN rows. Each
step keeps the half-set, the h = ceil(SHARE * n) rows nearest by the last estimate. Rows are
counted by distance on a logarithmic grid, the bin of the h-th row is counted anew on a grid
of FINE steps, and of rows that equal the h-th there each counts in part, so the half-set
has exactly h rows and no sort is needed: a step is two aggregations whose partial results
are a few numbers a group and bin. After TRIAL steps the best BEST starts of a group go on
until their determinants shrink no more; the smallest stays. A group's half-set is then
drawn towards its language's (the sum of its groups' half-sets) with the weight of
PRIOR_ROWS rows, and a language's towards the whole table's, so small groups need no rule
of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import keyed_join, materialize, release, without

SPACES = r"[\x20\x09-\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, wherever body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window that occurs twice or more.

    Windows are sorted by hash and place; those with an equal neighbour are repeats. In
    order of place, each covers 3 words or as many as come before the next."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(places, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeats(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)) | ((k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"]))
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    found = _let(_let(F.sort_array(windows), repeats), covered)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(found).cast("long")


def with_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and COUNTS of whole texts (null: no words)."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(*keep, text.alias("__t"), words.alias("__w"), lines.alias("__l"))
    return rows.select(
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.regexp_replace("__t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("__w")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# -------------------------------------------------------------------- estimates

#: Transformed statistics, and the least deviation each is given (added as variance), so
#: that a statistic that is the same in nearly all clean documents doesn't reject the rest.
FEATURES: dict[str, tuple[Callable[[], Column], float]] = {
    "f0": (lambda: F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), 0.06),
    "f1": (lambda: F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))), 0.03),
    "f2": (lambda: F.sqrt(F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))), 0.15),
    "f3": (lambda: F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_words"), F.lit(1))), 0.05),
}
SHARE, TAIL = 0.75, 1e-5
#: Random starts and the rows drawn for each; steps of all starts; starts that go on.
RANDOM, DRAWN, TRIAL, BEST = 6, 6, 2, 2
#: Steps of the second grid; the least decrease of a log determinant that goes on.
FINE, LEAST_GAIN = 4096, 1e-6
#: Rows that a group's language counts for, and a language's table.
PRIOR_ROWS = 50
GROUP = ["lang", "source"]
_D = len(FEATURES)
_PAIRS = [(i, j) for i in range(_D) for j in range(i + 1)]
_SUMS = ["n", *[f"s{i}" for i in range(_D)], *[f"q{i}{j}" for i, j in _PAIRS]]
_MODEL = [*[f"m{i}" for i in range(_D)], *[f"l{i}{j}" for i, j in _PAIRS]]


def chi2_tail(x: float, d: int) -> float:
    """P(chi2 with an even number d of degrees > x)."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))


def chi2_point(tail: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_tail(mid, d) > tail else (low, mid)
    return low


#: Makes the covariance of the nearest SHARE of a normal sample that of the whole.
CONSISTENCY = SHARE / (1 - chi2_tail(chi2_point(1 - SHARE, _D), _D + 2))
CUT = chi2_point(TAIL, _D)


def _moments() -> list[Column]:
    sums = [F.sum(f"f{i}").alias(f"s{i}") for i in range(_D)]
    products = [F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"q{i}{j}") for i, j in _PAIRS]
    return [F.count(F.lit(1)).cast("double").alias("n"), *sums, *products]


def _added() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """sums with the means m and the Cholesky factor l of factor * covariance + least
    variances, and logdet."""
    floors = [v for _, v in FEATURES.values()]
    rows = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(_D)})
    cov = {f"c{i}{j}": factor * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) + F.lit(floors[i] ** 2 if i == j else 0.0) for i, j in _PAIRS}
    return _factored(rows.withColumns(cov))


def _factored(rows: DataFrame) -> DataFrame:
    for j in range(_D):
        done = lambda a, b: sum((F.col(f"l{a}{k}") * F.col(f"l{b}{k}") for k in range(j)), F.lit(0.0))  # noqa: B023, E731
        # Rounding may leave a variance just below its floor; it can't become zero.
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - done(j, j), F.lit(1e-9))))
        rows = rows.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - done(i, j)) / F.col(f"l{j}{j}") for i in range(j + 1, _D)})
    logdet = sum((2 * F.log(f"l{i}{i}") for i in range(_D)), F.lit(0.0))
    return rows.drop(*[f"c{i}{j}" for i, j in _PAIRS]).withColumn("logdet", logdet)


def _distance(of: Callable[[str], Column] = F.col) -> Column:
    """Squared Mahalanobis distance of the features from the model whose parts `of` gives."""
    y: list[Column] = []
    for i in range(_D):
        rest = sum((of(f"l{i}{k}") * y[k] for k in range(i)), F.lit(0.0))
        y.append((F.col(f"f{i}") - of(f"m{i}") - rest) / of(f"l{i}{i}"))
    return sum((v * v for v in y), F.lit(0.0))


#: The first grid: squared distances from LOW, four steps an octave.
LOW, FIRST, LAST = 2.0**-8, -32, 64


def _bin(distance: Column) -> Column:
    """Number of a squared distance on the first grid."""
    return F.least(F.greatest(F.floor(4 * F.log2(distance + F.lit(LOW))), F.lit(FIRST)), F.lit(LAST)).cast("int")


def _fine(distance: Column, number: Column) -> Column:
    """Number of a squared distance on the second grid, within its bin of the first."""
    low, high = F.pow(F.lit(2.0), number / 4) - LOW, F.pow(F.lit(2.0), (number + 1) / 4) - LOW
    return F.least(F.greatest(F.floor(FINE * (distance - low) / (high - low)), F.lit(0)), F.lit(FINE)).cast("int")


def _draw(start: int) -> Column:
    """A number in [0, 1) of each vector and start."""
    key = F.concat_ws(":", F.lit(str(start)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32


def _by_median(rows: DataFrame) -> DataFrame:
    """Starts from medians and interquartile ranges, both from histograms of 64 bins, as if
    of one row each."""
    cells = F.array(*[F.struct(F.lit(i).alias("k"), F.least(F.floor(F.col(f"f{i}") * (16 if i == 0 else 64)), F.lit(63)).cast("int").alias("bin")) for i in range(_D)])
    counts = rows.select(*GROUP, F.explode(cells).alias("c")).groupBy(*GROUP, "c.k", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy(*GROUP, "k")
    counts = counts.withColumn("upto", F.sum("n").over(window.orderBy("bin"))).withColumn("all", F.sum("n").over(window))
    quartile = lambda p: F.min(F.when(F.col("upto") >= p * F.col("all"), (F.col("bin") + 0.5) / F.when(F.col("k") == 0, 16).otherwise(64)))
    found = counts.groupBy(*GROUP, "k").agg(quartile(0.25).alias("a"), quartile(0.5).alias("b"), quartile(0.75).alias("c"))
    middle = [F.max(F.when(F.col("k") == i, F.col("b"))).alias(f"s{i}") for i in range(_D)]
    spread = [F.max(F.when(F.col("k") == i, ((F.col("c") - F.col("a")) / 1.349) ** 2)).alias(f"v{i}") for i in range(_D)]
    wide = found.groupBy(*GROUP).agg(*middle, *spread).withColumn("n", F.lit(1.0))
    moments = {f"q{i}{j}": F.col(f"s{i}") * F.col(f"s{j}") + (F.col(f"v{i}") if i == j else F.lit(0.0)) for i, j in _PAIRS}
    return wide.withColumns(moments).select(*GROUP, F.lit(1).alias("start"), *_SUMS)


def _starts(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """GROUP, start and _SUMS of the starts. whole: GROUP and _SUMS of all rows."""
    drawn = F.array(*[F.struct(F.lit(2 + k).alias("start"), _draw(k).alias("x")) for k in range(RANDOM)])
    sized = keyed_join(rows, whole.select(*GROUP, F.col("n").alias("size")), GROUP)
    # A row is in few subsets: they are chosen before rows multiply.
    own = sized.withColumn("d", F.filter(drawn, lambda d: d["x"] * F.col("size") < DRAWN)).where(F.size("d") > 0)
    random = own.select(*GROUP, *FEATURES, F.explode("d.start").alias("start")).groupBy(*GROUP, "start").agg(*_moments())
    return whole.select(*GROUP, F.lit(0).alias("start"), *_SUMS).unionByName(_by_median(rows)).unionByName(random.select(*GROUP, "start", *_SUMS))


def _same(keys: Sequence[str], a: str, b: str) -> Column:
    return F.expr(" AND ".join(f"{a}.{k} <=> {b}.{k}" for k in keys))


#: Of so many groups, what remains of a step after its aggregations (some hundred rows a
#: group) is one task's work; of more, it is dealt by group. The results are the same.
FEW_GROUPS = 2000


def _concentrated(rows: DataFrame, models: DataFrame, n_groups: int) -> DataFrame:
    """GROUP, start, _SUMS, _MODEL and logdet of the half-set of each model (GROUP, start,
    _MODEL): one concentration step. Groups without a model are left out."""
    keys, few = [*GROUP, "start"], n_groups <= FEW_GROUPS
    own = models.coalesce(1) if few else models
    packed = own.groupBy(*GROUP).agg(F.collect_list(F.struct("start", *_MODEL)).alias("models"))
    known = keyed_join(rows, packed, GROUP, known=n_groups).where("models IS NOT NULL")
    far = known.select(*GROUP, *FEATURES, F.explode(F.transform("models", lambda m: F.struct(m["start"].alias("start"), _distance(lambda c: m[c]).alias("d")))).alias("x"))
    far = far.select(*GROUP, "x.start", *FEATURES, F.col("x.d").alias("d"), _bin(F.col("x.d")).alias("bin"))
    counts = far.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.repartition(1) if few else counts
    window = Window.partitionBy(*keys)
    counts = counts.withColumns({"upto": F.sum("n").over(window.orderBy("bin")), "half": F.ceil(SHARE * F.sum("n").over(window))})
    # The bin of the h-th row, and how many of its rows the half-set takes.
    edges = counts.where("upto >= half AND upto - n < half").select(*keys, F.col("bin").alias("edge"), (F.col("half") - F.col("upto") + F.col("n")).alias("need"))
    near = keyed_join(far, edges, keys, known=(2 + RANDOM) * n_groups).where("bin <= edge")
    near = near.withColumn("fine", F.when(F.col("bin") < F.col("edge"), F.lit(-1)).otherwise(_fine(F.col("d"), F.col("edge"))))
    sums = near.groupBy(*keys, "need", "fine").agg(*_moments())
    sums = sums.repartition(1) if few else sums
    upto = F.sum(F.when(F.col("fine") >= 0, F.col("n")).otherwise(0.0)).over(window.orderBy("fine"))
    part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("need") - F.col("upto") + F.col("n")) / F.col("n")))
    weighed = sums.withColumn("upto", upto).withColumn("w", F.when(F.col("fine") < 0, F.lit(1.0)).otherwise(part))
    return _estimate(weighed.groupBy(*keys).agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in _SUMS]), CONSISTENCY)


def half_sets(rows: DataFrame) -> DataFrame:
    """GROUP, start, _SUMS, _MODEL and logdet of the half-set of least determinant that was
    found for each group. rows: doc_id, GROUP and FEATURES."""
    whole = materialize(rows.groupBy(*GROUP).agg(*_moments()), "quality-groups")
    n_groups = whole.count()
    now = materialize(_estimate(_starts(rows, whole), 1.0), "quality-step")
    for _ in range(TRIAL):
        now = materialize(_concentrated(rows, now, n_groups), "quality-step", replaces=[now])
    order = Window.partitionBy(*GROUP).orderBy("logdet", "start")
    whole_of = lambda df: df.coalesce(1) if n_groups <= FEW_GROUPS else df
    best = whole_of(now).withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= BEST).drop("__r")
    best = materialize(best.withColumn("improved", F.lit(True)), "quality-best", replaces=[now])
    while not (active := best.where("improved")).isEmpty():
        both = whole_of(best).alias("x").join(_concentrated(rows, active, n_groups).alias("y"), _same([*GROUP, "start"], "x", "y"), "left")
        better = F.coalesce(F.col("y.logdet") < F.col("x.logdet") - LEAST_GAIN, F.lit(False))
        newer = [F.when(better, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}")).alias(c) for c in [*_SUMS, *_MODEL, "logdet"]]
        best = materialize(both.select(*[f"x.{k}" for k in [*GROUP, "start"]], *newer, better.alias("improved")), "quality-best", replaces=[best])
    return best.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r", "improved")


def estimates(halves: DataFrame) -> DataFrame:
    """GROUP and _MODEL of each group, its half-set drawn towards its language's and that
    towards the whole table's."""
    drawn = lambda own, wide: [(F.col(f"{own}.{c}") + PRIOR_ROWS * F.col(f"{wide}.{c}") / F.col(f"{wide}.n")).alias(c) for c in _SUMS]
    whole = halves.agg(*_added())
    langs = halves.groupBy("lang").agg(*_added()).alias("x").join(F.broadcast(whole).alias("y"))  # one row
    langs = langs.select("x.lang", *drawn("x", "y"))
    groups = halves.alias("x").join(langs.alias("y"), _same(["lang"], "x", "y")).select("x.lang", "x.source", *drawn("x", "y"))
    return _estimate(groups, CONSISTENCY).select(*GROUP, *_MODEL)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, distance (squared; null where the base rules failed)
    and kept, one row for each row of docs.

    Null text has no words; null languages and sources are groups of their own; repeated
    rows count as often as they are there, ties at the edge of a half-set in equal parts. A
    group is estimated over all its rows that pass the base rules. An empty table gives no
    rows; columns other than doc_id, text, lang and source are not read."""
    counted = with_counts(docs, "doc_id", "lang", "source").withColumn("base_failed", base_failed())
    counted = materialize(counted.select("*", *[make().cast("double").alias(name) for name, (make, _) in FEATURES.items()]), "quality-counts")
    passed = counted.where("NOT base_failed").select("doc_id", *GROUP, *FEATURES)
    found = materialize(estimates(half_sets(passed)), "quality-estimates")
    rows = keyed_join(counted, found, GROUP)
    rows = rows.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUT, F.lit(True))
    return rows.select("doc_id", *COUNTS, "base_failed", "distance", kept.alias("kept"))


def keep_good(docs: DataFrame, most: int = 500_000) -> DataFrame:
    """docs without the rejected documents; a document goes with any rejected row of its
    doc_id, and a null doc_id stays. All columns pass through."""
    bad = materialize(judge(docs).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "rejected")
    release(docs.sparkSession)
    return without(docs, bad, "doc_id", most=most)
