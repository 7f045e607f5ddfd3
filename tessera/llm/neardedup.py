"""Op 8, MinHash near-dedup with b-bit signatures.

1. One pass over the texts makes each document's set of hashed 5-word shingles, and from
   it MinHash minima. BANDS bands of ROWS minima make the band hashes; of all HASHES
   minima only BITS bits are kept, of a mix with the minimum's number so that chance
   collisions are independent, packed into bit planes. Sets of at most SMALL shingles
   are kept whole beside them.
2. Documents with equal sets form a class at once; the smallest id stands for it.
3. Candidates: class representatives that share a band hash. In every bucket each member
   meets three hubs; the similarity of a pair is estimated from equal low bits, corrected
   for chance collisions, or exact where both sets are small; each document's best partner
   in each of two classes is confirmed on full sets, and the confirmed links are
   contracted to components.
4. What is left: pairs of one bucket in different components. The members outside a
   bucket's largest component meet the others block by block, so that a bucket with few
   strays costs rows in proportion to its size; blocks are compared by signature in NumPy
   (small sets: exactly), and only pairs that could be a link are confirmed on full sets.
   So no pair that shares a band is lost, while pairs inside a component are never made.

A link at the threshold shares no band with probability (1 - 0.75**5)**44 < 1e-5, and
its estimate falls under MIN_ESTIMATE with one of less than 1e-4; both shrink fast above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hot_join, keyed_join, lean, materialize, runs, small_batches
from tessera.llm.components import components
from tessera.llm.shingles import mix, shingle_set

ROWS, BANDS = 5, 44
HASHES, BITS = 1024, 2
MIN_ESTIMATE = 0.685
BLOCK = 512
#: Sets of so many shingles are compared exactly: as large as their bit planes.
SMALL = 32
#: Rows of 24 bytes or so that are broadcast at most.
MOST = 500_000
_LONGS = HASHES // 64

_rng = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_NUMBERS = np.arange(1, HASHES + 1, dtype=np.uint64) << np.uint64(32)


def minima(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima of multiplicative permutations of the shingles' upper 32 bits."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(out, (x[None, i : i + 512] * _FACTORS[:, None]).min(axis=1), out=out)
    return out


def band_hashes(low: np.ndarray) -> np.ndarray:
    """BANDS hashes of 64 bits, each of ROWS minima and the band's number."""
    h = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for row in low[: ROWS * BANDS].reshape(BANDS, ROWS).T:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + row)
    return h.view(np.int64)


def bit_planes(low: np.ndarray) -> np.ndarray:
    """BITS planes of HASHES bits as longs: plane by plane. The low bits themselves would
    not do: factors are odd, so they collide alike in all hashes."""
    mixed = mix(low + _NUMBERS)
    planes = [np.packbits(((mixed >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(BITS)]
    return np.concatenate(planes).view(np.int64)


def estimate(differing: Column | np.ndarray) -> Column | np.ndarray:
    """Similarity from the number of minima whose kept bits differ: without what equals
    by chance, 2**-BITS of the unequal minima."""
    return 1.0 - differing / (HASHES * (1 - 0.5**BITS))


def _differing(a: str, b: str) -> Column:
    total = F.lit(0)
    for i in range(_LONGS):
        diff = None
        for p in range(BITS):
            x = F.col(a)[p * _LONGS + i].bitwiseXOR(F.col(b)[p * _LONGS + i])
            diff = x if diff is None else diff.bitwiseOR(x)
        total = total + F.bit_count(diff)
    return total


_SIGNED = "doc_id long, n_shingles long, set_key binary, planes array<long>, bands array<long>, small array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set; null without words), planes,
    bands and small (the set itself, if it is small), from whole texts."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                n, keys, planes, bands, small = [], [], [], [], []
                for text in batch.column(1).slice(i, 1024).to_pylist():
                    s = shingle_set(text)
                    n.append(len(s))
                    if not len(s):
                        keys.append(None), planes.append(None), bands.append(None), small.append(None)
                        continue
                    low = minima(s)
                    keys.append(s.sum().tobytes() + np.bitwise_xor.reduce(mix(s ^ np.uint64(len(s)))).tobytes())
                    planes.append(bit_planes(low)), bands.append(band_hashes(low))
                    small.append(s.view(np.int64) if len(s) <= SMALL else None)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1024), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(planes, longs), pa.array(bands, longs), pa.array(small, longs)],
                    ["doc_id", "n_shingles", "set_key", "planes", "bands", "small"],
                )

    return rows.mapInArrow(lean("neardedup", run), _SIGNED)


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, shingles binary): the full sets of the wanted documents (column doc)."""
    marked = keyed_join(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), wanted.withColumn("__in", F.lit(True)), ["doc"], most=MOST)
    rows = marked.where("__in").select("doc", F.coalesce("text", F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc", "shingles"])

    return rows.mapInArrow(lean("neardedup", run), "doc long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """Of the pairs (a, b) those with 100 |A & B| >= percent |A | B|.

    Pairs are dealt into cells by the hashes of both ends, in as many classes as keep a
    cell's documents few; each set goes once to each cell that needs it."""
    n = sets.count()
    classes = max(8, -(-n // 1024))
    kind = lambda c: F.pmod(F.xxhash64(c), F.lit(classes))
    cells = pairs.select("a", "b", (kind("a") * classes + kind("b")).alias("cell"))
    docs = cells.select("cell", F.col("a").alias("doc")).union(cells.select("cell", F.col("b").alias("doc"))).distinct()
    rows = docs.join(sets, "doc").select("cell", F.col("doc").alias("a"), F.lit(None).cast("long").alias("b"), "shingles")
    rows = rows.unionByName(cells.withColumn("shingles", F.lit(None).cast("binary")))
    dealt = rows.repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "cell"):
            held, found = {}, []
            for a, b, raw in zip(*(group.column(c).to_pylist() for c in ("a", "b", "shingles")), strict=True):
                if b is None:
                    held[a] = np.frombuffer(raw, np.uint64)
                else:
                    found.append((a, b))
            good = [p for p in found if p[0] in held and p[1] in held and _linked(held[p[0]], held[p[1]], percent)]
            if good:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in good], pa.int64()) for i in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(lean("neardedup", run), "a long, b long")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = (x, y) if len(x) < len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _hub_pairs(banded: DataFrame, buckets: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of bucket members and their bucket's hubs."""
    met = hot_join(banded, buckets, "band", most=MOST, written=True).select("doc", F.explode(F.array("low", "high", "any")).alias("hub"))
    return met.where("doc <> hub").select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    """The documents of pairs (column doc), once each."""
    return pairs.select(F.col("a").alias("doc")).distinct().union(pairs.select(F.col("b").alias("doc")).distinct()).distinct()


def _estimated(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    x = signed.select(F.col("doc_id").alias("a"), F.col("planes").alias("pa"), F.col("small").alias("sa"))
    y = signed.select(F.col("doc_id").alias("b"), F.col("planes").alias("pb"), F.col("small").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    exact = both / (F.size("sa") + F.size("sb") - both)
    s = F.when(F.col("sa").isNotNull() & F.col("sb").isNotNull(), exact).otherwise(estimate(_differing("pa", "pb")))
    # A bucket's least id is a of nearly all its pairs, its greatest b of many.
    return hot_join(hot_join(pairs, x, "a", written=True), y, "b").select("a", "b", s.alias("s")).where(F.col("s") >= MIN_ESTIMATE)


def _best(pairs: DataFrame) -> DataFrame:
    """For each document its most similar partner in each of two classes by hash, as
    pairs: maxima, which are taken map-side however many partners a document has."""
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "s").union(pairs.select("b", "a", "s"))
    top = ends.groupBy("x", F.pmod(F.xxhash64("y"), F.lit(2)).alias("c")).agg(F.max(F.struct("s", "y")).alias("p"))
    return top.select(F.least("x", "p.y").alias("a"), F.greatest("x", "p.y").alias("b")).distinct()


def _strays(banded: DataFrame, labels: DataFrame) -> DataFrame:
    """band, doc, label, n, k, lead: members of buckets of several components, with the
    bucket's members, those outside its largest component, and that component."""
    rows = keyed_join(banded, labels.withColumnRenamed("node", "doc"), ["doc"], most=MOST)
    rows = rows.select("band", "doc", F.coalesce("label", "doc").alias("label"))
    own = rows.groupBy("band", "label").agg(F.count(F.lit(1)).alias("c"))
    mixed = own.groupBy("band").agg(F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top"))
    mixed = mixed.where("n > top.c").select("band", "n", (F.col("n") - F.col("top.c")).alias("k"), F.col("top.label").alias("lead"))
    return hot_join(rows, materialize(mixed, "mixed"), "band", most=MOST)


def _cells(rows: DataFrame, *others: str) -> DataFrame:
    """cell, band, doc, label, lead (of the largest component), left, others.

    All n members of a bucket are dealt over its blocks; the k outside its largest
    component are dealt over blocks of strays ("left") and meet every block of members:
    n * ceil(k / BLOCK) + k * ceil(n / BLOCK) rows, 2 n or so with up to BLOCK strays."""
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("long")
    own = lambda c: F.pmod(F.xxhash64("doc", "band"), blocks(c))
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), blocks(c) - 1))
    fields = ["band", "doc", "label", (F.col("label") == F.col("lead")).alias("lead"), *others]
    right = rows.select(*fields, F.lit(False).alias("left"), own("n").alias("i"), all_of("k").alias("j"))
    left = rows.where("label <> lead").select(*fields, F.lit(True).alias("left"), all_of("n").alias("i"), own("k").alias("j"))
    both = right.union(left)
    return both.select(F.xxhash64("band", "i", "j").alias("cell"), *[c for c in both.columns if c not in ("i", "j")])


def _cross_pairs(banded: DataFrame, labels: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (a < b) of one bucket in different components whose estimate may be a link."""
    rows = _strays(banded, labels).join(signed.select(F.col("doc_id").alias("doc"), "planes", "bands", "small"), "doc")
    dealt = _cells(rows, "planes", "bands", "small").repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "cell"):
            band = group.column("band").to_numpy()
            for one in np.unique(band):  # two cells' names might collide
                part = group if (band == one).all() else group.filter(pa.array(band == one))
                a, b = _alike(part, int(one))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return dealt.mapInArrow(lean("neardedup", run), "a long, b long").distinct()


def _alike(part: pa.Table, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one cell: of other components, alike enough, and with no common band
    before this one (which has them already)."""
    docs, labels = part.column("doc").to_numpy(), part.column("label").to_numpy()
    left, lead = (part.column(c).to_numpy(zero_copy_only=False) for c in ("left", "lead"))
    planes = part.column("planes").combine_chunks().flatten().to_numpy().reshape(len(docs), -1).view(np.uint64)
    bands = part.column("bands").combine_chunks().flatten().to_numpy().reshape(len(docs), -1)
    n = part.column("small").combine_chunks().value_lengths().fill_null(0).to_numpy()
    small = np.zeros((len(docs), SMALL), np.int64)
    small[np.arange(SMALL) < n[:, None]] = part.column("small").combine_chunks().flatten().to_numpy()
    x = np.flatnonzero(left)
    y = np.flatnonzero(~left)
    out_a, out_b = [], []
    for i in range(0, len(x), 128):
        rows = x[i : i + 128]
        pair = labels[rows][:, None] != labels[y][None, :]
        # Two strays meet twice, each of them once on the left.
        pair &= lead[y][None, :] | (docs[rows][:, None] < docs[y][None, :])
        p, q = np.nonzero(pair)
        for k in range(0, len(p), 1 << 15):
            r, s = rows[p[k : k + (1 << 15)]], y[q[k : k + (1 << 15)]]
            diff = planes[r, :_LONGS] ^ planes[s, :_LONGS]
            for b in range(1, BITS):
                diff |= planes[r, b * _LONGS : (b + 1) * _LONGS] ^ planes[s, b * _LONGS : (b + 1) * _LONGS]
            alike = estimate(np.bitwise_count(diff).sum(axis=1, dtype=np.int64))
            exact = np.flatnonzero((n[r] > 0) & (n[s] > 0))
            if len(exact):
                alike[exact] = _similarity(small[r[exact]], n[r[exact]], small[s[exact]], n[s[exact]])
            r, s = r[alike >= MIN_ESTIMATE], s[alike >= MIN_ESTIMATE]
            if len(r):
                equal = bands[r] == bands[s]
                first = bands[r, equal.argmax(axis=1)] == band
                out_a.append(docs[r[first]]), out_b.append(docs[s[first]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def _similarity(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Exact similarities of rows of sets, of n_a and n_b items and zeros after them."""
    met = np.sort(np.concatenate([a, b], axis=1), axis=1)
    # The zeros of both rows are equal neighbours too.
    both = (met[:, 1:] == met[:, :-1]).sum(axis=1) - np.maximum(2 * a.shape[1] - n_a - n_b - 1, 0)
    return both / (n_a + n_b - both)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself
    included) and kept (doc_id = component_id), one row for each row of docs.

    Links hold between documents with 100 |A & B| >= 75 |A | B| on their distinct 5-word
    shingles (fewer words: the whole sequence as one). Null, empty and blank texts have
    empty sets and link with nothing. Rows that repeat a doc_id are one document, with
    one row each. A null doc_id links with nothing. An empty table gives no rows; other
    columns are not read."""
    small_batches(docs)
    signed = materialize(signatures(docs), "signatures")
    named = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("set_key", "rep")
    classes = materialize(classes, "classes")
    placed = keyed_join(signed.select("doc_id", "n_shingles", "set_key"), classes, ["set_key"], most=MOST)
    placed = placed.select("doc_id", "n_shingles", F.when(F.col("set_key").isNotNull(), F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep"))
    heads = keyed_join(named, classes, ["set_key"], most=MOST).where("rep IS NULL OR rep = doc_id").dropDuplicates(["doc_id"])
    heads = materialize(heads.select("doc_id", "planes", "bands", "small"), "heads")
    banded = heads.select(F.explode("bands").alias("band"), F.col("doc_id").alias("doc"))
    pick = F.min_by("doc", F.xxhash64("doc", "band"))
    buckets = banded.groupBy("band").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), pick.alias("any"), F.count(F.lit(1)).alias("n"))
    buckets = materialize(buckets.where("low < high"), "buckets", few=True)
    met = banded.join(F.broadcast(buckets.select("band")) if buckets.count() <= MOST else buckets.select("band"), "band", "left_semi")
    banded = materialize(met, "banded")
    hubs = materialize(_hub_pairs(banded, buckets), "hub-pairs")
    near = materialize(_estimated(hubs, heads), "near", replaces=[hubs], few=True)
    tried = materialize(_best(near), "tried")
    sets = materialize(shingle_sets(docs, materialize(_ends(near), "ends")).dropDuplicates(["doc"]), "sets")
    links = materialize(confirm(tried, sets), "links", few=True)
    labels = materialize(components(links), "labels")
    more = materialize(_cross_pairs(banded, labels, heads).join(tried, ["a", "b"], "left_anti"), "cross")
    own = materialize(_ends(more).join(sets.select("doc"), "doc", "left_anti"), "ends")
    sets = sets.unionByName(materialize(shingle_sets(docs, own).dropDuplicates(["doc"]), "sets"))
    late = materialize(confirm(more, sets), "late", few=True)
    if not late.isEmpty():
        labels = materialize(components(links.union(late)), "labels")
    done = keyed_join(placed, labels.select(F.col("node").alias("rep"), "label"), ["rep"], most=MOST)
    component = F.coalesce("label", "rep")
    return done.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


OP8_SQL = r"""WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT t.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(t.doc_id, coalesce(min(r.b), t.doc_id)) AS component_id,
  t.doc_id <= coalesce(min(r.b), t.doc_id) AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN r ON r.a = t.doc_id GROUP BY t.doc_id"""
