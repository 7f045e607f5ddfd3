"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


@cache
def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import pack_texts

    return pack_texts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import judge

    return judge(table(spark, sf_dir, "documents")).drop("distance")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.secrets import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.linededup import dedup_lines

    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.topk import int_vectors, top_k

    vectors = int_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.pmod("vec_id", F.lit(50)) == 0))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.warc import derived

    return derived(table(spark, sf_dir, "pages"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pieces import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.neardedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.ctw import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


OP5_SQL = """WITH e AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
  CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

OP10_SQL = r"""WITH l AS (
  SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(c) AS line, generate_subscripts(c, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS c FROM documents))),
r AS (SELECT key, max(doc_id) AS keep FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keep IS NOT NULL AND keep <> l.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keep IS NULL OR keep = l.doc_id), '')) AS kept_sha256
FROM l LEFT JOIN r USING (key) GROUP BY l.doc_id"""


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op5_exact_topk": op5_exact_topk,
    "op6_warc": op6_warc,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_minhash": op8_minhash,
    "op9_ctw": op9_ctw,
    "op10_line_dedup": op10_line_dedup,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from tessera.llm import neardedup, quality_sql, secrets, warc

    return {
        "op3_quality_rules": quality_sql.oracle_sql(),
        "op4_secret_scans": secrets.oracle_sql(),
        "op5_exact_topk": OP5_SQL,
        "op6_warc": warc.oracle_sql(),
        "op8_minhash": neardedup.OP8_SQL,
        "op10_line_dedup": OP10_SQL,
    }
