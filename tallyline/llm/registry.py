"""The thin ``opN_<name>`` queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, chat, fingerprints, jaccard, langid, lines, mixing, packing, quality, repeats, topk, urls, variants
from .common import bucket_of, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix_documents(documents(spark, sf_dir))
    return got.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query(
    "op6_topk",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("id") % 100 == 0))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query("op4_urls", urls.ORACLE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


@query("op1_langid")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = bucket_of(F.col("doc_id"), 4)
    got = langid.identify_documents(docs, F.coalesce(fold != 2, F.lit(True)), ["doc_id"])
    return got.select("doc_id", F.coalesce(bucket_of(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 3) == 1, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    got = quality.classify_documents(documents(spark, sf_dir), labels.select("doc_id", F.col("quality").alias("label")))
    return got.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_jaccard")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jaccard.similar_components(documents(spark, sf_dir), shingle=4, percent=85)
    return got.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query("op5_lines", lines.ORACLE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines.dedup_lines(documents(spark, sf_dir))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op3_repeats")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repeats.remove_repeats(documents(spark, sf_dir))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"))


@query("op13_audit", audit.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op12_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.occurrences(documents(spark, sf_dir)))


#: a conversation whose texts hold the template's control strings
HARD_CASE = (
    "SELECT -7L AS conv_id, turn, role, r'\\### Assistant: </turn> ok' AS text "
    "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
)


@query("op11_chat", chat.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.unionByName(spark.sql(HARD_CASE))))
