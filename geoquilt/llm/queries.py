"""Queries of the corpus operators over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, importance, katz, language, licenses, mixing, near_duplicates, near_vectors, nearest, packing, pii, quality, tokens
from .common import read


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    room = packing.Room()
    cut = tokens.pieces(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end=0, most=room.tokens)
    return packing.pack(cut, room)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"), near_duplicates.Forest(words=2))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = [pii.count("pii_base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.digest("pii_base"), 256).alias("base_sha256"), pii.digest("pii_spans").alias("spans"))


def held_out():
    """Documents that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs.where(~F.coalesce(held_out(), F.lit(True))))
    return language.identify(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    weights = quality.fit(docs, read(spark, sf_dir, "labels").where(~F.coalesce(held_out(), F.lit(True))))
    scored = quality.score(docs, weights, keep=["doc_id"]).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.token_counts(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(read(spark, sf_dir, "conversations"))


def op12_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = katz.score(docs, ~F.coalesce(held, F.lit(True)), order=2)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_license_scan": op2_license_scan,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_katz_scores": op12_katz_scores,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.oracle(),
    "op4_exact_top_k": """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 50 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5
""",
}
