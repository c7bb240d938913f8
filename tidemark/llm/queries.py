"""The operators bound to the given tables, with the SQL they must agree with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, bpe, language_id, link_trust, lm_scoring, minhash, mixing, near_vectors, oracles, personal_data, quality,
    suffix_dedup, top_k, whitening,
)
from tidemark.llm.common import remainder, stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
SOURCE_WEIGHTS = (5, 2, 1)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
QUALITY_THRESHOLD = 0.7


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    encoded = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), vocabulary).alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )


@query("op2_personal_data")
def documents_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    once = stored(personal_data.propose(documents).drop("text"), "candidates")
    found = personal_data.find(once, personal_data.learn(once, given="proposed"), given="proposed")
    base = F.col("personal.base")
    return found.select(
        "doc_id",
        *[personal_data.count_of(base, k).alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)],
        F.sha2(personal_data.written(base).cast("binary"), 256).alias("base_sha256"),
        personal_data.written(F.col("personal.spans")).alias("spans"),
    )


@query("op3_suffix_dedup", oracles.SUFFIX_DEDUP)
def documents_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op4_lm_scoring")
def documents_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) != 2, taught=1)
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "bits_per_byte",
    )


@query("op5_link_trust")
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.verdicts(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES).select(
        "page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict"
    )


@query("op7_minhash", oracles.MINHASH)
def documents_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.withColumnRenamed("id", "doc_id")


@query("op6_near_vectors", oracles.NEAR_VECTORS)
def embeddings_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), 0.95).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", "kept"
    )


@query("op8_top_k", oracles.TOP_K)
def embeddings_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op9_mixing")
def documents_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    mixed = mixing.copies(documents, mixing.balance(documents, SOURCE_WEIGHTS))
    return mixed.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.copies") * F.col("mix.size")).alias("taken")
    )


@query("op10_language_id")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    profiles = language_id.learn(documents.filter(~held_out))
    return language_id.predict(documents, profiles).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("prediction.lang").alias("lang_pred"),
        F.col("prediction.score").alias("score"),
    )


@query("op11_alignment")
def documents_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = alignment.load(spark, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES), public_tokenizers.PATTERN)
    rows, _ = alignment.align(table(spark, sf_dir, "documents"), tokenizers)
    return rows.withColumnRenamed("id", "doc_id")


@query("op12_whitening")
def embeddings_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = whitening.whiten(vectors, whitening.scaled(F.col("embedding"), 64, 1_000_000), components=16)
    return found.select("vec_id", F.posexplode("white.whitened").alias("place", "whitened"), "white").select(
        "vec_id", (F.col("place") + 1).alias("component"), "white.n", "white.deviation", "whitened",
        F.get("white.explained", F.col("place")).alias("explained"), "white.identity_error",
    )


@query("op13_quality")
def documents_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 4) == 2
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    found = quality.score(documents, quality.learn(documents, labels))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted")
    )
