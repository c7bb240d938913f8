"""A corpus made ready for training, stage by stage.

Each stage takes the rows that the one before it left, and works on all of them. All but the last return
the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, language_id, minhash, mixing, personal_data
from tidemark.llm.common import stored

#: Words in a shingle and the least similarity, in percent, of near duplicates.
SHINGLE, PERCENT = 5, 80
#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
OWN = "__stage"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told. Texts that are null, empty or without letters go."""
    found = language_id.predict(docs, language_id.learn(docs), into=OWN)
    return found.filter(language_id.known_language(F.col(OWN))).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Of rows that share its id, one of each text stays. Rows without an id stay.
    """
    found = minhash.near_duplicates(docs, SHINGLE, PERCENT)
    gone = found.filter("NOT kept").select(F.col("id").alias(OWN)).distinct()
    left = docs.filter("doc_id IS NOT NULL").join(gone, F.col("doc_id") == F.col(OWN), "left_anti")
    order = Window.partitionBy("doc_id", "text").orderBy(*[c for c in ("lang", "source", "n_chars") if c in docs.columns])
    once = left.withColumn(OWN, F.row_number().over(order)).filter(F.col(OWN) == 1).select(docs.columns)
    return once.union(docs.filter("doc_id IS NULL"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their personal data replaced by its kind; ``n_chars`` follows the text."""
    found = personal_data.find(docs, personal_data.learn(docs), into=OWN)
    text = personal_data.redacted(F.col("text"), F.col(OWN)["spans"])
    changed = found.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return changed.select(docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's target weight asks for: none, or up to three."""
    found = mixing.copies(docs, mixing.balance(docs, WEIGHTS), into=OWN).filter(F.col(OWN)["copies"] > 0)
    copies = F.sequence(F.lit(1).cast("long"), F.col(OWN)["copies"])
    return found.withColumn(OWN, F.explode(copies)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    vocabulary = bpe.load(spark, VOCABULARY, public_tokenizers.PATTERN)
    ids = docs.select("doc_id", "lang", "source", bpe.encode(F.col("text"), vocabulary).alias("ids"))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", known_language),
    ("near copies", without_near_copies),
    ("personal data", without_personal_data),
    ("mixing", mixed_sources),
    ("tokens", encoded),
]
#: Similarity over whole texts, learned trees and tokens are not for SQL; a test has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` applied to ``documents``, each one's rows written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k}")
    return docs
