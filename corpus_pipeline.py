"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoquilt.llm import common, mixing, near_duplicates, packing, pii, quality, queries, tokens


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned on the labels of these, does not reject.

    Null and empty texts get the score of the constant alone; repeated rows are judged alike. Nothing
    is learned from an empty table or without labels, and then all scores are 0.5, which keeps a row.
    """
    labels = common.read(spark, sf_dir, "labels").where(~F.coalesce(queries.held_out(), F.lit(True)))
    return quality.good(docs, quality.fit(docs, labels), least=0.5)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; of rows with one id, one.

    Documents without an id, and those without words, stay.
    """
    return near_duplicates.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars, if there is one, follows the text. Null texts stay null."""
    return pii.clean(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times; null is a source of its own. Repeated rows and null ids are documents like others."""
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences. A null or empty text is one token long, a repeated row is packed again."""
    room = packing.Room()
    return packing.pack(tokens.pieces(docs, queries.vocabulary("word_bpe_49k.json"), end=0, most=room.tokens, kept=KEPT), room)


#: Stretches that a worker keeps while it packs. The workers of one stage serve the next, so what they keep adds to the memory of all.
KEPT = 200_000

STAGES = [
    ("quality", good_documents),
    ("near_dedup", one_of_each_group),
    ("pii", without_personal_data),
    ("mix", mixed_sources),
    ("pack", packed_sequences),
]

#: The learned, hashed and packed stages have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
