"""Text quality by hashed word n-grams and logistic regression, learned with follow-the-regularised-leader.

The n-grams are of words (lower-cased) and of word forms: the kinds of characters in a word, runs of
one kind counted once, with a mark for words that repeat the one before. A feature's value is its
share among the text's n-grams of that sort, so the score of a text of any length is the mean of
its n-grams' weights, a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, wordhash


@dataclass(frozen=True)
class Learner:
    rows: int = 8192  # labelled documents learned from at most: those whose hashed ids are smallest
    dimensions: int = 1 << 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    epochs: int = 4
    scale: float = 10.0  # of the feature values


#: Kinds of characters: lower-case (and all beyond ASCII), upper-case, digits, and each other one by itself.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = _KIND[128:] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48
_KEYS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def ngrams(data: np.ndarray, offsets: np.ndarray, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each sort of n-gram: feature of each n-gram, and first and last-plus-one n-gram of each text."""
    words, at = wordhash.word_hashes(data, offsets)
    first, last = at[:-1], at[1:]
    forms = np.zeros(len(words), np.uint64)
    if len(words):
        space = wordhash._SPACE[data]
        kind = _KIND[data]
        begins = ~space
        begins[1:] &= space[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begins[edge] = ~space[edge]
        runs = ~space & begins
        runs[1:] |= ~space[1:] & (kind[1:] != kind[:-1])
        place = np.flatnonzero(runs)
        of = np.cumsum(begins)[place] - 1
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        turn = np.arange(len(place)) - np.repeat(starts, np.diff(np.append(starts, len(place))))
        forms = wordhash.mix(np.add.reduceat(_KEYS[kind[place]] * (2 * turn.astype(np.uint64) + np.uint64(1)) ** np.uint64(3), starts))
        again = np.zeros(len(words), bool)
        again[1:] = words[1:] == words[:-1]
        inner = first[(first < len(words)) & (first < last)]
        again[inner] = False
        forms = np.where(again, wordhash.mix(forms + np.uint64(12345)), forms)
    mask = np.uint64(dimensions - 1)
    for salt, x in enumerate((words, forms)):
        salted = wordhash.mix(x + np.uint64(2 * salt))
        yield (salted & mask).astype(np.int64), first, last
        pairs = wordhash.mix(x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:] + np.uint64(2 * salt + 1))
        yield (pairs & mask).astype(np.int64), np.minimum(first, len(pairs)), np.maximum(np.minimum(first, len(pairs)), last - 1)


def _train(batches: Iterator[pa.RecordBatch], learner: Learner) -> Iterator[pa.RecordBatch]:
    """One task: (place, weight) of the weights that aren't 0; place -1 is the constant."""
    examples = []
    for batch in batches:
        label = batch.column(0).to_numpy()
        for begin, end, data, offsets in wordhash.slices(batch.column(1)):
            where, value = ([[] for _ in range(end - begin)] for _ in range(2))
            for feature, first, last in ngrams(data, offsets, learner.dimensions):
                for row in range(end - begin):
                    places, counts = np.unique(feature[first[row] : last[row]], return_counts=True)
                    where[row].append(places.astype(np.int32))
                    value[row].append((counts / max(1, counts.sum()) * learner.scale).astype(np.float32))
            examples += [(np.concatenate(w), np.concatenate(v), float(y)) for w, v, y in zip(where, value, label[begin:end], strict=True)]
    z, n = np.zeros(learner.dimensions + 1), np.zeros(learner.dimensions + 1)

    def weights(where):
        zs = z[where]
        return np.where(np.abs(zs) <= learner.l1, 0.0, (np.sign(zs) * learner.l1 - zs) / ((learner.beta + np.sqrt(n[where])) / learner.alpha + learner.l2))

    for epoch in range(learner.epochs):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            where, value, label = examples[i]
            where, value = np.append(where, learner.dimensions), np.append(value, 1.0)
            w = weights(where)
            gradient = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            old = n[where]
            # A place may occur under two sorts of n-gram, so updates are added up.
            np.add.at(z, where, gradient - (np.sqrt(old + gradient**2) - np.sqrt(old)) / learner.alpha * w)
            np.add.at(n, where, gradient**2)
    w = weights(np.arange(learner.dimensions + 1))
    places = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(places == learner.dimensions, -1, places)), pa.array(w[places])], names=["place", "weight"])


def fit(docs: DataFrame, labels: DataFrame, learner: Learner | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights learned from the texts of labelled documents (label 0 or 1; others are passed over).

    At most ``learner.rows`` labels are used, in the order of their hashed ids, in one task; the
    weights are of a fixed number. Of repeated labels of an id
    the larger counts, of rows with one id the one whose text has the smallest hash. Null ids and null
    labels are passed over, null texts count as empty; without labels all weights are 0. Other columns
    are ignored.
    """
    learner = learner or Learner()
    common.importable(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = common.written(known.groupBy("doc_id").agg(F.max("label").alias("label")), "known")
    chosen = common.written(common.smallest_hashed(known, "doc_id", learner.rows).select("doc_id", "label"), "chosen")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    once = once.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("label", "text")
    found = once.mapInArrow(lambda it: common.trimmed(_train(it, learner)), "place long, weight double").collect()  # of a fixed number
    weights = np.zeros(learner.dimensions + 1)
    for place, weight in found:
        weights[place] = weight
    return weights


def _score(batches: Iterator[pa.RecordBatch], weights, learner: Learner) -> Iterator[pa.RecordBatch]:
    """(row, text) with a score in the text's place."""
    w = weights.value
    for batch in batches:
        scores = np.empty(batch.num_rows)
        for begin, end, data, offsets in wordhash.slices(batch.column(1)):
            total = np.full(end - begin, w[-1])
            for feature, first, last in ngrams(data, offsets, learner.dimensions):
                sums = np.concatenate([[0.0], np.cumsum(w[feature])])
                total += (sums[last] - sums[first]) / np.maximum(1, last - first) * learner.scale
            scores[begin:end] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["row", "score"])


def _scored(docs: DataFrame, weights: np.ndarray, learner: Learner, keep: list[str], text_col: str) -> DataFrame:
    """(row, score): the columns ``keep`` of each row as a struct, so that they meet no others."""
    spark = docs.sparkSession
    common.importable(spark)
    sent = spark.sparkContext.broadcast(weights)
    # A struct has to have a field; the mark stands for rows of which nothing is kept.
    row = F.struct(F.lit(True).alias("quality_mark"), *[F.col(f"`{c}`") for c in keep]) if "quality_mark" not in keep else F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(row.alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lambda it: common.trimmed(_score(it, sent, learner)), schema)


def score(docs: DataFrame, weights: np.ndarray, learner: Learner | None = None, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of docs, all if none are named, and quality_score: from 0 to 1, how likely the text has label 1.

    Null texts and texts without words get what the constant alone gives. Each row is scored on its
    own, from its whole text alone; repeated and null ids stay as they are; an empty table gives no
    rows. A column of docs called quality_score is not kept, any other name is free.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c != "quality_score"]
    found = _scored(docs, weights, learner or Learner(), keep, text_col)
    return found.select(*[F.col(f"row.`{c}`") for c in keep], F.col("score").alias("quality_score"))


def good(docs: DataFrame, weights: np.ndarray, least: float = 0.5, learner: Learner | None = None, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is at least ``least``, with all their columns, whatever these are called."""
    found = _scored(docs, weights, learner or Learner(), docs.columns, text_col).where(F.col("score") >= least)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns])
