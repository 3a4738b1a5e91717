"""Language identification by a blended-spectrum kernel, Nystroem landmarks and kernel ridge regression.

A text's spectrum is the set of its letter n-grams of 1 to 3 places (characters other than letters
are one kind, that of gaps). The kernel of two texts is the share of n-grams that they have in
common, normalised. Texts are compared with a fixed number of landmarks; one ridge regression for
each language, against all others, is fitted on these values, and all scores of a batch are matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, wordhash


@dataclass(frozen=True)
class Learner:
    rows: int = 2000  # documents of each language learned from at most: those whose hashed ids are smallest
    landmarks: int = 160  # in all, as many for each language
    ridge: float = 1e-3
    tasks: int = 8  # that sum up the regression


KINDS = 64
SPECTRUM = KINDS + KINDS**2 + KINDS**3


@cache
def _kinds() -> np.ndarray:
    """Gap 0, a-z 1 to 26, other letters by a hash among the rest."""
    points = np.arange(0x110000, dtype=np.uint64)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    kind = np.where(letter, 27 + (points * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(KINDS - 27), 0).astype(np.uint8)
    kind[97:123] = np.arange(1, 27)
    return kind


def spectra(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of n-grams present for each text, which texts have a letter)."""
    present = np.zeros((len(texts), SPECTRUM), bool)
    lower = [f" {x.lower()} " for x in texts]
    kind = _kinds()[np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    ends = np.cumsum([len(x) for x in lower])
    base = np.repeat(np.arange(len(texts)) * SPECTRUM, [len(x) for x in lower])
    flat = present.reshape(-1)
    flat[base + kind] = True
    pair = kind[:-1] * KINDS + kind[1:]
    # An n-gram over the end of a text is one of gaps only, or begins with one that the text has; it goes to gaps.
    inside = np.ones(len(kind), bool)
    inside[ends - 1] = False
    two = inside[:-1]
    flat[(base[:-1] + KINDS + pair)[two]] = True
    three = two[:-1] & two[1:]
    flat[(base[:-2] + KINDS + KINDS**2 + pair[:-1] * KINDS + kind[2:])[three]] = True
    present[:, 0] = present[:, KINDS] = present[:, KINDS + KINDS**2] = False  # gaps alone
    return present, present[:, 1:KINDS].any(axis=1)


@dataclass
class Model:
    languages: list[str]
    places: np.ndarray  # n-grams that landmarks have
    landmarks: np.ndarray  # places x landmarks, normalised
    weights: np.ndarray  # landmarks and constant x languages


def _kernel(present: np.ndarray, model: Model) -> np.ndarray:
    norm = np.sqrt(np.maximum(1, [np.count_nonzero(x) for x in present]))
    near = present[:, model.places].astype(np.float32) @ model.landmarks / norm[:, None]
    return np.concatenate([near, np.ones((len(near), 1))], axis=1)


def _runs(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows: few enough for a dense matrix, and of a bounded size."""
    texts = batch.column(column)
    for first, last, _, _ in wordhash.slices(texts, 1 << 18):
        for at in range(first, last, 64):
            yield at, [x or "" for x in texts.slice(at, min(64, last - at)).to_pylist()]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in _runs(batch, 0):
            rows = [x.tobytes() for x in np.packbits(spectra(texts)[0], axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["bits"])


def _sums(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    size, names = model.landmarks.shape[1] + 1, {x: i for i, x in enumerate(model.languages)}
    square, cross = np.zeros((size, size)), np.zeros((size, len(names)))
    for batch in batches:
        of = batch.column(1).to_pylist()
        for at, texts in _runs(batch, 0):
            k = _kernel(spectra(texts)[0], model)
            y = np.full((len(texts), len(names)), -1.0)
            y[np.arange(len(texts)), [names[x] for x in of[at : at + len(texts)]]] = 1
            square += k.T @ k
            cross += k.T @ y
    yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()], pa.binary()), pa.array([cross.tobytes()], pa.binary())], names=["square", "crossed"])


def fit(docs: DataFrame, learner: Learner | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the texts of documents with a language; null texts and languages are passed over.

    For each language the ``learner.rows`` documents with the smallest hashed ids are used; which
    ones is settled on ids alone, of rows with one id and language one is used, those without an id
    are not. Other columns are ignored; without rows no language is learned. To the driver come
    landmarks and sums of a fixed size, and the names of the languages.
    """
    learner = learner or Learner()
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    chosen = common.smallest_hashed(rows.where("doc_id is not null").select("doc_id", "lang").distinct(), "doc_id", learner.rows, "lang")
    chosen = common.written(chosen, "chosen_texts")
    texts = rows.join(common.small_or_not(chosen), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])
    texts = common.written(texts.select("text", "lang", "place"), "learned_from")
    languages = sorted(x[0] for x in chosen.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 1), np.float32), np.zeros((2, 0)))
    each = max(1, learner.landmarks // len(languages))
    bits = texts.where(F.col("place") <= each).repartition(learner.tasks).select("text").mapInArrow(_packed, "bits binary").collect()
    marks = np.unpackbits(np.frombuffer(b"".join(sorted(x[0] for x in bits)), np.uint8).reshape(len(bits), -1), axis=1, count=SPECTRUM).astype(np.float32)
    places = np.flatnonzero(marks.any(axis=0))
    landmarks = (marks[:, places] / np.sqrt(np.maximum(1, marks.sum(axis=1, keepdims=True)))).T.astype(np.float32)
    model = Model(languages, places, np.ascontiguousarray(landmarks), np.zeros((landmarks.shape[1] + 1, len(languages))))
    sums = texts.repartition(learner.tasks).select("text", "lang").mapInArrow(lambda it: _sums(it, model), "square binary, crossed binary").collect()
    size = len(model.weights)
    square = sum(np.frombuffer(x[0]).reshape(size, size) for x in sums)
    crossed = sum(np.frombuffer(x[1]).reshape(size, -1) for x in sums)
    # Nystroem: the penalty is in the landmarks' own kernel, the constant is free of it.
    penalty = np.zeros((size, size))
    penalty[:-1, :-1] = landmarks.T @ landmarks
    n = max(1.0, square[-1, -1])
    model.weights = np.linalg.solve(square + learner.ridge * n * penalty / size + 1e-8 * n * np.eye(size), crossed)
    return model


def _predict(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch in batches:
        for at, texts in _runs(batch, 1):
            present, letters = spectra(texts)
            names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if model.languages and letters.any():
                value = _kernel(present[letters], model) @ model.weights
                best = value.argmax(axis=1)
                names[letters] = np.array(model.languages, object)[best]
                score[letters] = 1 / (1 + np.exp(-4 * value[np.arange(len(best)), best]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the language of each whole text, and how sure that is, from 0 to 1.

    ``und`` with score 0 for null texts and texts without letters, and where no language was learned.
    Each row is judged by its text alone; null and repeated ids stay, other columns are ignored.
    """
    spark = docs.sparkSession
    common.importable(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _predict(it, sent), "doc_id long, lang_pred string, score double")
