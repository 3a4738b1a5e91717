"""Importance resampling towards a target: hashed n-gram features, bucket totals of both sides, Gumbel top-k.

A feature's bucket is a CRC of its bytes. Frequent words and pairs, the head, come to the tasks as
tables: a word's CRC state, and a pair's state and bucket. What is not in them, the tail, takes its
CRC directly from the bytes. A longer feature goes on from the state of its beginning, as the CRC
of two parts follows from theirs. Which words are in the head changes no result, only the work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, wordhash

BUCKETS = 10_000
LENGTHS = 3  # features are runs of one to so many words
#: A word or pair that makes up such a share of the corpus has it in one slice of texts at least, and is a candidate there.
HEAD_SHARE = 1e-5
#: Bounds of the two broadcast tables.
HEAD_WORDS, HEAD_PAIRS = 1 << 15, 1 << 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _step_zeros(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[state & 0xFF] ^ (state >> np.uint32(8))


_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


class _Shifts:
    """What so many further bytes do to the CRC before them: four tables a length, made when a length first occurs."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}
        self.tables = np.zeros((0, 4, 256), np.uint32)

    def places(self, lengths: np.ndarray) -> np.ndarray:
        known, back = np.unique(lengths, return_inverse=True)
        for n in known.tolist():
            if n not in self.of:
                unit = (np.uint32(1) << np.arange(32, dtype=np.uint32)).astype(np.uint32)
                power = unit.copy()  # the linear map of one zero byte, then by squares that of n
                one, m = _step_zeros(unit, _CRC), n
                while m:
                    if m & 1:
                        power = _apply(one, power)
                    one = _apply(one, one)
                    m >>= 1
                byte = np.arange(256, dtype=np.uint32)
                self.of[n] = len(self.tables)
                self.tables = np.concatenate([self.tables, np.stack([_apply(power, byte << np.uint32(8 * k)) for k in range(4)])[None]])
        return np.array([self.of[n] for n in known.tolist()], np.int64)[back]


def _apply(power: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The linear map that takes bit k to power[k]."""
    out = np.zeros(len(values), np.uint32)
    for k in range(32):
        out ^= np.where(values >> np.uint32(k) & 1, power[k], np.uint32(0))
    return out


def _joined(first: np.ndarray, second: np.ndarray, place: np.ndarray, shifts: _Shifts) -> np.ndarray:
    """CRCs of first + second, from theirs; place names the length of the second."""
    t = shifts.tables
    return t[place, 0, first & 0xFF] ^ t[place, 1, first >> 8 & 0xFF] ^ t[place, 2, first >> 16 & 0xFF] ^ t[place, 3, first >> 24] ^ second


@dataclass
class Head:
    """Frequent words with their states, and frequent pairs (numbers of their words) with state and bucket."""

    words: list[bytes] = field(default_factory=list)
    pairs: list[tuple[bytes, bytes]] = field(default_factory=list)

    def tables(self) -> dict:
        number = {w: i for i, w in enumerate(self.words)}
        known = sorted((number[a] << 32 | number[b], zlib.crc32(a + b" " + b)) for a, b in self.pairs if a in number and b in number)
        keys, states = np.array([k for k, _ in known], np.int64), np.array([s for _, s in known], np.uint32)
        return {
            "words": self.words,
            "states": np.array([zlib.crc32(w) for w in self.words], np.uint32),
            "spaced": np.array([zlib.crc32(b" " + w) for w in self.words], np.uint32),
            "pairs": keys,
            "pair_states": states,
            "pair_buckets": (states % np.uint32(BUCKETS)).astype(np.uint16),
        }


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, lower-cased, and the number of each one's text."""
    low = _LOWER[data]
    word = _WORD[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1 : len(data)]
    ends[:-1] &= ~word[1:] | edge[1 : len(data)]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, begins, side="right") - 1
    at = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins, out=at[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(at), pa.py_buffer(low[word])]), text


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 22):
    for batch in batches:
        for first, last, data, offsets in wordhash.slices(batch.column(1), size):
            words, text = _words(data, offsets)
            yield batch.column(0).slice(first, last - first), last - first, words, text


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, second or null, n): words and pairs that make up HEAD_SHARE of a slice."""
    for _, _, words, text in _slices(batches):
        if not len(words):
            continue
        coded = words.dictionary_encode()
        codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        counts = np.bincount(codes)
        top = np.flatnonzero(counts >= max(2, HEAD_SHARE * len(words)))
        both = (codes[:-1] << 32 | codes[1:])[text[1:] == text[:-1]]
        pairs, n = np.unique(both, return_counts=True)
        often = n >= max(2, HEAD_SHARE * len(both) * 10)
        pairs, n = pairs[often], n[often]
        first = pa.chunked_array([names.take(pa.array(top)), names.take(pa.array(pairs >> 32))]).combine_chunks()
        second = pa.chunked_array([pa.nulls(len(top), pa.large_binary()), names.take(pa.array(pairs & 0xFFFFFFFF))]).combine_chunks()
        yield pa.RecordBatch.from_arrays([first.cast(pa.binary()), second.cast(pa.binary()), pa.array(np.concatenate([counts[top], n]).astype(np.int64))], names=["first", "second", "n"])


def frequent(texts: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The head of a corpus ``(id, text)``: at most so many words and pairs, the most frequent candidates."""
    counted = texts.mapInArrow(_frequent, "first binary, second binary, n long").groupBy("first", "second").agg(F.sum("n").alias("n"))
    counted = common.written(counted, "frequent")
    # Bounded by the two limits, whatever the corpus.
    top = lambda df, most: [(bytes(r.first), r.second and bytes(r.second)) for r in df.orderBy(F.desc("n"), "first", "second").limit(most).collect()]
    return Head([w for w, _ in top(counted.where("second is null"), words)], top(counted.where("second is not null"), pairs))


def _buckets(words: pa.Array, text: np.ndarray, head: dict, shifts: _Shifts) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each feature, and the number of its text."""
    if not len(words):
        return np.zeros(0, np.uint16), np.zeros(0, np.int64)
    coded = words.dictionary_encode()
    codes, names = coded.indices.to_numpy(), coded.dictionary
    number = pc.index_in(names, value_set=pa.array(head["words"], pa.large_binary())).fill_null(-1).to_numpy().astype(np.int64) if head["words"] else np.full(len(names), -1)
    state, spaced = np.zeros(len(names), np.uint32), np.zeros(len(names), np.uint32)
    of_head = number >= 0
    state[of_head], spaced[of_head] = head["states"][number[of_head]], head["spaced"][number[of_head]]
    tail = np.flatnonzero(~of_head)
    tail_words = names.take(pa.array(tail)).to_pylist()
    state[tail], spaced[tail] = [zlib.crc32(w) for w in tail_words], [zlib.crc32(b" " + w) for w in tail_words]
    place = shifts.places(pc.binary_length(names).to_numpy() + 1)[codes]
    number, state, spaced = number[codes], state[codes], spaced[codes]
    out, texts = [(state % np.uint32(BUCKETS)).astype(np.uint16)], [text]
    within = np.flatnonzero(text[1:] == text[:-1]) if len(text) > 1 else np.zeros(0, np.int64)
    pair = np.zeros(len(text), np.uint32)
    bucket = np.zeros(len(within), np.uint16)
    key = np.where((number[within] >= 0) & (number[within + 1] >= 0), number[within] << 32 | number[within + 1], -1)
    at = np.minimum(np.searchsorted(head["pairs"], key), max(0, len(head["pairs"]) - 1))
    known = head["pairs"][at] == key if len(head["pairs"]) else np.zeros(len(key), bool)
    pair[within[known]], bucket[known] = head["pair_states"][at[known]], head["pair_buckets"][at[known]]
    rest = within[~known]
    pair[rest] = _joined(state[rest], spaced[rest + 1], place[rest + 1], shifts)
    bucket[~known] = pair[rest] % np.uint32(BUCKETS)
    out.append(bucket)
    texts.append(text[within])
    longer, begun = within, pair
    for k in range(2, LENGTHS):
        longer = longer[(longer + k < len(text))]
        longer = longer[text[longer + k] == text[longer]]
        new = np.zeros(len(text), np.uint32)
        new[longer] = _joined(begun[longer], spaced[longer + k], place[longer + k], shifts)
        out.append((new[longer] % np.uint32(BUCKETS)).astype(np.uint16))
        texts.append(text[longer])
        begun = new
    return np.concatenate(out), np.concatenate(texts)


def _featured(batches: Iterator[pa.RecordBatch], head: dict) -> Iterator[pa.RecordBatch]:
    """(row, n_words, buckets): the buckets of each text's features as unsigned 16-bit numbers."""
    shifts = _Shifts()
    for ids, n, words, text in _slices(batches):
        bucket, of = _buckets(words, text, head, shifts)
        bucket = bucket[np.argsort(of, kind="stable")]
        ends = np.cumsum(np.bincount(of, minlength=n)) * 2
        data, starts = bucket.tobytes(), np.concatenate([[0], ends[:-1]])
        held = pa.array([data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.bincount(text, minlength=n).astype(np.int64)), held], names=["doc_id", "n_words", "buckets"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            sums += np.bincount(np.frombuffer(x.as_buffer(), np.uint16), minlength=BUCKETS)
    some = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "n"])


def _weights(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = [int(gains[np.frombuffer(x.as_buffer(), np.uint16)].sum()) for x in batch.column(2)]
        size = [len(x.as_buffer()) // 2 for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(total, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])


def features(docs: DataFrame, head: Head | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, buckets binary) of every row: the buckets of all its features, two bytes each.

    Words are runs of digits, a-z (A-Z count as these) and everything beyond ASCII; features are runs of one to three words.
    A null text has none. Repeated rows and null ids stay; other columns are ignored; an empty table gives no rows.
    """
    common.importable(docs.sparkSession)
    tables = (head or Head()).tables()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _featured(it, tables), "doc_id long, n_words long, buckets binary")


def totals(featured: DataFrame) -> DataFrame:
    """(bucket, n): exact counts over all rows; each task sends at most one row for each bucket."""
    return featured.select("buckets").mapInArrow(_totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) for every bucket: floor(1000 ln ratio) of the smoothed shares in the target and in the source."""
    spark = source.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    counts = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    sums = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + BUCKETS)).cast("double") / ((F.col("s") + 1) * (F.col("all_t") + BUCKETS)).cast("double")
    return counts.crossJoin(F.broadcast(sums)).select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain"))  # sums is one row


def gumbel(seed: int, id_col: Column) -> Column:
    """floor(1000 g) with a standard Gumbel number g that hangs on the seed and the id only; a null id counts as none."""
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank): documents drawn towards the texts of ``target``, without replacement.

    weight sums the gains of a document's features, score adds a Gumbel number. Of the N documents with ``least_words`` words
    at least the floor(percent N / 100) highest scores are drawn, rank from 1, ties to the smaller id (then the fewer features;
    null ids last); rank is null for the rest. Rows that share an id are documents of their own. Null and empty texts have
    weight 0. Without a target all gains come from the source alone. Other columns are ignored; an empty table gives no rows.
    Ranks come from ranges of the scores; no task or driver holds the documents.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    aims = target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_col).alias("text"))
    common.importable(spark)
    head = frequent(texts.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    featured = common.written(features(texts, head), "features")
    # Always BUCKETS rows.
    found = gains(totals(featured), totals(features(aims, head))).collect()
    table = np.zeros(BUCKETS, np.int64)
    for r in found:
        table[r.bucket] = r.gain
    weighed = featured.mapInArrow(lambda it: _weights(it, table), "doc_id long, n_words long, n_features long, weight long")
    scored = common.written(weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))), "scored")
    rest = scored.where(F.col("n_words") < least_words).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    able = scored.where(F.col("n_words") >= least_words).withColumn("one", F.lit(1).cast("long"))
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features")]
    ranked = common.running_total(able, order, "one", "place", "scores")
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank")).unionByName(rest)
