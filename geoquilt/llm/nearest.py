"""Exact top-k by inner product, with bounds from segment statistics, coarse to fine.

Vectors are whole numbers, floor(scale * x). A vector is cut into segments; the inner product of two
segments of length L is at most L (mean mean' + deviation deviation'). Summed over the segments
this bounds the score, more tightly the more segments there are. Candidates are sorted by the signs
and sizes of their coarse means, so that groups and blocks of them have narrow statistics of their
own. Each query learns a score that it surely reaches from a few candidates; groups, then blocks,
then vectors whose bound is below it are dropped, and what is left is computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .vectors import matrices

#: Numbers of segments, from coarse to fine; those that would cost as much as the exact product are left out.
LEVELS = (4, 16, 64)
#: Candidates of a group, which one task holds at a time, of a block of it, and queries that meet a block at a time.
GROUP, BLOCK, ASKED = 1 << 15, 2048, 1024
#: Candidates that give each query a first score to reach.
SCOUTS = 2048
#: A share of survivors from which a whole matrix product is cheaper than products of single pairs.
DENSE = 0.05
#: Doubles hold whole numbers up to here exactly.
EXACT = float(1 << 53)
MOST = (1 << 63) - 1


def levels(size: int) -> list[int]:
    return [x for i, x in enumerate(LEVELS) if i == 0 or 2 * x < size]


def profile(values: np.ndarray, level: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that two profiles' inner product is the bound."""
    pieces = np.array_split(np.arange(values.shape[1]), min(level, values.shape[1]))
    means = [values[:, p].mean(axis=1) * np.sqrt(len(p)) for p in pieces]
    return np.stack([*means, *[values[:, p].std(axis=1) * np.sqrt(len(p)) for p in pieces]], axis=1)


def _tame(values: np.ndarray) -> np.ndarray:
    """Rows whose inner products with each other doubles hold exactly."""
    return np.abs(values).max(axis=1) <= np.sqrt(EXACT / values.shape[1])


def _slack(x: np.ndarray | float) -> np.ndarray | float:
    """More than rounding can take from a bound of about this size."""
    return 1e-9 * (np.abs(x) + 1)


def _keys(coarse: np.ndarray) -> np.ndarray:
    """Numbers that are near where coarse means are: their bits, 5 of each mean's rank among fixed steps, by turns."""
    half = coarse.shape[1] // 2
    means = coarse[:, :half]
    steps = (np.tanh(means / (np.abs(means).mean() + 1e-300)) * 15.5 + 16).astype(np.int64)
    key = np.zeros(len(means), np.int64)
    for bit in range(4, -1, -1):
        for j in range(half):
            key = key * 2 + (steps[:, j] >> bit & 1)
    return key


_READY = "vec_id long, size int, key long, coarse array<double>, vector binary"


def _ready(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """(vec_id, size, key, coarse, vector): whole-number vectors as bytes, with their coarse statistics."""
    for batch in batches:
        for rows, matrix in matrices(batch.column(1)):
            values = np.floor(matrix * scale)
            coarse = profile(values, LEVELS[0])
            n = len(rows)
            width = coarse.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(coarse.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(np.full(n, values.shape[1], np.int32)), pa.array(_keys(coarse)), listed, pa.array([x.tobytes() for x in values], pa.binary())],
                names=["vec_id", "size", "key", "coarse", "vector"],
            )


def _scouted(batches: Iterator[pa.RecordBatch], scouts, k: int) -> Iterator[pa.RecordBatch]:
    """Queries with ``floor``, the k-th best score among the scouts: the k best of all candidates score no less."""
    ids, sizes, vectors = scouts.value
    for batch in batches:
        size, own = batch.column(1).to_numpy(), batch.column(0).to_numpy()
        floor = np.full(batch.num_rows, -np.inf)
        for n in np.unique(size).tolist():
            at, some = np.flatnonzero(size == n), np.flatnonzero(sizes == n)
            if len(some) <= k:
                continue
            b = np.frombuffer(b"".join(vectors[i] for i in some.tolist()), np.float64).reshape(len(some), n)
            tame = _tame(b)
            b, names = b[tame], ids[some][tame]
            for begin in range(0, len(at) if len(b) > k else 0, ASKED):
                part = at[begin : begin + ASKED]
                a = np.frombuffer(b"".join(batch.column(4).take(pa.array(part)).to_pylist()), np.float64).reshape(len(part), n)
                score = a @ b.T
                score[own[part][:, None] == names[None, :]] = -np.inf
                floor[part] = np.where(_tame(a), -np.partition(-score, k - 1, axis=1)[:, k - 1], -np.inf)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], names=[*batch.schema.names, "floor"])


def _wild(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Exact inner products, pair by pair, of numbers that doubles cannot multiply exactly."""
    return [max(-MOST, min(MOST, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for p, q in zip(a, b, strict=True)]


class _Block:
    """Candidates of one length with their profiles and the extremes of these."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values, self.tame = ids, values, _tame(values)
        self.profiles = [profile(values, x) for x in levels(values.shape[1])]
        half = self.profiles[0].shape[1] // 2
        means = self.profiles[0][:, :half]
        self.low, self.high, self.spread = means.min(axis=0), means.max(axis=0), self.profiles[0][:, half:].max(axis=0)

    def bound(self, coarse: np.ndarray) -> np.ndarray:
        """What no candidate of the block exceeds, for each query's coarse profile."""
        half = len(self.low)
        means = coarse[:, :half]
        return np.maximum(means * self.low, means * self.high).sum(axis=1) + coarse[:, half:] @ self.spread


def _survivors(profiles: list[np.ndarray], block: _Block, floor: np.ndarray) -> np.ndarray:
    """Which pairs of queries and candidates no bound rules out."""
    alive = None
    for a, b in zip(profiles, block.profiles, strict=True):
        if alive is None or alive.mean() > DENSE:
            bound = a @ b.T
            near = bound + _slack(np.abs(bound).max(initial=0)) >= floor[:, None]
            alive = near if alive is None else alive & near
        else:
            q, c = np.nonzero(alive)
            for at in range(0, len(q), 100_000):
                qs, cs = q[at : at + 100_000], c[at : at + 100_000]
                bound = np.einsum("ij,ij->i", a[qs], b[cs])
                alive[qs, cs] = bound + _slack(np.abs(bound).max(initial=0)) >= floor[qs]
    return alive


def _scored(values: np.ndarray, tame: np.ndarray, block: _Block, alive: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the surviving pairs that reach their floor."""
    both = tame[:, None] & block.tame[None, :]
    plain = alive & both
    if plain.mean() > DENSE:
        score = values @ block.values.T
        q, c = np.nonzero(plain & (score >= floor[:, None]))
        score = score[q, c]
    else:
        q, c = np.nonzero(plain)
        score = np.concatenate([np.einsum("ij,ij->i", values[q[at : at + 100_000]], block.values[c[at : at + 100_000]]) for at in range(0, len(q), 100_000)] or [np.zeros(0)])
        near = score >= floor[q]
        q, c, score = q[near], c[near], score[near]
    score = score.astype(np.int64)
    if not both.all():  # bounds of such numbers say nothing sure: all pairs are computed
        p, r = np.nonzero(~both)
        q, c, score = np.concatenate([q, p]), np.concatenate([c, r]), np.concatenate([score, np.array(_wild(values[p], block.values[r]), np.int64)])
    return q, c, score


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query, in order."""
    order = np.lexsort((ids, -score, q))
    place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
    return order[place < k]


def _asked(ids: np.ndarray, values: np.ndarray, floor: np.ndarray, blocks: list[_Block], k: int) -> pa.RecordBatch:
    """The k best candidates of the blocks for each of some queries, as far as they reach its floor."""
    profiles, tame, floor = [profile(values, x) for x in levels(values.shape[1])], _tame(values), floor.copy()
    bounds = [x.bound(profiles[0]) for x in blocks]
    found = [np.zeros(0, np.int64)] * 3
    for i in sorted(range(len(blocks)), key=lambda i: -bounds[i].max(initial=-np.inf)):
        block = blocks[i]
        near = (bounds[i] + _slack(bounds[i]) >= floor) | ~tame | (not block.tame.all())
        rows = np.flatnonzero(near)
        if not len(rows):
            continue
        q, c, score = _scored(values[rows], tame[rows], block, _survivors([p[rows] for p in profiles], block, floor[rows]), floor[rows])
        q, c = rows[q], block.ids[c]
        other = ids[q] != c
        found = [np.concatenate(x) for x in zip(found, (q[other], c[other], score[other]), strict=True)]
        found = [x[best] for best in [_best(*found, k)] for x in found]
        ends = np.searchsorted(found[0], np.arange(len(ids)), side="right")
        full = np.flatnonzero((np.diff(ends, prepend=0) == k) & tame)
        floor[full] = np.maximum(floor[full], found[2][ends[full] - 1].astype(float))
    return pa.RecordBatch.from_arrays([pa.array(ids[found[0]]), pa.array(found[1]), pa.array(found[2])], names=["query_id", "vec_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (size, part, kind, vec_id, floor, vector) in order: a group's candidates (kind 0), then those who ask it."""
    held, blocks, open_ = [], [], None

    def matrix(rows: pa.RecordBatch, size: int) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(5).to_pylist()), np.float64).reshape(rows.num_rows, size)

    for batch in batches:
        size, part, kind = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
        edges = np.flatnonzero((np.diff(size) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            if begin == end:
                continue
            rows, n = batch.slice(begin, end - begin), int(size[begin])
            if open_ != (n, part[begin]):
                held, blocks, open_ = [], [], (n, part[begin])
            if kind[begin] == 0:
                held.append((rows.column(3).to_numpy(), matrix(rows, n)))
                continue
            if held:
                ids, values = (np.concatenate(x) for x in zip(*held, strict=True))
                blocks, held = [_Block(ids[at : at + BLOCK], values[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)], []
            for at in range(0, rows.num_rows if blocks else 0, ASKED):
                some = rows.slice(at, ASKED)
                yield _asked(some.column(3).to_numpy(), matrix(some, n), some.column(4).to_numpy(), blocks, k)


def _group_bound(width: int) -> Column:
    """What no candidate of a group exceeds, by the group's extremes and the query's coarse profile."""
    at = lambda c, i: F.get(F.col(c), F.lit(i))
    means = [F.greatest(at("coarse", i) * at("low", i), at("coarse", i) * at("high", i)) for i in range(width)]
    # Short vectors have fewer segments; those that are not there add nothing.
    parts = [F.coalesce(x, F.lit(0.0)) for x in means] + [F.coalesce(at("coarse_spread", i) * at("spread", i), F.lit(0.0)) for i in range(width)]
    return reduce(lambda x, y: x + y, parts)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of ``vectors`` with the highest integer inner product.

    Components count as floor(scale * x). A query's own id is left out; ties go to the smaller id;
    all candidates are returned where there are fewer than k. Vectors that are null, empty or hold
    null or non-finite components, and those with null ids, take no part; vectors of different
    lengths do not meet. Repeated rows are candidates each; of queries with one id, one is asked.
    Scores beyond 64 bits count as the largest number. Other columns are ignored; an empty table
    gives no rows.

    Every candidate goes to the one task that holds its group; a query goes to the groups that its
    bound does not rule out. A task holds one group and some queries at a time. Only the scouts, of a
    fixed number, are sent to all tasks.
    """
    spark = vectors.sparkSession
    common.importable(spark)
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")).where("vec_id is not null").mapInArrow(lambda it: _ready(it, scale), _READY)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(parts, -(-vectors.count() // GROUP))
    # Rows with equal keys are told apart by a hash, so copies of one vector fill no group.
    candidates = pick(vectors).repartitionByRange(groups, "size", "key", F.xxhash64("vec_id", "vector")).withColumn("part", F.spark_partition_id())
    candidates = common.written(candidates, "candidates")
    width = LEVELS[0]
    half = F.floor(F.size("coarse") / 2).cast("int")
    split = [F.slice("coarse", F.lit(1), half).alias("means"), F.slice("coarse", half + 1, half).alias("spreads")]
    extreme = lambda f, c: F.array(*[f(F.get(F.col(c), F.lit(i))) for i in range(width)])
    extremes = candidates.select("size", "part", *split).groupBy("size", "part").agg(extreme(F.min, "means").alias("low"), extreme(F.max, "means").alias("high"), extreme(F.max, "spreads").alias("spread"))
    extremes = common.written(extremes, "groups")
    drawn = candidates.select("vec_id", "size", "vector").orderBy(F.xxhash64("vec_id", "vector")).limit(SCOUTS).toArrow()
    scouts = spark.sparkContext.broadcast((drawn.column(0).to_numpy(), drawn.column(1).to_numpy(), drawn.column(2).to_pylist()))
    asked = pick(queries.dropDuplicates([id_col])).mapInArrow(lambda it: _scouted(it, scouts, k), _READY + ", floor double")
    asked = common.written(asked, "asked")
    met = asked.withColumn("coarse_spread", F.slice("coarse", half + 1, half)).withColumn("coarse", F.slice("coarse", F.lit(1), half)).join(common.small_or_not(extremes), "size")
    bound = _group_bound(width)
    met = met.where(bound + (F.abs(bound) + 1) * 1e-9 >= F.col("floor"))
    rows = candidates.select("size", "part", F.lit(0).alias("kind"), "vec_id", F.lit(0.0).alias("floor"), "vector", "key")
    rows = rows.unionByName(met.select("size", "part", F.lit(1).alias("kind"), "vec_id", "floor", "vector", F.lit(0).cast("long").alias("key")))
    rows = rows.repartition(groups, "size", "part").sortWithinPartitions("size", "part", "kind", "key").drop("key")
    found = rows.mapInArrow(lambda it: _search(it, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
