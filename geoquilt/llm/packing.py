"""Packing pieces of documents into sequences: vector best fit over three capacities.

A sequence has room for tokens, for pieces and for attention cost (the sum of squared lengths).
Pieces are dealt to shards at random and packed there longest first; among the open sequences with
room in every respect, a piece goes where the weighted norm of what is left is least. What the
shards leave in poorly filled sequences is packed once more in fewer shards.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Room:
    tokens: int = 2048
    pieces: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)  # of what is left of each, as a share of the capacity
    shard: int = 6000  # pieces that a task packs at a time
    filled: float = 0.98  # of the tokens, at which a sequence needs no second packing


def best_fit(lengths: np.ndarray, room: Room) -> np.ndarray:
    """A sequence number for each piece."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    left = np.empty((3, len(lengths) + 1))
    name = np.empty(len(lengths) + 1, np.int64)
    opened = used = 0  # sequences so far, and those that may still take something
    full = np.array([room.tokens, room.pieces, room.cost], float)
    weights = np.array(room.weights) / full
    for i in order.tolist():
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        best = -1
        if used:
            after = left[:, :used] - need[:, None]
            fits = np.flatnonzero((after >= 0).all(axis=0))
            if len(fits):
                best = fits[np.argmin(np.square(after[:, fits] * weights[:, None]).sum(axis=0))]
        if best < 0:
            best, name[used], left[:, used] = used, opened, full
            opened, used = opened + 1, used + 1
        left[:, best] -= need
        bins[i] = name[best]
        if left[:, best].min() < 1:
            used -= 1
            left[:, best], name[best] = left[:, used], name[used]
    return bins


_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, filled double"


def _pack(rows: pd.DataFrame, room: Room) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
    rows["bin"] = best_fit(rows["length"].to_numpy(), room)
    by = rows.groupby("bin")["length"]
    rows["offset"] = by.cumsum() - rows["length"]
    rows["filled"] = by.transform("sum") / room.tokens
    return rows[["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "filled"]]


def _packed(pieces: DataFrame, room: Room, name: str) -> DataFrame:
    shards = max(1, -(-pieces.count() // room.shard))
    # The pieces are a written table, so row numbers are the same whenever they are read; they deal equal rows to all shards.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))

    def shard(key, rows):
        return _pack(rows, room).assign(shard=key[0])

    packed = dealt.groupBy("shard").applyInPandas(shard, _PACKED + ", shard long")
    return common.written(packed, name)


def pack(pieces: DataFrame, room: Room | None = None) -> DataFrame:
    """pieces ``(doc_id, piece, start, length, ids_crc32)`` with sequence_id long and offset long.

    Offsets run without gaps from 0 in each sequence; no sequence goes beyond any capacity of
    ``room``. Every row is one piece, repeated ones and those of null ids too; a piece longer than
    a sequence is an error of the caller. An empty table gives no rows.
    """
    room = room or Room()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = common.written(pieces.select(*columns), "pieces")
    first = _packed(pieces, room, "packed")
    done = first.where(F.col("filled") >= room.filled)
    second = _packed(first.where(F.col("filled") < room.filled).select(*columns), room, "packed_again")
    number = lambda df, k: df.select(*columns, ((F.col("shard") * 2 + k) * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"), "offset")
    return number(done, 0).unionByName(number(second, 1))
