"""Near-duplicate vectors by randomly rotated binary codes.

Each vector is normalised, rotated at random and reduced to the signs of its coordinates, stored
with a correction factor, its inner product with its own code. Vectors of a label that agree on a
band of code bits meet. There the distance of the codes first tells which vectors have a possible
partner at all; only those are sent on in full. For these, the inner product of one code with the
other vector, divided by the correction factor, estimates the cosine without bias, and pairs whose
upper confidence bound reaches the threshold are recomputed exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components, join_up
from .vectors import matrices, rotation


@dataclass(frozen=True)
class Codes:
    cosine: float = 0.98
    miss: float = 1e-5  # chance that a pair at the threshold meets in no band
    sure: float = 5.0  # standard deviations of the bounds
    cell: int = 1024  # larger buckets are cut into blocks, which meet pair by pair
    least_bits: int = 8
    most_bits: int = 30

    def bands(self, vectors: int) -> tuple[int, int]:
        """Bits of a band, so that few of so many vectors meet by chance, and the number of bands."""
        bits = min(self.most_bits, max(self.least_bits, math.ceil(math.log2(max(2, vectors)))))
        agree = (1 - math.acos(self.cosine) / math.pi) ** bits
        return bits, math.ceil(math.log(self.miss) / math.log(1 - agree))


def _signs(unit: np.ndarray, bits: int) -> np.ndarray:
    """At least so many sign bits of each vector, by as many rotations as that takes."""
    size = unit.shape[1]
    return np.concatenate([unit @ rotation(size, k).T >= 0 for k in range(-(-bits // size))], axis=1)[:, : max(bits, size)]


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[bytes | None] = [None] * batch.num_rows
        for rows, matrix in matrices(batch.column(2)):
            for i, x in zip(rows.tolist(), matrix + 0.0, strict=True):  # -0.0 becomes 0.0
                if x.any():
                    keys[i] = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), batch.column(2)], names=["vec_id", "label", "key", "embedding"])


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _banded(batches: Iterator[pa.RecordBatch], bits: int, bands: int, full: bool) -> Iterator[pa.RecordBatch]:
    """A row for each vector and band: (bucket, node, copies, code[, bands, vector, factor])."""
    weights = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for rows, matrix in matrices(batch.column(3)):
            unit = _unit(matrix)
            signs = _signs(unit, bits * bands)
            size = unit.shape[1]
            keys = signs[:, : bits * bands].reshape(len(rows), bands, bits) @ weights
            code = pa.array([x.tobytes() for x in np.packbits(signs, axis=1)], pa.binary())
            node, copies = batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows))
            more = []
            if full:
                factor = np.abs(unit @ rotation(size, 0).T).sum(axis=1) / math.sqrt(size)
                more = [pa.array([x.tobytes() for x in keys.astype(np.int32)], pa.binary()), pa.array([x.tobytes() for x in unit], pa.binary()), pa.array(factor)]
            for t in range(bands):
                # The bucket: label, length and band by their values, so that no two share one.
                bucket = [pa.array(label[rows].astype(np.int64)), pa.array(np.full(len(rows), size * bands + t)), pa.array(keys[:, t])]
                yield pa.RecordBatch.from_arrays([*bucket, node, copies, code, *more], names=["label", "band", "bits", "node", "copies", "code", *(["keys", "unit", "factor"] if full else [])])


_NARROW = "label long, band long, bits long, node long, copies long, code binary"
_WIDE = _NARROW + ", keys binary, unit binary, factor double"


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole cells of sorted rows, and the pairs (i, j) of rows that meet in them."""
    kept: list[pa.RecordBatch] = []

    def pairs(table: pa.RecordBatch):
        columns = [table.column(k).to_numpy() for k in range(5)]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        cell, block = np.cumsum(new), table.column(5).to_numpy()
        within = columns[3] == columns[4]  # both sides of the cell are one block
        step, left, found, held = 1, np.arange(table.num_rows - 1), [], 0
        while len(left):
            left = left[left + step < len(cell)]
            left = left[cell[left] == cell[left + step]]
            take = left[within[left] | (block[left] != block[left + step])]
            found.append((take, take + step))
            held += len(take)
            if held > 200_000:
                yield table, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
                found, held = [], 0
            step += 1
        if held:
            yield table, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])

    def whole(parts):
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()
        return table[0] if table else parts[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        if sum(x.num_rows for x in kept) < 4096:
            continue
        table = whole(kept)
        columns = [table.column(k).to_numpy() for k in range(5)]
        last = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last cell may go on
        if cut:
            yield from pairs(table.slice(0, cut))
        kept = [table.slice(cut)]
    if kept:
        yield from pairs(whole(kept))


def _possible(batches: Iterator[pa.RecordBatch], codes: Codes) -> Iterator[pa.RecordBatch]:
    """Vectors with a partner that the distance of the codes doesn't rule out."""
    for table, i, j in _meeting(batches):
        code = table.column(9)
        bits = len(code[0].as_py()) * 8
        chance = math.acos(codes.cosine) / math.pi
        most = bits * chance + codes.sure * math.sqrt(bits * chance * (1 - chance))
        sizes = np.array([len(x) for x in code.to_pylist()])
        for size in np.unique(sizes):
            # A cell holds vectors of one length, so its codes are of one length too.
            of = sizes[i] == size
            rows = np.frombuffer(b"".join(x if len(x) == size else bytes(size) for x in code.to_pylist()), np.uint8).reshape(-1, size)
            near = np.bitwise_count(rows[i[of]] ^ rows[j[of]]).sum(axis=1) <= most * size * 8 / bits
            node = table.column(7).to_numpy()
            found = np.unique(np.concatenate([node[i[of][near]], node[j[of][near]]]))
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["node"])


def _linked(batches: Iterator[pa.RecordBatch], codes: Codes) -> Iterator[pa.RecordBatch]:
    """(node, links, hub): links that each vector has here, and the smallest vector that these join it with."""
    for table, i, j in _meeting(batches):
        band = table.column(1).to_numpy()
        units, factor, node, copies = table.column(11), table.column(12).to_numpy(), table.column(7).to_numpy(), table.column(8).to_numpy()
        lengths = np.array([len(x) for x in units.to_pylist()]) // 8
        for size in np.unique(lengths).tolist():
            of = lengths[i] == size
            a, b = i[of], j[of]
            if not len(a):
                continue
            used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            a, b = at[: len(a)], at[len(a) :]
            unit = np.frombuffer(b"".join(units.take(pa.array(used)).to_pylist()), np.float64).reshape(-1, size)
            keys = np.frombuffer(b"".join(table.column(10).take(pa.array(used)).to_pylist()), np.int32).reshape(len(used), -1)
            turned = unit @ rotation(size, 0).T
            signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(size)
            f = factor[used]
            estimate = np.einsum("ij,ij->i", signs[a], turned[b]) / f[a]
            bound = np.sqrt((1 - f[a] ** 2) / f[a] ** 2 / max(1, size - 1)) * codes.sure
            maybe = estimate + bound >= codes.cosine
            a, b = a[maybe], b[maybe]
            # A pair counts in the first band in which it meets.
            t = (band[used[a]] % keys.shape[1])[:, None]
            earlier = (keys[a] == keys[b]) & (np.arange(keys.shape[1]) < t)
            first = ~earlier.any(axis=1) & (node[used[a]] != node[used[b]])
            a, b = a[first], b[first]
            exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= codes.cosine
            a, b = used[a[exact]], used[b[exact]]
            if len(a):
                ends, place = np.unique(np.concatenate([node[a], node[b]]), return_inverse=True)
                links = np.bincount(place, np.concatenate([copies[b], copies[a]])).astype(np.int64)
                hubs = join_up(np.stack([node[a], node[b]], axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(ends), pa.array(links), pa.array(hubs[:, 1])], names=["node", "links", "hub"])


def _cells(banded: DataFrame, counts: DataFrame, codes: Codes) -> DataFrame:
    """banded with the cell (first, second) in which each row meets others: buckets, or pairs of blocks of large ones."""
    large = counts.where(F.col("n") > codes.cell).select("label", "band", "bits", F.ceil(F.col("n") / codes.cell).cast("int").alias("blocks"))
    joined = banded.join(common.small_or_not(large), ["label", "band", "bits"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    joined = joined.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = [c for c in banded.columns if c not in ("label", "band", "bits", "node", "copies", "code")]
    cell = joined.select("label", "band", "bits", F.least("block", "other").cast("long").alias("first"), F.greatest("block", "other").cast("long").alias("second"), F.col("block").cast("long").alias("block"), F.lit(0).alias("unused"), "node", "copies", "code", *rest)
    by = ["label", "band", "bits", "first", "second"]
    parts = int(banded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cell.repartition(parts, *by).sortWithinPartitions(*by)


def near_vectors(vectors: DataFrame, codes: Codes | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors with the vectors of their label that are near.

    Two vectors link if their labels are equal and their cosine, in double precision, is at least
    ``codes.cosine``. Vectors that are null, empty, zero or hold a null or non-finite component, and
    those without a label or an id, link with nothing, nor do vectors of different lengths. n_links
    counts other rows linked directly, repeated rows among them; component_id is the smallest id
    of all rows that links reach. Equal vectors of a label are one class throughout. Rows that share
    an id are told apart by label and vector: each is linked by its own. Other columns are ignored.
    An empty table gives no rows.
    """
    codes = codes or Codes()
    common.importable(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    with_keys = rows.mapInArrow(_classes, "vec_id long, label long, key binary, embedding array<double>")
    keyed = common.written(with_keys.drop("embedding"), "vector_keys")
    usable = keyed.where("key is not null and label is not null and vec_id is not null")
    classes = usable.groupBy("label", "key").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    # Classes are numbered, as an id may stand for several vectors; written, so that numbers stay.
    classes = common.written(classes.withColumn("node", F.monotonically_increasing_id()), "vector_classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, bands = codes.bands(most)
    nodes = classes.select("label", "key", "least_id", "node", "copies").join(with_keys.withColumnRenamed("vec_id", "least_id"), ["label", "key", "least_id"]).dropDuplicates(["node"])
    nodes = common.written(nodes.select("node", "label", "copies", "embedding"), "vectors")
    narrow = common.written(nodes.mapInArrow(lambda it: _banded(it, bits, bands, False), _NARROW), "vector_bands")
    counts = common.written(narrow.groupBy("label", "band", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "vector_buckets")
    possible = _cells(narrow, counts, codes).mapInArrow(lambda it: _possible(it, codes), "node long")
    possible = common.written(possible.distinct(), "possible")
    wide = nodes.join(common.small_or_not(possible), "node", "left_semi").select("node", "label", "copies", "embedding")
    wide = wide.mapInArrow(lambda it: _banded(it, bits, bands, True), _WIDE)
    linked = _cells(wide, counts, codes).mapInArrow(lambda it: _linked(it, codes), "node long, links long, hub long")
    linked = common.written(linked, "vector_links")
    degree = linked.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(linked.select(F.col("node").alias("u"), F.col("hub").alias("v")), "vector_components")
    linked = labels.join(classes.select("node", "least_id"), "node")
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = linked.join(least, "component").select("node", "component_id")
    found = classes.join(degree, "node", "left").join(linked, "node", "left")
    found = found.select("label", "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least_id").alias("component"))
    out = keyed.join(found, ["label", "key"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
