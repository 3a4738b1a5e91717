"""Near-duplicate documents: an LSH forest over MinHash signatures, confirmed on whole shingle sets.

Every document has a signature of ``hashes`` minima. Each tree of the forest sorts all documents by
the signature in an order of its own; documents that stand within ``window`` places of each other
and agree on a prefix of at least ``least_depth`` values are candidates. So a sparse region is
searched from a shallow prefix on, and a dense one first as deep as its neighbours agree.
That joins most copies at little cost. What it leaves apart in a region, however many rows that
has, then meets pair by pair: sizes and parities, which no link can fail, refute nearly all, and
the others are compared on whole sets. So links depend on no window or number of neighbours, only
on a link sharing a region in one tree at least. The more documents there are, the deeper regions
begin and the more trees there are, which keeps that chance and the regions' sizes where they are.
Documents with equal sets are one class throughout, however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, wordhash
from .components import components


@dataclass(frozen=True)
class Forest:
    words: int = 5  # of a shingle
    percent: int = 80  # least similarity (intersection over union) of a link
    hashes: int = 64
    trees: int = 16
    first_trees: int = 2  # these alone join most copies, so that the others need not report them again
    least_depth: int = 3
    window: int = 64
    block: int = 4096  # rows of one sorted order that a task compares at a time
    slack: float = 0.2  # a pair is a candidate if its estimate is less by so much at most
    cell: int = 1024  # rows of a region that meet at a time; larger regions meet block by block
    miss: float = 1.1e-5  # chance that a link at the threshold shares no region in any tree
    crowd: int = 256  # documents that may share a region by accident, before regions begin a value deeper

    def sized(self, documents: int) -> Forest:
        """The forest for so many documents: as deep as that takes, and as many trees as that depth takes."""
        depth = max(self.least_depth, math.ceil(math.log(max(1, documents / self.crowd), 256)))
        trees = max(self.trees, math.ceil(math.log(self.miss) / math.log1p(-((self.percent / 100) ** depth))))
        return replace(self, least_depth=depth, trees=trees, hashes=max(self.hashes, depth * trees))


_SIGN = "doc_id long, n_shingles long, set_id binary, signature binary, bits binary"
#: Least bytes of a set's parities: each shingle turns over one of the bits, so two sets differ in as many shingles as bits at least.
FOLDED = 128


def _folded(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Parities of each set, of two bits a shingle at least and a power of two; a longer one folds to a shorter one."""
    size = np.maximum(FOLDED, 1 << np.ceil(np.log2(np.maximum(counts, 1) / 4)).astype(np.int64).clip(0))
    ends, row = np.cumsum(size), np.repeat(np.arange(len(counts)), counts)
    bits = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    place = (ends - size)[row] + ((values >> np.uint32(3)).astype(np.int64) & (size - 1)[row])
    np.bitwise_xor.at(bits, place, np.uint8(1) << (values & np.uint32(7)).astype(np.uint8))
    return [bits[e - n : e].tobytes() for e, n in zip(ends.tolist(), size.tolist(), strict=True)]


def _bits_apart(a: bytes, b: bytes) -> int:
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def _signatures(batches: Iterator[pa.RecordBatch], words: int, hashes: int) -> Iterator[pa.RecordBatch]:
    random = np.random.default_rng(7)
    times, plus = (random.integers(0, 1 << 32, hashes, dtype=np.uint32) | np.uint32(1) for _ in range(2))
    for batch in batches:
        ids = batch.column(0)
        sets, at = [], 0

        def flush(sets, at):
            counts = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(counts)
            values = (np.concatenate([sets[i] for i in full]) if len(full) else np.zeros(0, np.uint64)) >> np.uint64(32)
            values, starts = values.astype(np.uint32), np.concatenate([[0], np.cumsum(counts[full])])[:-1]
            least = np.zeros((len(sets), hashes), np.uint8)
            if len(full):
                for k in range(hashes):
                    spread = np.minimum.reduceat(values * times[k] + plus[k], starts)
                    least[full, k] = (spread * np.uint32(0x9E3779B1)) >> np.uint32(24)  # a byte of each minimum is kept
            bits = _folded(values, counts)
            return pa.RecordBatch.from_arrays(
                [ids.slice(at, len(sets)), pa.array(counts), pa.array([wordhash.digest(s) for s in sets], pa.binary()), pa.array([x.tobytes() if c else None for x, c in zip(least, counts, strict=True)], pa.binary()), pa.array(bits, pa.binary())],
                names=["doc_id", "n_shingles", "set_id", "signature", "bits"],
            )

        held = 0
        for s in wordhash.shingle_sets(batch.column(1), words):
            sets.append(s)
            held += len(s)
            if held > 500_000:
                yield flush(sets, at)
                sets, at, held = [], at + len(sets), 0
        if sets:
            yield flush(sets, at)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(set_id, hashes): the names and the whole sets of texts."""
    for batch in batches:
        held, rows, names = 0, [], []
        for s in wordhash.shingle_sets(batch.column(0), words):
            rows.append(s.tobytes())
            names.append(wordhash.digest(s))
            held += len(rows[-1])
            if held > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(rows, pa.binary())], names=["set_id", "hashes"])
                held, rows, names = 0, [], []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(rows, pa.binary())], names=["set_id", "hashes"])


def _named(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, set_id, n_shingles) of (doc_id, text)."""
    for batch in batches:
        sets = [(wordhash.digest(s), len(s)) for s in wordhash.shingle_sets(batch.column(1), words)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([d for d, _ in sets], pa.binary()), pa.array([n for _, n in sets], pa.int64())], names=["doc_id", "text", "set_id", "n_shingles"])


def _orders(f: Forest) -> list[np.ndarray]:
    """For each tree the order of signature places: its own places first, then the others."""
    random, own = np.random.default_rng(11), f.hashes // f.trees
    orders = []
    for t in range(f.trees):
        first = np.arange(t * own, (t + 1) * own)
        orders.append(np.concatenate([first, random.permutation(np.setdiff1d(np.arange(f.hashes), first))]))
    return orders


def _sorted_orders(batches: Iterator[pa.RecordBatch], f: Forest, trees: list[int]) -> Iterator[pa.RecordBatch]:
    orders = _orders(f)
    for batch in batches:
        if not batch.num_rows:
            continue
        signature = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, f.hashes)
        for t in trees:
            key = pa.array([x.tobytes() for x in signature[:, orders[t]]], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), t, np.int32)), key, batch.column(0), batch.column(1)], names=["tree", "key", "node", "component"])


def _neighbours(batches: Iterator[pa.RecordBatch], f: Forest, forests: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of a range of the sorted orders; the last rows of a block stand before the next one."""
    floor = f.percent / 100 - f.slack
    kept = None
    for batch in batches:
        for begin in range(0, batch.num_rows, f.block):
            part = batch.slice(begin, f.block)
            tree = part.column(0).to_numpy().astype(np.int64)
            key = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(-1, f.hashes)
            node, component = part.column(2).to_numpy(), part.column(3).to_numpy()
            if kept is not None:
                tree, key, node, component = (np.concatenate(x) for x in zip(kept, (tree, key, node, component), strict=True))
            old = 0 if kept is None else len(kept[0])
            kept = tuple(x[-f.window :] for x in (tree, key, node, component))
            prefix = tree.copy()
            for k in range(f.least_depth):
                prefix = prefix * 256 + key[:, k]
            found = []
            for step in range(1, min(f.window, len(node) - 1) + 1):
                left = np.flatnonzero((prefix[step:] == prefix[:-step]) & (component[step:] != component[:-step]))
                left = left[left + step >= old]
                if len(left):
                    alike = (key[left] == key[left + step]).mean(axis=1)
                    near = alike >= floor
                    found.append(np.stack([left[near], left[near] + step, (alike[near] * 1000).astype(np.int64)], axis=1))
            if found and len(found := np.concatenate(found)):
                found[:, 2] += _jitter(node[found[:, 0]], node[found[:, 1]], tree[found[:, 0]])
                yield from _spanning(found, node, component, forests)


def _jitter(a: np.ndarray, b: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Up to a tenth, another one in each tree: estimates are no surer than that, so trees should not all try the same pairs."""
    mixed = wordhash.mix(wordhash.mix(a.astype(np.uint64)) + wordhash.mix(b.astype(np.uint64)) + tree.astype(np.uint64))
    return (mixed % np.uint64(101)).astype(np.int64)


def _spanning(found: np.ndarray, node: np.ndarray, component: np.ndarray, forests: int) -> Iterator[pa.RecordBatch]:
    """Of the candidates those that could join components, most alike first: forests, one after the other.

    Each forest leaves out what the ones before it have taken, so that components stay joined though
    some of the candidates fail.
    """
    names, of = np.unique(component, return_inverse=True)
    found = found[np.argsort(-found[:, 2], kind="stable")]
    ends = of[found[:, :2]]
    taken = []
    for _ in range(forests):
        root = np.arange(len(names))

        def top(x, root):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        rest = np.ones(len(found), bool)
        for i, (a, b) in enumerate(ends.tolist()):
            a, b = top(a, root), top(b, root)
            if a != b:
                root[max(a, b)] = min(a, b)
                rest[i] = False
        taken.append(found[~rest])
        found, ends = found[rest], ends[rest]
        if not len(found):
            break
    pairs = np.concatenate(taken)
    a, b = node[pairs[:, 0]], node[pairs[:, 1]]
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["u", "v"])


def _possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v, size and bits of each) without those whose sizes or bits alone say that they are no link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        both, less = (f(batch.column(2).to_numpy(), batch.column(3).to_numpy()) for f in (np.add, np.minimum))
        apart = np.array([_bits_apart(a, b) for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)])
        # Of both sizes together, links have no more than (100 - percent) / (100 + percent) on one side only.
        keep = ((100 + percent) * apart <= (100 - percent) * both) & (100 * less >= percent * (both - less))
        yield batch.select([0, 1]).filter(pa.array(keep))


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _regions(batches: Iterator[pa.RecordBatch], f: Forest) -> Iterator[pa.RecordBatch]:
    """(region, node, component): where each node stands in each tree, down to the least depth."""
    orders = _orders(f)
    for batch in batches:
        if not batch.num_rows:
            continue
        signature = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, f.hashes)
        for t in range(f.trees):
            region = np.full(len(signature), t, np.int64)
            for k in orders[t][: f.least_depth]:
                region = region * 256 + signature[:, k]
            yield pa.RecordBatch.from_arrays([pa.array(region), batch.column(0), batch.column(1)], names=["region", "node", "component"])


def _cells(batches: Iterator[pa.RecordBatch], least: int = 4096) -> Iterator[pa.RecordBatch]:
    """Sorted rows in runs that end where a cell (the first three columns) ends."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        if sum(x.num_rows for x in kept) < least and sum(x.nbytes for x in kept) < 32_000_000:
            continue
        table = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
        columns = [table.column(k).to_numpy() for k in range(3)]
        last = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield table.slice(0, cut)
        kept = [table.slice(cut)]
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


class _Bits:
    """Parities of a run of rows, by their lengths, each also folded once; sizes of links differ so little that this is enough."""

    def __init__(self, bits: list[bytes]):
        self.length = np.array([len(x) for x in bits])
        self.place = np.zeros(len(bits), np.int64)
        self.whole, self.half = {}, {}
        for n in np.unique(self.length).tolist():
            rows = np.flatnonzero(self.length == n)
            self.place[rows] = np.arange(len(rows))
            self.whole[n] = np.frombuffer(b"".join(bits[i] for i in rows.tolist()), np.uint64).reshape(len(rows), -1)
            self.half[n] = self.whole[n][:, : n // 16] ^ self.whole[n][:, n // 16 :]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits in which rows differ, pair by pair; 0, which refutes nothing, where one is more than twice as long."""
        out = np.zeros(len(a), np.int64)
        la, lb = self.length[a], self.length[b]
        for n in self.whole:
            for left, right, x, y in ((self.whole, self.whole, n, n), (self.half, self.whole, n, n // 2), (self.whole, self.half, n // 2, n)):
                if x in left and y in right:
                    of = np.flatnonzero((la == x) & (lb == y))
                    step = max(1, 16_000_000 // n)
                    for at in range(0, len(of), step):
                        some = of[at : at + step]
                        out[some] = np.bitwise_count(left[x][self.place[a[some]]] ^ right[y][self.place[b[some]]]).sum(axis=1, dtype=np.int64)
        return out


def _meeting(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of all pairs of different components that share a cell those that sizes and parities do not refute.

    Columns: region, first, second, block, node, component, n_shingles, bits. In a cell of two blocks
    rows of one block have met elsewhere.
    """
    for table in _cells(batches):
        region, first, second, block, node, component, size = (table.column(k).to_numpy() for k in range(7))
        cell = np.cumsum(np.r_[True, (region[1:] != region[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        within, bits = first == second, _Bits(table.column(7).to_pylist())
        step, left, found, held = 1, np.arange(len(cell) - 1), [], 0
        while len(left):
            left = left[left + step < len(cell)]
            left = left[cell[left] == cell[left + step]]
            right = left + step
            both, less = size[left] + size[right], np.minimum(size[left], size[right])
            ok = (component[left] != component[right]) & (within[left] | (block[left] != block[right])) & (100 * less >= percent * (both - less))
            a, b = left[ok], right[ok]
            # Of both sizes together, links have no more than (100 - percent) / (100 + percent) on one side only.
            near = (100 + percent) * bits.apart(a, b) <= (100 - percent) * both[ok]
            a, b = node[a[near]], node[b[near]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            held += len(a)
            if held > 500_000:
                yield _distinct(found)
                found, held = [], 0
            step += 1
        if held:
            yield _distinct(found)


def _distinct(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def near_duplicates(docs: DataFrame, forest: Forest | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents with the class of near copies that they are in.

    Words are runs without ASCII white space, A-Z lower-cased; a text's set holds its distinct
    shingles of ``forest.words`` words. Texts of fewer words have one shingle; null texts and texts
    without words have none and link with nothing. component_id is the smallest id that links
    reach, kept says that it is the document's own. Rows whose id is null are returned, with their
    count and a null component, and link with nothing. Rows that share an id are told apart by their
    sets: each is linked by its own, and its component_id is the smallest id of all rows reached.
    Very long texts are hashed whole. Other columns are ignored. An empty table gives no rows.
    """
    return _classified(docs, forest or Forest(), id_col, text_col).drop("set_id", "group")


def _classified(docs: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``near_duplicates`` with the names of their sets, and the numbers of their groups."""
    f = forest.sized(docs.count())
    common.importable(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = common.written(source.mapInArrow(lambda it, w=f.words, n=f.hashes: common.trimmed(_signatures(it, w, n)), _SIGN), "signatures")
    classes = signed.where("doc_id is not null and n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least_id"), *[F.min(x).alias(x) for x in ("signature", "n_shingles", "bits")])
    # Classes are numbered, as ids may stand for several sets; written, so that numbers stay.
    classes = common.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    linked = _join_classes(source, classes, f).join(classes.select("node", "set_id", "least_id"), "node")
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = common.written(linked.join(least, "component").select("set_id", "component", "component_id"), "linked")
    of_class = classes.select("set_id", "node", "least_id").join(common.small_or_not(linked), "set_id", "left")
    of_class = of_class.select("set_id", F.coalesce("component_id", "least_id").alias("component_id"), F.coalesce("component", "node").alias("group"))
    out = signed.select("doc_id", "n_shingles", "set_id").join(of_class, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).cast("long")
    return out.select("doc_id", "n_shingles", "set_id", "group", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each(docs: DataFrame, forest: Forest | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which one document of each group of near copies stays, that with the smallest id.

    Rows that share an id are documents of their own if their texts differ, and one if they don't; where the smallest id of a
    group stands for several of its texts, the one whose set has the least name stays. Rows without an id all stay, and texts
    without words. All columns stay, whatever these are called. Only ids are joined, and for those that occur more than once texts.
    """
    f = forest or Forest()
    found = common.written(_classified(docs, f, id_col, text_col).where("doc_id is not null"), "groups")
    again = common.written(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    again = common.small_or_not(again)
    gone = common.small_or_not(common.written(found.where("not kept").select("doc_id").distinct(), "gone"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = rows.join(again, "doc_id", "left_anti").join(gone, "doc_id", "left_anti")
    several = common.written(rows.join(again, "doc_id", "left_semi").withColumn("text", F.col(f"row.`{text_col}`").cast("string")), "several")
    first = found.join(again, "doc_id", "left_semi").where("kept and n_shingles > 0").groupBy("doc_id", "group").agg(F.min("set_id").alias("set_id"))
    named = several.select("doc_id", "text").distinct().mapInArrow(lambda it, w=f.words: common.trimmed(_named(it, w)), "doc_id long, text string, set_id binary, n_shingles long")
    named = common.written(named, "named")
    stay = named.join(first, ["doc_id", "set_id"], "left_semi").groupBy("doc_id", "set_id").agg(F.min("text").alias("text")).select("doc_id", "text")
    stay = common.written(stay.union(named.where("n_shingles = 0").select("doc_id", "text")), "stay").withColumnsRenamed({"doc_id": "id2", "text": "text2"})
    one = several.dropDuplicates(["doc_id", "text"]).join(stay, (F.col("doc_id") == F.col("id2")) & F.col("text").eqNullSafe(F.col("text2")), "left_semi")
    return once.select("row").unionByName(one.select("row")).select(*[F.col(f"row.`{c}`") for c in docs.columns])


def _join_classes(source: DataFrame, classes: DataFrame, f: Forest) -> DataFrame:
    """(node, component) of the nodes that link with another."""
    spark = source.sparkSession
    nodes = classes.select("node", "signature")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    alone = nodes.select("node", F.col("node").alias("component"), "signature")
    first, rest = list(range(f.first_trees)), list(range(f.trees))
    links = None
    labels = None
    # The first trees join most copies and need few candidates; for what is left each tree gives more.
    for trees, forests in ((first, 2), (rest, 8)):
        now = alone
        if labels is not None:
            now = nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "signature")
        rows = now.mapInArrow(lambda it, f=f, trees=trees: common.trimmed(_sorted_orders(it, f, trees)), "tree int, key binary, node long, component long")
        rows = rows.repartitionByRange(parts, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
        pairs = common.written(rows.mapInArrow(lambda it, f=f, forests=forests: common.trimmed(_neighbours(it, f, forests)), "u long, v long").distinct(), "pairs")
        found = _confirmed(source, classes, _open(classes, pairs, f), f)
        links = found if links is None else links.union(found)
        links = common.written(links, "links")
        labels = common.written(components(links), "labels")
    # What is still apart, however crowded its regions: all pairs of a region that can link, each confirmed.
    now = common.written(nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "signature"), "now")
    found = common.written(_confirmed(source, classes, _apart(now, classes, f), f), "links")
    if found.isEmpty():
        return labels
    joined = found.union(labels.select(F.col("node").alias("u"), F.col("component").alias("v")))
    return common.written(components(joined), "labels")


def _apart(now: DataFrame, classes: DataFrame, f: Forest) -> DataFrame:
    """Pairs (u, v) of different components that share a region of some tree and that sizes and parities leave open.

    Regions are counted first: only the rows of those that hold more than one component travel on,
    with their parities; large regions meet block by block in cells of their own.
    """
    parts = int(now.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = common.written(now.mapInArrow(lambda it, f=f: common.trimmed(_regions(it, f)), "region long, node long, component long"), "regions")
    mixed = rows.groupBy("region").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("n")).where("least <> most")
    mixed = common.written(mixed.select("region", F.ceil(F.col("n") / f.cell).cast("long").alias("blocks")), "mixed")
    met = rows.join(common.small_or_not(mixed), "region")
    met = met.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = met.select("region", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "node", "component")
    cells = cells.join(classes.select("node", "n_shingles", "bits"), "node").select(*cells.columns, "n_shingles", "bits")
    by = ["region", "first", "second"]
    cells = cells.repartition(parts, *by).sortWithinPartitions(*by)
    return common.written(cells.mapInArrow(lambda it, p=f.percent: common.trimmed(_meeting(it, p)), "u long, v long").distinct(), "possible")


def _open(classes: DataFrame, pairs: DataFrame, f: Forest) -> DataFrame:
    """Those of the pairs (u, v) that sizes and parities do not refute."""
    of = lambda end: classes.select(F.col("node").alias(end), F.col("n_shingles").alias(f"size_{end}"), F.col("bits").alias(f"bits_{end}"))
    light = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "size_u", "size_v", "bits_u", "bits_v")
    return common.written(light.mapInArrow(lambda it, p=f.percent: common.trimmed(_possible(it, p)), "u long, v long").distinct(), "possible")


def _confirmed(source: DataFrame, classes: DataFrame, pairs: DataFrame, f: Forest) -> DataFrame:
    """Those of the pairs (u, v), a written table, that are links, by their whole sets."""
    needed = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    needed = common.written(needed.join(classes.select("node", "set_id", "least_id"), "node"), "needed")
    texts = source.join(common.small_or_not(needed.select(F.col("least_id").alias("doc_id"))), "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(lambda it, w=f.words: common.trimmed(_sets(it, w)), "set_id binary, hashes binary")
    sets = common.written(sets.join(common.small_or_not(needed.select("set_id", "node")), "set_id").dropDuplicates(["set_id"]).select("node", "hashes"), "sets")
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("set_u")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("set_v")), "v")
    return both.select("u", "v", "set_u", "set_v").mapInArrow(lambda it, p=f.percent: common.trimmed(_confirm(it, p)), "u long, v long")
