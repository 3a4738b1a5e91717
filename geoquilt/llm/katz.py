"""Katz back-off language model over words, of any order, learned and evaluated in partitioned tables.

Texts are cut into slices. Order by order, each slice asks the table of n-grams for those it holds,
once each, and sends along how often it holds them; the table, partitioned by the words before the
last, adds up the counts and answers. So a count table is never joined with single tokens, and no
task holds more than a slice or a partition. From the answers a slice evaluates its tokens: a seen
n-gram by its discounted count, another by the back-off weight of what stands before, times the
probability of one order less.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, wordhash

BEGIN, END = np.uint64(1), np.uint64(2)
#: Tokens of a slice, and for each partition of a count table.
SLICE_TOKENS, PART_TOKENS = 3 << 18, 1 << 21
#: Counts above this are kept whole.
RARE = 5

_SLICE = "slice long, words binary, rank binary, codes binary, row array<long>, doc array<long>, train array<boolean>, size array<long>"
_ASK = "part long, slice long, first binary, runs binary, last binary, n binary, uses binary, lower binary"
_SCORED = "row long, doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double"
_ANSWER = "slice long, part long, level int, ids binary, counts binary, totals binary, seen binary, rest binary, key long, stats array<double>"


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(data, asbytes=True) if data else b""


def _expanded(data) -> np.ndarray:
    data = memoryview(data)
    if not len(data):
        return np.zeros(0, np.uint8)
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little")), np.uint8)


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest takes, low bytes first together, so that they compress."""
    x = np.ascontiguousarray(x, "<u8")
    width = 1 if not len(x) else max(1, (int(x.max()).bit_length() + 7) // 8)
    return _squeezed(bytes([width]) + np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def _unpack(data) -> np.ndarray:
    data = _expanded(data)
    width = int(data[0])
    planes = data[1:].reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def _pack_rising(x: np.ndarray) -> bytes:
    """Rising unsigned numbers by their steps."""
    return _pack(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def _unpack_rising(data) -> np.ndarray:
    return np.cumsum(_unpack(data).view(np.uint64), dtype=np.uint64)


def _bytes(column: pa.ChunkedArray | pa.Array, i: int):
    return column[i].as_buffer()


def _sliced(batches: Iterator[pa.RecordBatch], order: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of at least ``most`` tokens of the texts (doc, train, text); a longer text is cut, and its pieces know the words before them."""
    part, seq, row = TaskContext.get().partitionId(), 0, 0
    held: list[np.ndarray] = []
    about: list[tuple] = []
    size = 0

    def flush():
        tokens = np.concatenate(held)
        words, codes, n = np.unique(tokens, return_inverse=True, return_counts=True)
        place = np.argsort(-n, kind="stable")  # the most frequent words get the smallest codes
        rank = np.empty(len(words), np.int64)
        rank[place] = np.arange(len(words))
        columns = [pa.array([x], t) for x, t in zip(zip(*about, strict=True), (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())), strict=True)]
        packed = [pa.array([x], pa.binary()) for x in (_pack_rising(words), _pack(rank), _pack(rank[codes]))]
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | seq]), *packed, *columns], names=["slice", "words", "rank", "codes", "row", "doc", "train", "size"])

    for batch in batches:
        docs, trains = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, _, data, offsets in wordhash.slices(batch.column(2)):
            hashes, at = wordhash.word_hashes(data, offsets)
            hashes = np.where(hashes <= END, hashes + np.uint64(8), hashes)
            for i in range(len(offsets) - 1):
                tokens = np.concatenate([np.full(order - 1, BEGIN), hashes[at[i] : at[i + 1]], [END]])
                for begin in range(0, len(tokens) - order + 1, most):
                    piece = tokens[begin : begin + most + order - 1]
                    held.append(piece)
                    about.append((part << 40 | row, docs[first + i], trains[first + i], len(piece) - order + 1))
                    size += len(piece)
                    if size >= most:
                        yield flush()
                        held, about, size, seq = [], [], 0, seq + 1
                row += 1
    if held:
        yield flush()


@dataclass
class _Level:
    """What is known of one order before its answers are read: how to place keys, and what scoring takes."""

    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # histories whose followers are spread over all partitions
    discounts: np.ndarray = field(default_factory=lambda: np.ones(RARE + 1))
    hot_stats: dict = field(default_factory=dict)
    total: float = 0
    kinds: float = 0
    free: float = 0  # of the first order: what discounts leave, and the probability of an unknown word
    unknown: float = 1

    def word_share(self, c: np.ndarray) -> np.ndarray:
        """The probability of words of the first order by their counts."""
        taken = c * np.where(c > RARE, 1.0, self.discounts[np.minimum(c, RARE)])
        return np.where(c > 0, _seen_share(self.total, self.free) * taken / max(1.0, self.total), self.unknown)


def _mixed(x: np.ndarray) -> np.ndarray:
    return wordhash.mix(x.astype(np.uint64))


def _ranges(words: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of hashes that rise with them."""
    return ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _parts(first: np.ndarray, last: np.ndarray, parts: int, hot: np.ndarray) -> np.ndarray:
    spread = np.isin(first, hot)
    key = np.where(spread, _mixed(first) + _mixed(last), _mixed(first))
    return (_mixed(key) % np.uint64(parts)).astype(np.int64)


class _Slice:
    """A slice with the answers that it has so far, order by order."""

    def __init__(self, table: pa.Table, order: int):
        self.words = _unpack_rising(_bytes(table.column("words"), 0)) if "words" in table.column_names else None
        self.rank = _unpack(_bytes(table.column("rank"), 0))  # the code of each of the words, these by their hashes
        self.codes = _unpack(_bytes(table.column("codes"), 0))
        self.row, self.doc, self.train, self.size = (table.column(c)[0].as_py() for c in ("row", "doc", "train", "size"))
        self.order = order
        lengths = np.array(self.size, np.int64) + order - 1
        self.piece = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.arange(len(self.codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.token = self.at >= order - 1  # not a word that only stands before
        self.learned = self.token & np.array(self.train, bool)[self.piece]
        self.level = 0
        self.p = self.ids = self.word_ids = self.gram = None

    def grams(self, level: int) -> tuple:
        """The distinct n-grams of the slice: (history code or None, word code, count among what is learned, uses), and each place's."""
        if level == 1:
            kinds = len(self.rank)
            return None, np.arange(kinds), np.bincount(self.codes[self.learned], minlength=kinds), np.bincount(self.codes, minlength=kinds), self.codes
        here = self.at >= level - 1
        places = np.flatnonzero(here)
        key = self.gram[places - 1] << 32 | self.codes[places]
        distinct, code, uses = np.unique(key, return_inverse=True, return_counts=True)
        n = np.bincount(code[self.learned[places]], minlength=len(distinct))
        gram = np.full(len(self.codes), -1, np.int64)
        gram[places] = code
        return distinct >> 32, distinct & 0xFFFFFFFF, n, uses, gram

    def lower(self, gram: np.ndarray, kinds: int) -> np.ndarray:
        """The probability of one order less for each n-gram; it is the same wherever the n-gram stands."""
        out, tokens = np.ones(kinds), np.flatnonzero(self.token)
        out[gram[tokens]] = self.p[tokens]
        return out

    def ask(self, parts: int, about: list[_Level]) -> Iterator[dict]:
        """What the slice asks at the next level, a row for each partition."""
        level = self.level + 1
        first, last, n, uses, gram = self.grams(level)
        if level == 1:
            order, part = self.rank, _ranges(self.words, parts)
            ends = np.searchsorted(part, np.arange(parts + 1))
        else:
            keys, hists, lower = self.word_ids[last], self.ids[first], self.lower(gram, len(last))
            part = _parts(hists, keys, parts, about[level - 1].hot)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
        for k in range(parts):
            some = order[ends[k] : ends[k + 1]]
            if not len(some):
                continue
            row = {"part": k, "n": _pack(n[some]), "uses": _pack(uses[some]) if level < self.order else b""}
            if level == 1:
                row |= {"last": _pack_rising(self.words[ends[k] : ends[k + 1]])}
            else:
                h = hists[some]
                new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                # After one word the lower probability follows from the count of the next.
                lowers = _pack(self.counts[last[some]]) if level == 2 else _squeezed(lower[some].tobytes())
                row |= {"last": _pack(keys[some]), "first": _pack(h[new]), "runs": _pack(np.diff(np.r_[new, len(h)])), "lower": lowers}
            yield row

    def hear(self, answers: pa.Table, parts: int, about: list[_Level]) -> None:
        """Takes the answers of the next level: ids and counts, and what they make of each token."""
        level = self.level + 1
        known = about[level - 1]
        first, last, _, _, gram = self.grams(level)
        rows = sorted(range(answers.num_rows), key=lambda i: answers.column("part")[i].as_py())
        part = [answers.column("part")[i].as_py() for i in rows]
        whole = lambda name: np.concatenate([_unpack(_bytes(answers.column(name), i)) for i in rows])
        hists = None if level == 1 else self.ids[first]
        order = self.rank if level == 1 else np.argsort(_parts(hists, self.word_ids[last], parts, known.hot), kind="stable")
        c, ids = np.empty(len(last), np.int64), np.zeros(len(last), np.int64)
        c[order] = whole("counts")
        if level < self.order:
            if level == 1:
                ids[order] = np.concatenate([_unpack_rising(_bytes(answers.column("ids"), i)).astype(np.int64) * parts + p for i, p in zip(rows, part, strict=True)])
            else:
                ids[order] = np.concatenate([_unpack(_bytes(answers.column("ids"), i)) * parts + p for i, p in zip(rows, part, strict=True)])
        taken = c * np.where(c > RARE, 1.0, known.discounts[np.minimum(c, RARE)])
        if level == 1:
            p = known.word_share(c)
            self.word_ids, self.counts = ids, c
        else:
            h, of_part = hists[order], _parts(hists, self.word_ids[last], parts, known.hot)[order]
            run = np.cumsum(np.r_[True, (h[1:] != h[:-1]) | (of_part[1:] != of_part[:-1])]) - 1
            totals = whole("totals")
            full = np.zeros((len(totals), RARE + 2))
            full[:, 0], full[:, 1] = totals >> 1, totals & 1
            missing = np.flatnonzero(np.bincount(run, c[order] == 0))
            full[missing, 1 : RARE + 1] = np.concatenate([_unpack(_bytes(answers.column("seen"), i)).reshape(RARE, -1).T for i in rows])
            full[missing, RARE + 1] = np.concatenate([_expanded(_bytes(answers.column("rest"), i)).view(np.float64) for i in rows])
            of = np.empty((len(last), RARE + 2))
            of[order] = full[run]
            for key, stats in known.hot_stats.items():
                of[hists == key] = stats
            lower = self.lower(gram, len(last))
            total = of[:, 0]
            free = of[:, 1 : RARE + 1] @ ((1 - known.discounts[1:]) * np.arange(1, RARE + 1))
            seen = _seen_share(total, free)
            weight = (1 - seen * (total - free) / np.maximum(total, 1)) / np.maximum(1 - of[:, RARE + 1], 1e-12)
            p = np.where(total == 0, lower, np.where(c > 0, seen * taken / np.maximum(total, 1), weight * lower))
        self.ids, self.gram, self.level = ids, gram, level
        self.p = np.where(gram >= 0, p[gram], 1.0)


def _seen_share(total, free):
    """What seen words keep of their discounted shares: all, unless no count is discounted; then 1 of total + 1 goes to the others."""
    return np.where(free > 0, 1.0, total / (total + 1.0))


def _add_up(table: pa.Table, level: int, order: int, parts: int, hot_from: float, hot: np.ndarray, words: _Level | None) -> Iterator[dict]:
    """A partition of the count table: what all slices ask of it, added up, and its answers to each."""
    n_rows, part = table.num_rows, table.column("part")[0].as_py()
    col = lambda c: [_bytes(table.column(c), i) for i in range(n_rows)]
    last = [_unpack_rising(x) if level == 1 else _unpack(x) for x in col("last")]
    sizes, last = np.array([len(x) for x in last]), np.concatenate(last)
    n = np.concatenate([_unpack(x) for x in col("n")])
    if level == 1:
        place = np.argsort(last, kind="stable")
        new = np.r_[True, last[place][1:] != last[place][:-1]]
    else:
        firsts, runs = [_unpack(x) for x in col("first")], [_unpack(x) for x in col("runs")]
        first = np.concatenate([np.repeat(f, r) for f, r in zip(firsts, runs, strict=True)])
        place = np.lexsort((last, first))
        new = np.r_[True, (last[place][1:] != last[place][:-1]) | (first[place][1:] != first[place][:-1])]
    code = np.empty(len(last), np.int64)
    code[place] = np.cumsum(new) - 1
    c = np.bincount(code, n).astype(np.int64)  # whole numbers, exact up to 2^53
    one_of = place[new]
    ends = np.cumsum(sizes)
    slices = table.column("slice").to_pylist()
    if level > 1:
        lower = np.concatenate([words.word_share(_unpack(x)) if level == 2 else _expanded(x).view(np.float64) for x in col("lower")])[one_of]
        of_first, h = np.unique(first[one_of], return_inverse=True)
        held = np.stack([np.bincount(h, c, len(of_first)), *[np.bincount(h, c == r, len(of_first)) for r in range(1, RARE + 1)], np.bincount(h, np.where(c > 0, lower, 0), len(of_first))], axis=1)
    for i, s in enumerate(slices):
        some = code[ends[i] - sizes[i] : ends[i]]
        # An id is the place in the partition, times partitions, and the partition.
        row = {"slice": s, "part": part, "level": level, "counts": _pack(c[some])}
        if level < order:
            row |= {"ids": _pack_rising(some) if level == 1 else _pack(some)}
        if level > 1:
            # All of a history's sums are needed only where the slice holds it with a word that did not follow it.
            of = held[np.searchsorted(of_first, firsts[i])]
            missing = np.bincount(np.repeat(np.arange(len(runs[i])), runs[i]), c[some] == 0) > 0
            rare = of[:, 1 : RARE + 1].any(axis=1)
            row |= {"totals": _pack(of[:, 0].astype(np.int64) * 2 + rare), "seen": _pack(of[missing, 1 : RARE + 1].T.ravel()), "rest": _squeezed(of[missing, RARE + 1].tobytes())}
        yield row
    yield {"slice": -1, "part": part, "level": level, "stats": [float(np.count_nonzero(c == r)) for r in range(1, RARE + 2)] + [float(c.sum()), float(np.count_nonzero(c))]}
    if level < order:
        used = np.bincount(code, np.concatenate([_unpack(x) for x in col("uses")]))
        for i in np.flatnonzero(used > hot_from).tolist():
            yield {"slice": -2, "part": part, "level": level, "key": i * parts + part}
    if level > 1:
        for i in np.flatnonzero(np.isin(of_first, hot)).tolist():
            yield {"slice": -3, "part": part, "level": level, "key": int(of_first[i]), "stats": held[i].tolist()}


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(x.split(" ")[0], _TYPES[x.split(" ")[1]]) for x in text.split(", ")])


def _replayed(table: pa.Table, heard: pa.Table | None, order: int, parts: int, about: list[_Level]) -> _Slice:
    """A slice (one row) that has heard the answers of as many levels as ``about`` has."""
    s = _Slice(table, order)
    for level in range(1, len(about) + 1):
        s.hear(heard.filter(pc.equal(heard.column("level"), level)), parts, about)
    return s


def _asked(table: pa.Table, heard: pa.Table | None, order: int, parts: int, known: list[_Level], about: list[_Level]) -> pa.Table:
    if not table.num_rows:
        return _schema(_ASK).empty_table()
    s, name = _replayed(table, heard, order, parts, known), table.column("slice")[0].as_py()
    return pa.Table.from_pylist([r | {"slice": name} for r in s.ask(parts, about)], schema=_schema(_ASK))


def _added(table: pa.Table, level: int, order: int, parts: int, hot_from: float, hot: np.ndarray, words: _Level | None) -> pa.Table:
    return pa.Table.from_pylist(list(_add_up(table, level, order, parts, hot_from, hot, words)), schema=_schema(_ANSWER))


def _scored(table: pa.Table, heard: pa.Table, order: int, parts: int, about: list[_Level], total: float, kinds: float) -> pa.Table:
    if not table.num_rows:
        return _schema(_SCORED).empty_table()
    s = _replayed(table, heard, order, parts, about)
    token, pieces = s.token, len(s.size)
    c, piece = s.counts[s.codes[token]], s.piece[token]
    base = np.bincount(piece, np.log10((c + 1.0) / (total + (kinds + 1.0))), pieces)
    model = np.bincount(piece, np.log10(s.p[token]), pieces)
    known = np.bincount(piece[c > 0], minlength=pieces)
    return pa.table([s.row, s.doc, s.train, s.size, known.astype(np.int64), base, model], schema=_schema(_SCORED))


def _discounts(n: list[float]) -> np.ndarray:
    """Katz's factors of the counts 0 (unused) to RARE from how many n-grams have each count.

    Where they are not between 0 and 1, as in small or artificial corpora, a count r keeps r - 1/2.
    """
    out = np.ones(RARE + 1)
    common_part = (RARE + 1) * n[RARE] / n[0] if n[0] else 1.0
    for r in range(1, RARE + 1):
        d = math.nan
        if n[0] and n[r - 1] and common_part != 1:
            d = ((r + 1) * n[r] / n[r - 1] / r - common_part) / (1 - common_part)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def score(docs: DataFrame, learn: Column, order: int = 2, id_col: str = "doc_id", text_col: str = "text", slice_tokens: int = SLICE_TOKENS, hot_uses: int = 1000) -> DataFrame:
    """(row, doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) for every document.

    Words are runs without ASCII white space, A-Z lower-cased, and an end follows the last; n_tokens counts it, as the model
    does. A null or empty text is that end alone. Documents for which ``learn`` (a column of docs) is true are learned from,
    repeated rows as often as they occur; all are scored, by ``row``, which tells repeated rows apart. base_score is that of
    counts plus one without context; score is the model's, both log10. Unknown words are one further kind. Without any document
    to learn from every token is unknown. Other columns are ignored; an empty table gives no rows. Words stand by 64-bit hashes.

    Discounts are Good-Turing's for counts up to RARE. Probabilities after any history sum to 1: what discounts leave goes to
    the words not seen there; where none is discounted, one of count + 1. Histories used so often that their followers would
    fill a partition have these spread over all partitions, and their sums (at most four times as many as partitions) come
    back through the driver; what is used less than ``hot_uses`` times never counts as one.
    """
    spark = docs.sparkSession
    common.importable(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(learn.cast("boolean"), F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    slices = common.written(source.mapInArrow(lambda it: _sliced(it, order, slice_tokens), _SLICE), "slices")
    tokens = slices.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // PART_TOKENS))
    about: list[_Level] = []
    answers = None

    for level in range(1, order + 1):
        now = _Level()
        if level > 1:
            now.hot = np.array(sorted(r.key for r in answers.where(f"slice = -2 and level = {level - 1}").select("key").collect()), np.int64)
        asked = partial(_asked, order=order, parts=parts, known=list(about), about=[*about, now])
        if level == 1:
            asks = slices.mapInArrow(lambda it: (b for batch in it for i in range(batch.num_rows) for b in asked(pa.Table.from_batches([batch.slice(i, 1)]), None).to_batches()), _ASK)
        else:
            asks = slices.drop("words").groupBy("slice").cogroup(answers.where("slice >= 0").groupBy("slice")).applyInArrow(lambda table, heard: asked(table, heard), _ASK)  # noqa: B023
        hot_from = max(hot_uses, tokens / (4 * parts))

        added = partial(_added, level=level, order=order, parts=parts, hot_from=hot_from, hot=now.hot, words=about[0] if about else None)
        heard = common.written(asks.groupBy("part").applyInArrow(lambda table: added(table), _ANSWER), "answers")  # noqa: B023  run at once
        stats = heard.where("slice = -1").agg(*[F.sum(F.col("stats")[i]) for i in range(RARE + 3)]).first()
        stats = [x or 0.0 for x in stats]
        now.discounts, now.total, now.kinds = _discounts(stats[: RARE + 1]), stats[RARE + 1], stats[RARE + 2]
        now.free = sum((1 - now.discounts[r]) * r * stats[r - 1] for r in range(1, RARE + 1))
        now.unknown = 1 - float(_seen_share(now.total, now.free)) * (now.total - now.free) / max(1.0, now.total)
        if len(now.hot):
            sums = heard.where("slice = -3").groupBy("key").agg(*[F.sum(F.col("stats")[i]) for i in range(RARE + 2)]).collect()
            now.hot_stats = {r[0]: np.array(r[1:]) for r in sums}
        about.append(now)
        answers = heard if answers is None else answers.unionByName(heard)
    total, kinds = (about[0].total, about[0].kinds) if about else (0, 0)

    final = partial(_scored, order=order, parts=parts, about=about, total=total, kinds=kinds)
    found = slices.drop("words").groupBy("slice").cogroup(answers.where("slice >= 0").groupBy("slice")).applyInArrow(lambda table, heard: final(table, heard), _SCORED)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    out = found.groupBy("row", "doc_id", "learned").agg(*sums)
    return out.withColumn("train_tokens", F.lit(int(total)).cast("long"))
