"""Token ids and token counts of whole texts, by public vocabularies.

A text is cut where no token can span: before ASCII white space that follows another character.
The stretches between such cuts repeat over and over, so each worker encodes a stretch once and
keeps the result; a bounded number is kept.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, prefixes, wordhash

#: Stretches that a worker keeps; beyond half of them a new generation begins, and those that do not come again are forgotten with the old one.
KEPT = 900_000
#: Longer stretches are encoded each time.
LONG = 80
#: White space goes with what follows it; other white space than ASCII's never ends a stretch.
WITH_SPACE = r"\s*\S+(?:[^\S \t\n\r\x0b\x0c]\s*\S*)*|\s+"
#: For tokenizers that drop white space.
WITHOUT_SPACE = r"[^ \t\n\r\x0b\x0c]+"
#: The same where ``words_of`` knows the tokenizer: a first run of Latin letters stands apart from punctuation behind it.
LETTERS_APART = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[!-&(-/:;=?@\[-`{}~ \t\n\r\x0b\x0c]|\Z)|" + WITHOUT_SPACE

#: With white space, the same; a line break before a Latin letter stands alone, as it does in the encoding.
LETTERS_APART_WITH_SPACE = r"\n(?=[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])| ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[!-&(-/:;=?@\[-`{}~ \t\n\r\x0b\x0c]|\Z)|" + WITH_SPACE


def load(path: str) -> Callable[[list[str]], list[list[int]]]:
    """A function from texts to token ids, without begin, end or added special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: pieces.encode(texts, num_threads=1)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


#: A run of Latin letters, with a space before it or not, and punctuation after it. No token holds a
#: part of both, as the tokenizers that ``words_of`` knows part letters from other characters. Left out
#: are characters that occur in contractions or special tokens.
WORD = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=?@\[-`{}~]*)")


def words_of(path: str) -> Callable[[list[str]], list[list[int]]] | None:
    """A quicker function for single words, which need no search for where words end.

    Only for byte-level BPE whose words are runs of letters, None for others.
    """
    if not path.endswith(".json"):
        return None
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    before, changed = said.get("pre_tokenizer") or {}, json.dumps(said.get("normalizer"))
    kinds = {x["type"]: x for x in before.get("pretokenizers", [before]) if x}
    by_letters = "+" in str(kinds.get("Split", {}).get("pattern", "")) and "\\p{L}" in str(kinds["Split"]["pattern"]["Regex"]) if "Split" in kinds else kinds.get("ByteLevel", {}).get("use_regex")
    if said["model"]["type"] != "BPE" or "ByteLevel" not in kinds or not by_letters or kinds["ByteLevel"].get("add_prefix_space"):
        return None
    model = Tokenizer.from_file(path).model
    if hasattr(model, "_resize_cache"):
        model._resize_cache(0)  # no word comes twice
    plain, lower = Tokenizer(model), "Lowercase" in changed
    # How byte-level models write each byte: printable ones as themselves, the others further up in order.
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: b for b in seen} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in seen)}
    assert {chr(x) for x in table.values()} == set(pre_tokenizers.ByteLevel.alphabet())

    def encode(words: list[str]) -> list[list[int]]:
        words = [x.lower() for x in words] if lower else words
        return [x.ids for x in plain.encode_batch_fast([x.encode().decode("latin-1").translate(table) for x in words], add_special_tokens=False)]

    return encode


#: Characters beyond Latin-1, whose lower case and normal form may hang on their neighbours.
_WIDE = re.compile(r"[^\x00-\xff]")


def _lowers(path: str) -> tuple[bool, list[str]]:
    """Whether a tokenizer does nothing to Latin-1 texts but lower their letters and join white space, and its special strings in lower case."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    steps = said.get("normalizer") or {}
    kinds = {(x["type"], str(x.get("pattern", "")), x.get("content", "")) for x in steps.get("normalizers", [steps]) if x}
    plain = {("Lowercase", "", ""), ("NFC", "", ""), ("Replace", str({"Regex": r"\s+"}), " ")}
    return ("Lowercase", "", "") in kinds and kinds <= plain, [x["content"].lower() for x in said.get("added_tokens", [])]


class Stretches:
    """``of(texts)`` gives for each text its stretches, and ``known[stretch]`` is what ``make`` made of its ids.

    What is made of two stretches in a row must be the sum of what is made of each.
    """

    def __init__(self, path: str, pattern: str, make: Callable[[list[int]], object], kept: int = KEPT):
        self.encode, self.make, self.kept = load(path), make, kept
        self.words = words_of(path)
        self.find = re.compile(LETTERS_APART if self.words and pattern == WITHOUT_SPACE else pattern).findall
        self.lower, self.special = _lowers(path) if self.words else (False, [])
        self.known: dict[str, object] = {}
        self.old: dict[str, object] = {}  # the generation before
        self.passing: list[str] = []

    def _same(self, text: str) -> str:
        """A text with the same tokens, in lower case if the tokenizer makes it so and nothing in it depends on more than its letters."""
        if not self.lower or not text.isascii() and _WIDE.search(text):
            return text
        low = text.lower()
        return text if any(x in low for x in self.special) else low

    def _learn(self, new: list[str], encode: Callable[[list[str]], list[list[int]]]) -> None:
        for begin in range(0, len(new), 4096):
            part = new[begin : begin + 4096]
            self.known.update(zip(part, map(self.make, encode(part)), strict=True))

    def of(self, texts: list[str]) -> list[list[str]]:
        for x in self.passing:
            self.known.pop(x, None)
        if len(self.known) > self.kept // 2:
            self.old, self.known = self.known, {}
        found = [self.find(self._same(x)) for x in texts]
        distinct = set(chain.from_iterable(found))
        new = distinct.difference(self.known)
        if self.old:
            back = new.intersection(self.old)
            self.known.update((x, self.old[x]) for x in back)
            new -= back
        self.passing = [x for x in new if len(x) > LONG]
        self._learn_all(list(new))
        return found

    def _learn_all(self, new: list[str]) -> None:
        single = [x for x in new if len(x) <= LONG and (m := WORD.fullmatch(x)) and not m[2]] if self.words else []
        if single:
            self._learn(single, self.words)
            new = list(set(new).difference(single))
        self._learn(new, self.encode)


class Tables(Stretches):
    """Stretches of which the counts of all prefixes are known, 32-bit numbers as bytes."""

    def __init__(self, path: str, pattern: str):
        self.counter, self.words = prefixes.PrefixCounter(path), words_of(path)
        self.find = re.compile(LETTERS_APART_WITH_SPACE if self.words and pattern == WITH_SPACE else pattern).findall
        self.known, self.old, self.passing, self.lower, self.kept = {}, {}, [], False, KEPT

    def _learn_all(self, new: list[str]) -> None:
        heads = [x for x in new if len(x) <= LONG and (m := WORD.fullmatch(x)) and not m[2]] if self.words else []
        if heads:
            counts = self.counter.single(heads)
            for i, (x, whole) in enumerate(zip(heads, self.words(heads), strict=True)):
                if len(whole) != int.from_bytes(counts[i][-4:], sys.byteorder):
                    counts[i] = self.counter.by_library(x).astype(np.uint32).tobytes()
            self.known.update(zip(heads, counts, strict=True))
            new = list(set(new).difference(heads))
        self.known.update(zip(new, self.counter.counts(new), strict=True))


@cache
def tables_of(path: str, pattern: str) -> Tables:
    """One for all tasks that a worker runs."""
    return Tables(path, pattern)


@cache
def stretches_of(path: str, pattern: str, make: Callable[[list[int]], object], kept: int = KEPT) -> Stretches:
    """One for all tasks that a worker runs."""
    return Stretches(path, pattern, make, kept)


def as_bytes(ids: list[int]) -> bytes:
    """Unsigned little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _texts(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of about a million bytes of text."""
    texts = batch.column(column)
    for first, last, _, _ in wordhash.slices(texts, most):
        yield first, [x or "" for x in texts.slice(first, last - first).to_pylist()]


_COUNTS = "doc_id long, n_bytes long, n_tokens long"
_PREFIXES = _COUNTS + ", prefix_tokens array<int>"


def _prefixes(batches: Iterator[pa.RecordBatch], path: str, listed: bool) -> Iterator[pa.RecordBatch]:
    """The counts of whole texts, and those of all their prefixes if they are to be listed."""
    tables = tables_of(path, WITH_SPACE)
    for batch in batches:
        for first, texts in _texts(batch, 1):
            found = tables.of(texts)
            flat = [tables.known[x] for x in chain.from_iterable(found)]
            sizes = np.fromiter(map(len, flat), np.int64, len(flat)) // 4
            counts = np.frombuffer(b"".join(flat), np.uint32)
            # The recurrence over stretches: the count at a prefix is the one at the cut before and that within the stretch.
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
            after = np.concatenate([[0], np.cumsum(counts[np.cumsum(sizes) - 1], dtype=np.int64)])
            total = after[cuts[1:]] - after[cuts[:-1]]
            n_bytes = pa.array([len(x.encode()) for x in texts], pa.int64())
            columns = {"doc_id": batch.column(0).slice(first, len(texts)), "n_bytes": n_bytes, "n_tokens": pa.array(total)}
            if listed:
                before = after[:-1] - np.repeat(after[cuts[:-1]], np.diff(cuts))
                ends = np.concatenate([[0], np.cumsum(sizes)])[cuts].astype(np.int32)
                every = (counts + np.repeat(before, sizes)).astype(np.int32)
                columns["prefix_tokens"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(every))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _counted(docs: DataFrame, path: str, id_col: str, text_col: str, listed: bool) -> DataFrame:
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it, path=path, listed=listed: _prefixes(it, path, listed), _PREFIXES if listed else _COUNTS)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens): ``prefix_counts`` without the counts of the prefixes, which stay in the worker that makes them."""
    return _counted(docs, path, id_col, text_col, listed=False)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, prefix_tokens): exact token counts of all prefixes of each text.

    prefix_tokens[i] is the number of tokens of the text's first i + 1 code points, by themselves; the
    last is that of the whole text. So questions on budgets and truncation are lookups: see
    ``tokens_within`` and ``truncated``. The vocabulary must be a plain byte-level BPE, anything else is
    an error. Null texts count as empty: 0 bytes, 0 tokens, an empty array. Each row is counted on its
    own, repeated ids and null ids too; other columns are ignored. An empty table gives no rows.
    """
    return _counted(docs, path, id_col, text_col, listed=True)


def truncated(counted: DataFrame, budget: int) -> DataFrame:
    """counted with chars_within long: code points of the longest prefix for which ``budget`` tokens suffice."""
    # A longer prefix may have fewer tokens, so all are looked at.
    fits = F.transform("prefix_tokens", lambda n, i: F.when(n <= budget, i + 1))
    return counted.withColumn("chars_within", F.coalesce(F.array_max(fits), F.lit(0)).cast("long"))


def tokens_within(chars: Column) -> Column:
    """The exact token count of a text's first ``chars`` code points, from the table; beyond its end that of the whole text."""
    at = F.least(chars, F.size("prefix_tokens"))
    return F.when(at > 0, F.get("prefix_tokens", at - 1)).otherwise(0).cast("long")


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end: int, most: int, kept: int) -> Iterator[pa.RecordBatch]:
    stretches, close = stretches_of(path, WITHOUT_SPACE, as_bytes, kept), as_bytes([end])
    for batch in batches:
        for first, texts in _texts(batch, 1):
            rows: list[list] = [[], [], [], [], []]
            for doc, found in zip(batch.column(0).slice(first, len(texts)).to_pylist(), stretches.of(texts), strict=True):
                ids = b"".join(map(stretches.known.__getitem__, found)) + close
                for piece, start in enumerate(range(0, len(ids) // 4, most)):
                    part = ids[4 * start : 4 * (start + most)]
                    for x, value in zip(rows, (doc, piece, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        x.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, end: int, most: int, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids, then ``end``, cut into pieces of ``most``.

    The tokenizer must drop white space. A null text is an empty one: a single piece that holds ``end``.
    ``kept`` is how many stretches a worker keeps, some 200 bytes each, for as long as it lives; it changes no result.
    """
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it, path=path, end=end, most=most, kept=kept: common.trimmed(_pieces(it, path, end, most, kept)), _PIECES)
