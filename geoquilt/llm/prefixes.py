"""Token counts of every prefix of a text, for byte-level BPE, by dynamic programming.

The encoding of a prefix ends in one token, and what stands before that token is encoded as it is by
itself. So the count at a place is one more than the count where its last token begins. Of the tokens
that could be the last just one is valid: that whose border with the token before it no earlier
merge crosses. Numbers of tokens are bytes first, then merges in their order.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

#: Characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_RUNS = re.compile(f"[{WHITE_SPACE}]+")
#: Pairs of tokens of which it is kept whether they can stand side by side.
KNOWN = 1 << 19
#: Contractions of three characters, which are one word only when they are whole.
_CONTRACTED = ("'ll", "'ve", "'re")


class PrefixCounter:
    """``counts(texts)``: for each text the token counts of its prefixes, 32-bit numbers as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        before = said.get("pre_tokenizer") or {}
        kinds = [x["type"] for x in before.get("pretokenizers", [before]) if x]
        if said["model"]["type"] != "BPE" or kinds != ["ByteLevel"] or before.get("add_prefix_space") or said.get("normalizer") or said["model"].get("end_of_word_suffix"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words = self.library.pre_tokenizer
        special = sorted((x["content"] for x in said.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # How byte-level models write each byte: printable ones as themselves, the others further up in order.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in seen)}
        self.number = {bytes([b]): b for b in range(256)}
        self.split: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in said["model"]["merges"]:
            left, right = (bytes(byte_of[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            pair = self.number[left], self.number[right]
            self.merged[pair] = self.number.setdefault(left + right, len(self.split))
            if self.number[left + right] == len(self.split):
                self.split.append(pair)
        self.known: dict[int, bool] = {}

    def _valid(self, left: int, right: int) -> bool:
        """Whether the two stand side by side in an encoding: undone step by step, the last made first, no earlier merge joins them."""
        limit = len(self.split) + 1
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            if left > right:
                order = (True, False)
            else:
                order = (False, True)
            for of_left in order:
                if of_left and left > 255:
                    limit, left = left, self.split[left][1]
                    break
                if not of_left and right > 255:
                    limit, right = right + 1, self.split[right][0]
                    break
            else:
                return True

    def _go_on(self, data: bytes, count: list[int], last: list[int]) -> None:
        """Counts and last tokens of the prefixes of a word, from those of its first bytes on, which are there already."""
        number, known = self.number.get, self.known
        begin = len(count) - 1
        for end in range(len(count), len(data) + 1):
            # Most often the last token of the prefix before grows by the new byte; else it is looked for from the shortest on.
            grown, tried = begin, False
            while True:
                token = number(data[begin:end])
                if token is not None:
                    if begin == 0:
                        break
                    pair = last[begin] << 32 | token
                    valid = known.get(pair)
                    if valid is None:
                        if len(known) > KNOWN:
                            known.clear()
                        valid = known[pair] = self._valid(last[begin], token)
                    if valid:
                        break
                if not tried:
                    tried, begin = True, end
                begin -= 1
                if begin == grown:
                    begin -= 1
            count.append(count[begin] + 1)
            last.append(token)

    def word(self, data: bytes) -> list[int]:
        """The token count of each prefix of a word, in bytes."""
        count, last = [0], [0]
        self._go_on(data, count, last)
        return count[1:]

    def single(self, words: list[str]) -> list[bytes]:
        """``counts`` of texts that are one word each: in order, so that each goes on from what it shares with the one before."""
        out, count, last, before = [b""] * len(words), [0], [0], b""
        coded = [x.encode() for x in words]
        for i in sorted(range(len(words)), key=coded.__getitem__):
            data = coded[i]
            same = 0
            for x, y in zip(data, before):
                if x != y:
                    break
                same += 1
            del count[same + 1 :], last[same + 1 :]
            self._go_on(data, count, last)
            before = data
            counts = count[1:]
            if len(data) != len(words[i]):
                counts = [n for n, x in zip(counts, [*data[1:], 0], strict=True) if x & 0xC0 != 0x80]  # where a character ends
            out[i] = array("I", counts).tobytes()
        return out

    def _chars(self, text: str) -> np.ndarray:
        data = text.encode()
        counts = np.array(self.word(data), np.int64)
        return counts if len(data) == len(text) else counts[np.cumsum([len(c.encode()) for c in text]) - 1]

    def _plain(self, text: str) -> np.ndarray:
        """Counts of a text without special strings."""
        out, so_far = np.zeros(len(text), np.int64), 0
        for _, (begin, end) in self.words.pre_tokenize_str(text):
            word = text[begin:end]
            counts = self._chars(word)
            out[begin:end] = so_far + (np.array([1, 2, counts[-1]]) if word in _CONTRACTED else counts)
            so_far += int(counts[-1])
        for run in _RUNS.finditer(text):  # white space at the end of a prefix is a word of its own
            begin = run.start()
            out[begin : run.end()] = (out[begin - 1] if begin else 0) + self._chars(run[0])
        # Behind white space words stand as in the whole text, which the first loop has counted.
        return out

    def _whole(self, text: str) -> int:
        """The count of a text without special strings."""
        return sum(self._chars(text[a:b])[-1] for _, (a, b) in self.words.pre_tokenize_str(text))

    def one(self, text: str) -> np.ndarray:
        parts, so_far, at = [], 0, 0
        for found in self.special.finditer(text) if self.special else ():
            plain = text[at : found.start()]
            parts += [so_far + self._plain(plain + found[0][:-1]), np.array([so_far + self._whole(plain) + 1])]
            so_far, at = int(parts[-1][0]), found.end()
        return np.concatenate([*parts, so_far + self._plain(text[at:])])

    def by_library(self, text: str) -> np.ndarray:
        """Counts of all prefixes, each encoded by the library: exact, and quadratic, for texts of which the two totals differ."""
        return np.array([len(self.library.encode(text[:n], add_special_tokens=False).ids) for n in range(1, len(text) + 1)], np.int64)

    def counts(self, texts: list[str]) -> list[bytes]:
        out = []
        for text, whole in zip(texts, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            counts = self.one(text)
            if len(text) and counts[-1] != len(whole.ids):
                counts = self.by_library(text)
            out.append(counts.astype(np.uint32).tobytes())
        return out
