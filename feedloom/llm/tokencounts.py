"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch are held as one flat array of symbols with the number of the
sequence that each belongs to. In every round, each sequence finds its adjacent pair of lowest
merge rank, and all sequences merge that pair at once, wherever it stands in them; what is left when no pair has a
rank any more is counted. Only the vocabulary file is read; its library is not run.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.llm.common import slices, text_of
from feedloom.llm.tokens import space_pieces, units

#: Fixed value: how byte-level BPE cuts a text into pre-tokens.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SLICE = 8_000_000  # characters counted at once
BLOCK = 4_000_000  # symbols merged at once


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The merge table of a byte-level BPE vocabulary as sorted arrays: pair -> rank, pair -> symbol."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.byte_symbol = np.zeros(256, dtype=np.int64)
        for letter, byte in _byte_letters().items():
            self.byte_symbol[byte] = vocab[letter]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys, first = np.unique(keys, return_index=True)  # the first of equal pairs has the lower rank
        self._keys, self._rank, self._made = keys, first.astype(np.int64), made[first]
        self.marks = [t["content"] for t in data.get("added_tokens", [])]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the table) of pairs; the rank is the table's size where there is no such merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._rank[at], len(self._keys)), at

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string when all merges are done."""
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        counts = np.empty(len(tokens), dtype=np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < len(tokens):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BLOCK)))
            counts[start:stop] = self._merge(b"".join(tokens[start:stop]), lengths[start:stop])
            start = stop
        return counts

    def _merge(self, data: bytes, lengths: np.ndarray) -> np.ndarray:
        counts = lengths.copy()
        symbols = self.byte_symbol[np.frombuffer(data, dtype=np.uint8)]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        none = len(self._keys)
        rank, at = self._pair_ranks(symbols, owner)
        while len(symbols):
            # Sequences lie one after the other: the lowest rank of each is a reduction over its run.
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            alive = lowest < none
            if not alive.all():  # finished sequences leave
                symbols, owner, rank, at, lowest = (x[alive] for x in (symbols, owner, rank, at, lowest))
                if not len(symbols):
                    break
            merge = rank == lowest
            merge = _alternate(merge)
            gone = np.r_[False, merge[:-1]]
            symbols = np.where(merge, self._made[at], symbols)
            keep = ~gone
            np.subtract.at(counts, owner[gone], 1)
            symbols, owner = symbols[keep], owner[keep]
            rank, at = self._pair_ranks(symbols, owner)
        return counts

    def _pair_ranks(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol the rank of the pair that it begins; none at the end of a sequence."""
        rank = np.full(len(symbols), len(self._keys), dtype=np.int64)
        at = np.zeros(len(symbols), dtype=np.int64)
        if len(symbols) > 1:
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inner], at[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        return rank, at


def _alternate(merge: np.ndarray) -> np.ndarray:
    """In a run of overlapping pairs (aaaa) take the first, third, ... from the left."""
    if not (merge[1:] & merge[:-1]).any():
        return merge
    at = np.arange(len(merge))
    last_gap = np.maximum.accumulate(np.where(merge, -1, at))
    return merge & ((at - last_gap) % 2 == 1)


class TokenCounter:
    """Numbers of tokens of texts; remembers counts of at most about ``keep`` words."""

    def __init__(self, path: str, keep: int = 800_000, longest: int = 40) -> None:
        self.merges = Merges(path)
        self._split = regex.compile(PRETOKEN).findall
        marks = "|".join(regex.escape(m) for m in self.merges.marks)
        self._mark = regex.compile(marks or "(?!)")
        self._keep, self._longest = keep, longest
        self._words: dict[str, int] = {}

    def _count(self, texts: list[str]) -> list[int]:
        """Counts of texts, without a memory: cut at special strings, then into pre-tokens."""
        owner, tokens, counts = [], [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            marked = self._mark.search(text)
            if marked:
                counts[i] = len(self._mark.findall(text))
            for part in self._mark.split(text) if marked else (text,):
                found = self._split(part)
                tokens += found
                owner += [i] * len(found)
        distinct = list(dict.fromkeys(tokens))
        number = dict(zip(distinct, self.merges.count([t.encode("utf-8", "replace") for t in distinct]).tolist(), strict=True))
        if tokens:
            counts += np.bincount(owner, weights=[number[t] for t in tokens], minlength=len(texts)).astype(np.int64)
        return counts.tolist()

    def count(self, texts: list[str]) -> list[int]:
        cut = [space_pieces(text) for text in texts]
        words = self._words
        seen = set().union(*[parts[1:] for parts in cut])
        new = seen.difference(words)
        parts = {w: [" " + w] if self._mark.search(w) else units(w) for w in new}
        todo = {u for found in parts.values() for u in found}
        number = {u: words[u[1:]] for u in todo if u[0] == " " and u[1:] in words}
        todo = [u for u in todo if u not in number]
        number.update(zip(todo, self._count(todo), strict=True))
        for w, found in parts.items():
            words[w] = sum([number[u] for u in found])
        heads = self._count([found[0] for found in cut])
        total = [head + sum(map(words.__getitem__, found[1:])) for head, found in zip(heads, cut, strict=True)]
        for w in new:
            if len(w) > self._longest:
                del words[w]
        if len(words) > self._keep:
            self._words = {w: words[w] for w in seen if w in words}
        return total


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter per worker process, so that what it remembers serves later tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def _counts(batches: Iterator[pd.Series], path: str) -> Iterator[pd.Series]:
    for texts in batches:
        found: list[int] = []
        for part in slices(texts, SLICE):
            found += counter(path).count(part.tolist())
        yield pd.Series(found, dtype="int64")


def token_count(text: str | Column, tokenizer: str) -> Column:
    """Number of tokens of each text as bigint, under a byte-level BPE vocabulary file.

    Special strings inside a text count one each, as the library's default has it; none are
    added. A null or empty text has none. Texts of any length are counted whole.
    """

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _counts(batches, tokenizer)

    return run(text_of(text))
