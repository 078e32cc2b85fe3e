"""Token ids by the tokenizers library, with a memory for pieces of text that come again.

The pre-tokenizer of byte-level BPE never joins a visible character with a space after it. A text
may therefore be cut before each single space between two visible characters without changing its
ids, and a piece needs to be encoded once for as long as it is remembered.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH = 20_000  # pieces given to the library at once
CUT = re.compile(r"(?<=\S) (?=\S)")
#: A space that is not alone between two visible characters.
UNSURE = re.compile(r"\s | \s|^ | \Z")


def space_pieces(text: str) -> list[str]:
    """The text cut at its safe spaces; joined by one space each, the pieces are the text again."""
    return CUT.split(text) if UNSURE.search(text) else text.split(" ")


#: White space other than spaces and line ends.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: A text in which some white space is not a single space or line end between two visible characters.
ODD = r"\A[ \n]|[ \n]\z|[ \n][ \n]|[" + "".join(rf"\x{{{ord(c):x}}}" for c in OTHER_SPACES) + "]"
#: Where any text may be cut: at a single space between two visible characters, and before other runs of white space.
RUN = re.compile(r"(?<=\S)(?: (?=\S)|(?=[ \n\t\r]))")


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def pieces(texts: pa.Array) -> pa.ListArray:
    """The texts cut at their safe spaces and line ends.

    A piece that is not the first of its text had a space before it, unless it starts with white space itself.
    """
    odd = pc.match_substring_regex(texts, ODD)
    plain = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n"), " ")
    if not pc.any(odd).as_py():
        return plain
    others = pa.array([RUN.split(text) for text in _strings(texts.filter(odd))], plain.type)
    order = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
    return pa.concat_arrays([plain, others]).take(pa.array(order))


#: Letters after at most one line end; below U+0250 every version of Unicode has the same letters.
LETTERS = r"\A\n?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+\z"
#: What may follow the letters of a word without joining them.
TAIL = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"


def units(word: str) -> list[str]:
    """A piece with the space before it, cut further: at single line ends and after its letters."""
    found = []
    if word[:1] == "\n" and "\n" not in word[1:] and word[1:2].strip():  # a line end and what follows it
        head = word.rstrip(TAIL)
        return [head, word[len(head) :]] if head != word and head[-1].isalpha() else [word]
    for at, line in enumerate(word.split("\n")):
        if at and not (line and not line[0].isspace() and not word.isspace() and found[-1][-1] not in " \n"):
            return [" " + word]
        head = line.rstrip(TAIL)
        lead = "\n" if at else " "
        if head and head[-1].isalpha() and head != line:
            found += [lead + head, line[len(head) :]]
        else:
            found.append(lead + line)
    return found


class Ragged(NamedTuple):
    """Rows of numbers, one after the other, and how many each row has."""

    values: np.ndarray
    sizes: np.ndarray

    def rows(self, pick: np.ndarray) -> Ragged:
        """The picked rows, in that order."""
        starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        sizes = self.sizes[pick]
        skip = starts[pick] - (np.cumsum(sizes, dtype=np.int32) - sizes)
        return Ragged(self.values[np.repeat(skip, sizes) + np.arange(sizes.sum(), dtype=np.int32)], sizes)

    def __add__(self, more: Ragged) -> Ragged:
        return Ragged(np.concatenate([self.values, more.values]), np.concatenate([self.sizes, more.sizes]))


def _ragged(rows: list[list[int]]) -> Ragged:
    sizes = np.fromiter(map(len, rows), dtype=np.int32, count=len(rows))
    return Ragged(np.fromiter(chain.from_iterable(rows), dtype="<u4", count=int(sizes.sum())), sizes)


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each word stands among the known ones; -1 if it does not."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    Only the distinct pieces of the texts given together are looked up, and what is not remembered is encoded: letters
    straight by the library's model, all else by the library as a whole. Remembers ``keep`` pieces of at most ``longest``
    characters, those last asked for, as one string array and one number array. Special strings inside a text are treated as
    the library's default does; none are added.
    """

    def __init__(self, path: str, keep: int = 250_000, longest: int = 40) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self._library = Tokenizer.from_file(path)
        # Letters after a space are one pre-token: the same model gets them as such, in the letters that stand for bytes.
        self._letters = Tokenizer(self._library.model)
        self._letters.pre_tokenizer = WhitespaceSplit()
        low = "".join(map(chr, [10, *range(32, 0x250)]))
        shown = "".join(x for x, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(low))
        self._shown = np.zeros(256, dtype="<u4")
        self._shown[np.frombuffer(low.encode(), dtype=np.uint8)] = [ord(c) for c in shown]
        self._shown[0] = ord(" ")  # between two pre-tokens
        self.vocabulary = self._library.get_vocab_size()
        names = (self._library.id_to_token(i) or "" for i in range(self.vocabulary))
        #: Tokens with a space or line end in front: of letters, only the first has one.
        self._starts = np.array([name[:1] in (shown[0], shown[1]) for name in names])
        self._marks = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._keep, self._longest = keep, longest
        self._words, self._ids = pa.array([], pa.string()), _ragged([])

    def _encode(self, texts: list[str]) -> Ragged:
        found = _ragged([])
        for at in range(0, len(texts), BATCH):
            coded = self._library.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)
            found += _ragged([x.ids for x in coded])
        return found

    def _encode_letters(self, words: list[str]) -> Ragged:
        """Ids of words of letters, each after a space or a line end."""
        found = _ragged([])
        for at in range(0, len(words), BATCH):
            # A line end is a pre-token of its own.
            spaced = [w.replace("\n", "\n\0") if w[0] == "\n" else " " + w for w in words[at : at + BATCH]]
            data = np.frombuffer("\0".join(spaced).encode(), dtype=np.uint8)
            text = self._shown[data].tobytes().decode("utf-32-le")
            ids = np.array(self._letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self._starts[ids])
            found += Ragged(ids, np.diff(starts, append=len(ids)).astype(np.int32))
        return found

    def _learn(self, new: pa.Array) -> tuple[pa.Array, Ragged, np.ndarray]:
        """What is remembered together with the new pieces, and where each of these stands in it."""
        words, ids = self._words, self._ids
        unit = pc.ascii_rtrim(new, characters=TAIL)
        plain = pc.match_substring_regex(unit, LETTERS)
        for mark in self._marks:
            plain = pc.and_not(plain, pc.match_substring(new, mark))
        coded = unit.filter(plain).dictionary_encode()
        at = _places(coded.dictionary, words).copy()
        missing = at < 0
        at[missing] = len(words) + np.arange(missing.sum())
        learnt = coded.dictionary.filter(pa.array(missing))
        words, ids = pa.concat_arrays([words, learnt]), ids + self._encode_letters(_strings(learnt))
        plain = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(new), dtype=np.int32)
        place[plain] = at[coded.indices.to_numpy()]
        longer = plain & (pc.binary_length(new).to_numpy() > pc.binary_length(unit).to_numpy())
        whole, head = new.filter(pa.array(longer)), unit.filter(pa.array(longer))
        tails = pa.array([w[len(h) :] for w, h in zip(_strings(whole), _strings(head), strict=True)], pa.string())
        tails = tails.dictionary_encode()
        both = np.stack([place[longer], len(words) + tails.indices.to_numpy()], axis=1).ravel()
        both = (ids + self._encode(_strings(tails.dictionary))).rows(both)
        rest = new.filter(pa.array(~plain))
        place[longer] = len(words) + np.arange(len(whole))
        place[~plain] = len(words) + len(whole) + np.arange(len(rest))
        words = pa.concat_arrays([words, whole, rest])
        ids += Ragged(both.values, both.sizes.reshape(-1, 2).sum(axis=1, dtype=np.int32))
        ids += self._encode([w if w[0].isspace() else " " + w for w in _strings(rest)])
        return words, ids, place

    def _remember(self, words: pa.Array, ids: Ragged, asked: np.ndarray) -> None:
        """Keeps the pieces that were asked for or learnt last, then those from before."""
        last = np.zeros(len(words), dtype=bool)
        last[asked] = last[len(self._words) :] = True
        order = np.argsort(~last, kind="stable")
        short = pc.less_equal(pc.utf8_length(words), self._longest).to_numpy(zero_copy_only=False)
        order = order[short[order]][: self._keep]
        self._words, self._ids = words.take(pa.array(order)), ids.rows(order)

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids begin; at last, where all end."""
        parts = pieces(texts)
        ends, parts = parts.offsets.to_numpy(), parts.values
        first = np.zeros(len(parts), dtype=bool)
        first[ends[:-1]] = True
        heads, coded = parts.filter(pa.array(first)).dictionary_encode(), parts.filter(pa.array(~first)).dictionary_encode()
        at = _places(coded.dictionary, self._words).copy()
        words, ids, place = self._learn(coded.dictionary.filter(pa.array(at < 0)))
        at[at < 0] = place
        pick = np.empty(len(parts), dtype=np.int32)
        pick[~first] = at[coded.indices.to_numpy()]
        pick[first] = len(words) + heads.indices.to_numpy()
        found = (ids + self._encode(_strings(heads.dictionary))).rows(pick)
        self._remember(words, ids, at)
        done = np.concatenate([[0], np.cumsum(found.sizes, dtype=np.int64)])
        return found.values, done[ends]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        ids, ends = self.encode_flat(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in pairwise(ends.tolist())]
