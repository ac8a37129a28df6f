"""Texts encoded by two public tokenizers at once: a byte-level one (A; a file of the tokenizers library, or ranks for tiktoken) and one of sentencepiece (B).

A text is encoded with one space before it. A space that follows a letter, digit or ASCII mark and is not the last character
begins a new word of A's pattern, and no piece of B has the mark of a space after another character. So no token of either
reaches over such a space, and the parts between are encoded alike alone and in place; `cuttable` checks both facts for the
files at hand, and where one fails a text is one part. Parts come again and again, so a task keeps the ids of each, up to a number
of bytes, and lets go of all when it ends.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

SPACE = "▁"
#: The pattern of words that byte-level vocabularies of this kind share.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=[\w!-/:-@\[-`{-~]) (?=.)", re.S)
#: Characters worked on at a time (a longer text alone), and bytes of remembered parts in a task.
CHARACTERS, REMEMBERED = 1 << 20, 96 << 20


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByFile:
    """A byte-level vocabulary of the tokenizers library. Special strings in a text are plain text."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        alphabet = _byte_alphabet()
        self.bytes = np.full(self.library.get_vocab_size(), b"", object)
        for entry, i in self.library.get_vocab().items():
            self.bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        file = json.loads(Path(path).read_text())
        before = file.get("pre_tokenizer") or {}
        self.cuttable = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not file.get("normalizer")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class ByRanks:
    """A byte-level vocabulary given as ranks, with the usual pattern of words."""

    def __init__(self, path: str):
        ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
        self.library = tiktoken.Encoding(Path(path).stem, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.full(max(ranks.values()) + 1, b"", object)
        for entry, rank in ranks.items():
            self.bytes[rank] = entry
        self.cuttable = public_tokenizers.PATTERN == WORDS

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.library.encode_ordinary(t) for t in texts]


class Both:
    """Two vocabularies, and the bytes that each of their entries stands for."""

    def __init__(self, path_a: str, path_b: str):
        self.a = ByRanks(path_a) if path_a.endswith(".tiktoken") else ByFile(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self.a.bytes
        self.size_a, self.size_b = len(self.bytes_a), self.b.vocab_size()
        self.fallback = np.array([self.b.is_byte(i) for i in range(self.size_b)])
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = np.empty(self.size_b, object)
        self.bytes_b[:] = [bytes([int(p[3:5], 16)]) if f else p.replace(SPACE, " ").encode() for p, f in zip(pieces, self.fallback)]
        self.length_a, self.length_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        #: each number followed by a comma, a bar and a semicolon
        self.names = np.array([b"%d%s" % (i, mark) for i in range(max(self.size_a, self.size_b)) for mark in (b",", b"|", b";")], object)
        marks = all(SPACE not in p.lstrip(SPACE) for p in pieces)
        spaces = "".join(self.b.id_to_piece(i) for i in self.b.encode("a  b")) == f"{SPACE}a{SPACE}{SPACE}b"
        self.cuttable = bool(self.a.cuttable and marks and spaces)

    def parts(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuttable else [text]

    def encode(self, parts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of A and B of each part, with a space before it."""
        for i in range(0, len(parts), 2048):
            some = parts[i : i + 2048]
            yield from zip(self.a.encode([" " + p for p in some]), self.b.encode(some, num_threads=1))


@lru_cache(maxsize=2)
def both(path_a: str, path_b: str) -> Both:
    return Both(path_a, path_b)


class Encoded:
    """Token ids of one task's texts. What each part gives is kept, in two arrays, until that is more than `REMEMBERED` bytes."""

    def __init__(self, tokens: Both):
        self.tokens = tokens
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def _learn(self, new: list[str]) -> None:
        n = len(self.number)
        self.number.update(zip(new, range(n, n + len(new))))
        both_ids = list(self.tokens.encode(new))
        for side in (0, 1):
            sizes = np.fromiter((len(ids[side]) for ids in both_ids), np.int64, len(new))
            flat = np.fromiter((i for ids in both_ids for i in ids[side]), np.int32, int(sizes.sum()))
            self.ids[side] = np.concatenate([self.ids[side], flat])
            self.starts[side] = np.concatenate([self.starts[side], self.starts[side][-1] + np.cumsum(sizes)])
        self.held += sum(map(len, new)) + 180 * len(new)

    def of(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts, one text after the other, and where each text begins."""
        cut = [self.tokens.parts(t) for t in texts]
        if self.held > REMEMBERED:
            self._forget()
        new = list(dict.fromkeys(p for parts in cut for p in parts if p not in self.number))
        if new:
            self._learn(new)
        number = self.number.__getitem__
        part = np.array([i for parts in cut for i in map(number, parts)], np.int64)
        begin = np.cumsum([0, *map(len, cut)])
        out = []
        for ids, starts in zip(self.ids, self.starts):
            sizes = starts[part + 1] - starts[part]
            out.append((ids[ranges(starts[part], sizes)], np.r_[0, np.cumsum(sizes)][begin]))
        return out


def slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about `CHARACTERS` characters in all."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > CHARACTERS:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … of every range, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
