"""Exact token counts of whole texts; huge texts are encoded in overlapping chunks that are spliced where both agree.

A chunk is encoded with the character offsets of its tokens. Tokens never cross the words into which the
tokenizer's pattern cuts a text, and where a word begins the pattern goes on without regard to what came before it. So
from a place where a word begins in both of two overlapping chunks, both go on alike as long as both see the text.
The splice is made at the last such place that is far enough (`MARGIN` characters) from the end of the left chunk
for its view there to be complete. If there is none, the overlap is doubled and the left chunk grows with it, in the end
up to the whole text, so that the count is always that of the whole text.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm import rows

CHUNK = 65_536
OVERLAP = 512
LIMIT = 512
#: Characters that the pattern may look ahead (one), and the longest special string must be in full view.
LOOKAHEAD = 1


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=4)
def margin(path: str) -> int:
    """Characters before the end of a chunk where its view is not complete."""
    return LOOKAHEAD + max([len(t.content) for t in tokenizer(path).get_added_tokens_decoder().values()], default=0)


def _starts(encoding, first: int, last: int) -> dict[int, int]:
    """Where words begin between two character positions, with the number of tokens before."""
    words, offsets = encoding.word_ids, encoding.offsets
    i = bisect_left(offsets, (first, -1))
    found: dict[int, int] = {}
    while i < len(offsets) and offsets[i][0] <= last:
        # the tokens of one word share its number; a special string has none and is a word of its own
        if i == 0 or ((words[i] is None or words[i] != words[i - 1]) and offsets[i][0] >= offsets[i - 1][1]):
            found[offsets[i][0]] = i
        i += 1
    return found


def count(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, with at most about `chunk` characters encoded at a time unless no splice is found."""
    tok = tokenizer(path)
    begin, end = 0, min(chunk, len(text))
    left = tok.encode(text[begin:end], add_special_tokens=False)
    if end == len(text):
        return len(left.ids)
    spliced, skipped, total = 0, 0, 0
    while end < len(text):
        width, place = overlap, None
        while place is None and end - width > spliced:
            right_begin = end - width
            right_end = min(len(text), right_begin + chunk + width)
            right = tok.encode(text[right_begin:right_end], add_special_tokens=False)
            last = end - margin(path)
            ours = _starts(left, right_begin + 1 - begin, last - begin)
            theirs = _starts(right, 1, last - right_begin)
            place = max((begin + p for p in ours if begin + p - right_begin in theirs), default=None)
            width *= 2
        if place is None:
            # even an overlap as long as what is left of the left chunk has no common place: a longer left chunk
            begin, end, skipped = spliced, min(len(text), end + (end - spliced) + chunk), 0
            left = tok.encode(text[begin:end], add_special_tokens=False)
        else:
            total += ours[place - begin] - skipped
            skipped = theirs[place - right_begin]
            left, begin, end, spliced = right, right_begin, right_end, place
    return total + len(left.ids) - skipped


class PieceCounts(dict):
    """Tokens of a blank followed by a piece of text, computed when first asked for and forgotten when there are too many.

    A blank between two characters that are not white space always begins a new word of the pattern, and no
    special string holds a blank, so the pieces between such blanks are encoded alike whatever stands around them.
    """

    MOST = 600_000

    def __init__(self, path: str):
        super().__init__()
        self.tok = tokenizer(path)

    def learn(self, texts: list[list[str]]) -> None:
        if len(self) > self.MOST:
            self.clear()
        new = list(set().union(*texts).difference(self))
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            self.update(zip(part, (len(e.ids) for e in self.tok.encode_batch_fast([" " + p for p in part], add_special_tokens=False))))


_UNSAFE = re.compile(r"(?:^|\s) | (?:\s|$)")


def pieces_of(text: str) -> tuple[str, list[str]]:
    """The text up to the first safe blank, and the pieces behind the safe blanks."""
    raw = text.split(" ")
    if not _UNSAFE.search(text):
        return raw[0], raw[1:]
    joined = [raw[0]]
    for p in raw[1:]:
        before = joined[-1]
        if p and before and not p[0].isspace() and not before[-1].isspace():
            joined.append(p)
        else:
            joined[-1] = before + " " + p
    return joined[0], joined[1:]


@lru_cache(maxsize=4)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def counts(path: str, texts: list[str | None], chunk: int = CHUNK) -> list[int]:
    """Token counts of many texts: those over `chunk` characters in overlapping chunks, the others by their pieces."""
    tok, known, out = tokenizer(path), piece_counts(path), []
    for i in range(0, len(texts), 256):
        part = [t or "" for t in texts[i : i + 256]]
        cut = [pieces_of(t) if len(t) <= chunk else ("", []) for t in part]
        known.learn([pieces for _, pieces in cut])
        firsts = tok.encode_batch_fast([first for first, _ in cut], add_special_tokens=False)
        out += [
            count(path, t, chunk) if len(t) > chunk else len(e.ids) + sum(map(known.__getitem__, pieces))
            for t, e, (_, pieces) in zip(part, firsts, cut)
        ]
    return out


def count_tokens(documents: DataFrame, path: str, text: str = "text", limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """`documents` with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens).

    Null counts as the empty text: no bytes, no tokens. Every row gives one row; an empty table gives an empty one.
    Input columns with the name of a result column are replaced. `path`: a tokenizer file of the tokenizers
    library that every executor has.
    """
    fields = [("n_bytes", T.LongType()), ("n_tokens", T.LongType())]

    def process(texts):
        return [len((t or "").encode("utf-8", "surrogatepass")) for t in texts], counts(path, texts, chunk)

    return rows.with_columns(documents.drop("over_limit"), text, fields, process).withColumn("over_limit", F.col("n_tokens") > limit)
