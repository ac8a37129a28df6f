"""Byte-pair encoding as a transducer with bounded lookahead, and decoding with an incremental state machine.

**Encoding.** For every prefix of a word the transducer knows the last token of the prefix's encoding. The encoding of a
prefix ends in token t exactly if t is the end of the prefix and the tokens before, which are the encoding
of the shorter prefix, may stand next to t; whether two tokens may stand side by side follows from the merge
list alone. So one step for each byte finds the last token of the longer prefix among the tokens that end there.

**Lookahead.** No token is longer than `lookahead` bytes (computed from the merge list), so the encoding of any longer
prefix reaches back to one of the last `lookahead` prefixes. Where the chains of last tokens of all of these run
together, the tokens before are stable whatever follows: they are emitted and their bytes are forgotten. What is
kept does not grow with the length of the text.

**Words.** White space and the tokenizer's pattern cut a text into words before any merging; the last byte of a word has
a symbol of its own. Words that were encoded before are looked up in a memory of bounded size, which another operator's work in
the same Python worker lets go of.

**Decoding.** Ids become bytes, and bytes become text through a state machine that holds back an incomplete character. A text is
worked through in slices, so neither its ids nor its decoded form are ever there whole.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vitrine.llm import rows

#: Words kept in memory by a worker; longer ones than `LONG` characters are never kept.
WORDS = 200_000
PIECES = 400_000
LONG = 64
PAIRS = 500_000
#: Symbols at the beginning of a word after which the state is remembered, and how many such beginnings.
HEAD, HEADS = 5, 100_000
#: Feed long texts to the transducer in pieces of this many characters.
CHUNK = 65_536


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 characters for themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, following = [], 256
    for b in range(256):
        if b in printable:
            symbols.append(chr(b))
        else:
            symbols.append(chr(following))
            following += 1
    return symbols


class Merges:
    """A merge list with the tables that the transducer needs. Tokens are ids; each is a string of byte symbols,
    the last of which carries the mark of the word's end where the token has it."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.end = end
        self.rank = {(vocabulary[a], vocabulary[b]): (i, vocabulary[a + b]) for i, (a, b) in reversed([*enumerate(merges)])}
        self.parts: dict[int, tuple[int, int, int]] = {}  # the merge of lowest rank that makes a token
        for (a, b), (i, token) in self.rank.items():
            if token not in self.parts or i < self.parts[token][2]:
                self.parts[token] = (a, b, i)
        self.symbols = byte_symbols()
        self.inner = [vocabulary.get(s) for s in self.symbols]
        self.final = [vocabulary.get(s + end) for s in self.symbols]
        made = {*self.parts, *filter(lambda x: x is not None, [*self.inner, *self.final])}
        self.names = {i: name for name, i in vocabulary.items()}
        #: token by its text, apart for tokens inside a word and at its end
        self.inside, self.closing = {}, {}
        for i in made:
            name = self.names[i]
            if end and name.endswith(end):
                self.closing[name[: -len(end)]] = i
            else:
                self.inside[name] = i
        self.lookahead = max(map(len, [*self.inside, *self.closing]))
        self._pairs: dict[tuple[int, int], bool] = {}
        #: those whose own bytes are encoded as that token, and the lengths of these that may end after the last symbols of a prefix, longest first
        self.heads: dict[str, tuple[list[int], list[int]]] = {}
        self.sound_inside, self.sound_closing = ({text: i for text, i in side.items() if self.merged(self.base(i)) == [i]} for side in (self.inside, self.closing))
        self.inside_lengths, self.closing_lengths = Lengths(self.sound_inside), Lengths(self.sound_closing)

    def merged(self, tokens: list[int]) -> list[int]:
        """Plain merging by rank, leftmost first: used for the tokens themselves and for pairs of them, which are short."""
        tokens = list(tokens)
        while len(tokens) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            tokens[i : i + 2] = [self.rank[tokens[i], tokens[i + 1]][1]]
        return tokens

    def base(self, token: int) -> list[int]:
        """The byte symbols of a token."""
        name = self.names[token]
        closes = self.end and name.endswith(self.end) and self.closing.get(name[: -len(self.end)]) == token
        letters = name[: -len(self.end)] if closes else name
        of = self.symbol_ids
        return [of[0][c] for c in letters[:-1]] + [of[1 if closes else 0][letters[-1]]]

    @property
    def symbol_ids(self):
        if not hasattr(self, "_symbol_ids"):
            self._symbol_ids = dict(zip(self.symbols, self.inner)), dict(zip(self.symbols, self.final))
        return self._symbol_ids

    def fit(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side: no merge across their border comes first.

        Both tokens are taken apart again, latest merge first; while they are, the pair at the border must not
        have a merge earlier than the one that is being undone.
        """
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._fit(left, right)
        return known

    def _fit(self, left: int, right: int) -> bool:
        rank, parts = self.rank, self.parts
        limit = float("inf")
        while True:
            across = rank.get((left, right))
            if across is not None and across[0] < limit:
                return False
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                return True
            # of equal ranks the merge further left comes first: the left token's own before one across the border,
            # and that before the right token's own
            if b is None or (a is not None and a[2] > b[2]):
                limit, left = a[2], a[1]
            else:
                limit, right = b[2] + 1, b[0]


class Lengths(dict):
    """For the last symbols of a prefix, three or as many as there are: the lengths of the tokens that can end there, longest first."""

    def __init__(self, tokens: dict[str, int]):
        super().__init__()
        self.tokens = tokens
        longer: dict[str, set[int]] = {}
        for text in tokens:
            if len(text) >= 3:
                longer.setdefault(text[-3:], set()).add(len(text))
        self.longer = {last: sorted(n, reverse=True) for last, n in longer.items()}

    def __missing__(self, last: str) -> list[int]:
        found = self.longer.get(last, []) + [n for n in (2, 1) if len(last) >= n and last[-n:] in self.tokens]
        if len(self) < PAIRS:
            self[last] = found
        return found


class Transducer:
    """Encodes one word, fed symbol by symbol; `feed` and `close` return the tokens that have become stable."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.text = ""  # symbols from the last stable border on
        self.last: list[int] = []  # last token of each prefix of `text`
        self.start: list[int] = []  # where that token begins

    def _steps(self, ends: range, tokens: dict[str, int], lengths: Lengths) -> None:
        """Find the last token of each prefix that ends at one of `ends`."""
        text, last, start, fit = self.text, self.last, self.start, self.merges.fit
        pairs = self.merges._pairs
        for end in ends:
            for n in lengths[text[end - 3 if end > 3 else 0 : end]]:
                begin = end - n
                if begin < 0:
                    continue
                token = tokens.get(text[begin:end])
                if token is None:
                    continue
                left = last[begin - 1] if begin else self.border
                if left is not None:
                    fits = pairs.get((left, token))
                    if not (fit(left, token) if fits is None else fits):
                        continue
                last.append(token)
                start.append(begin)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")

    border: int | None = None

    def feed(self, symbols: str) -> list[int]:
        """Symbols that are not the last of the word."""
        m, out, most = self.merges, [], 4 * self.merges.lookahead
        for i in range(0, len(symbols), most):
            begin = len(self.text)
            self.text += symbols[i : i + most]
            self._steps(range(begin + 1, len(self.text) + 1), m.sound_inside, m.inside_lengths)
            if len(self.text) >= most:
                out += self._stable()
        return out

    def word(self, symbols: str) -> list[int]:
        """A short word at once, by a machine that is as new: what `feed` and `close` give, with the state after its first symbols remembered."""
        m, n, first = self.merges, len(symbols), 1
        self.text = symbols
        if n > HEAD:
            known = m.heads.get(symbols[:HEAD])
            if known is None:
                self._steps(range(1, HEAD + 1), m.sound_inside, m.inside_lengths)
                if len(m.heads) < HEADS:
                    m.heads[symbols[:HEAD]] = self.last.copy(), self.start.copy()
            else:
                self.last, self.start = known[0].copy(), known[1].copy()
            first = HEAD + 1
        if n > first:
            self._steps(range(first, n), m.sound_inside, m.inside_lengths)
        self._steps(range(n, n + 1), *((m.sound_closing, m.closing_lengths) if m.end else (m.sound_inside, m.inside_lengths)))
        out = self._back(n, 0)
        self.text, self.last, self.start = "", [], []
        return out

    def close(self, symbol: str) -> list[int]:
        """The last symbol of the word; the transducer is then as new."""
        m = self.merges
        self.text += symbol
        end = len(self.text)
        self._steps(range(end, end + 1), *((m.sound_closing, m.closing_lengths) if m.end else (m.sound_inside, m.inside_lengths)))
        out = self._back(len(self.text), 0)
        self.text, self.last, self.start, self.border = "", [], [], None
        return out

    def _back(self, end: int, begin: int) -> list[int]:
        out = []
        while end > begin:
            out.append(self.last[end - 1])
            end = self.start[end - 1]
        return out[::-1]

    def _stable(self) -> list[int]:
        """Emit the tokens before the place where the chains of all prefixes that can still matter run together."""
        n = len(self.text)
        ends = set(range(max(0, n - self.merges.lookahead), n + 1))
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(self.start[latest - 1])
        place = ends.pop()
        out = self._back(place, 0)
        if place:
            self.border = self.last[place - 1]
            self.text = self.text[place:]
            self.last = self.last[place:]
            self.start = [s - place for s in self.start[place:]]
        return out


#: The tokenizer's pattern for words of ASCII characters without white space, lower case, control characters as their symbols.
_ASCII_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class WordCoder:
    """A tokenizer file of the tokenizers library with word ends, its own normaliser and pattern, and our merging."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        loaded = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = loaded.normalizer, loaded.pre_tokenizer
        self.names = self.merges.names | {i: s for s, i in self.special.items()}
        self.known_words: dict[str, tuple[int, ...]] = {}
        self.machine = Transducer(self.merges)
        self.ascii = dict(enumerate(self.merges.symbols[:128]))
        self.bytes_of = {c: b for b, c in enumerate(self.merges.symbols)}

    def _symbols(self, piece: str) -> list[str]:
        """The words of a piece without white space, as byte symbols."""
        if piece.isascii():  # no normal form but lower case, and the classes of the pattern are plain
            return _ASCII_WORDS.findall(piece.lower().translate(self.ascii))
        return [word for word, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(piece))]

    def stream(self, word: str) -> Iterator[int]:
        """Tokens of one word of byte symbols, as they become stable."""
        for i in range(0, len(word) - 1, CHUNK):
            yield from self.machine.feed(word[i : min(i + CHUNK, len(word) - 1)])
        yield from self.machine.close(word[-1])

    def word(self, word: str) -> tuple[int, ...]:
        found = self.known_words.get(word)
        if found is None:
            found = tuple(self.machine.word(word))
            if len(self.known_words) >= WORDS:
                self.known_words.clear()
            self.known_words[word] = found
        return found

    def tokens(self, piece: str) -> Iterator[int]:
        """Tokens of a piece of text without white space and special strings."""
        for word in self._symbols(piece):
            yield from self.word(word) if len(word) <= LONG else self.stream(word)

    def cut_text(self, text: str) -> list[str | tuple[int, ...]]:
        """The pieces of a text that hold no white space, in order; a special string is given as its token."""
        found: list[str | tuple[int, ...]] = []
        at = 0
        for special in self.cut.finditer(text) if self.cut else ():
            found += pieces(text[at : special.start()])
            found.append((self.special[special[0]],))
            at = special.end()
        return found + pieces(text[at:]) if at else pieces(text)

    def encode(self, text: str) -> Iterator[int]:
        for piece in self.cut_text(text):
            yield from piece if isinstance(piece, tuple) else self.tokens(piece)

    def ids(self, text: str | None) -> list[int]:
        return [*self.encode(text)] if text else []


#: White space as the pattern has it; str.split knows four control characters more.
_MORE = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")


def pieces(text: str) -> list[str]:
    return [p for p in _WHITE.split(text) if p] if _MORE.search(text) else text.split()


class Decoder:
    """Bytes to text, fed token by token: an incomplete character is kept (three bytes at most) until it is complete; what can
    never become one is replaced by U+FFFD."""

    def __init__(self, coder: WordCoder):
        self.coder = coder
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def raw(self, token: int) -> bytes:
        """The bytes that a token stands for; a word's end is a blank, a special token its own text."""
        c = self.coder
        name = c.names[token]
        if name in c.special:
            return name.encode()
        end = c.merges.end
        closes = bool(end) and name.endswith(end)
        return bytes(c.bytes_of[x] for x in (name[: -len(end)] if closes else name)) + (b" " if closes else b"")

    def feed(self, token: int) -> str:
        return self.machine.decode(self.raw(token))

    def close(self) -> str:
        return self.machine.decode(b"", True)

    def text(self, tokens: Iterable[int]) -> str:
        return "".join([*map(self.feed, tokens), self.close()])


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


class Pieces(dict):
    """The ids of a piece, found when first asked for and forgotten when there are too many; a special string is its ids."""

    def __init__(self, coder: WordCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str | tuple[int, ...]) -> tuple[int, ...]:
        if type(piece) is tuple:
            return piece
        words = self.coder._symbols(piece) if len(piece) <= LONG else ()
        ids = self.coder.word(words[0]) if len(words) == 1 and len(words[0]) <= LONG else tuple(self.coder.tokens(piece))
        if len(piece) <= LONG:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids


def slices(text: str, most: int) -> Iterator[str]:
    """A text in slices of about `most` characters, cut at white space, where no word and no special string goes on."""
    begin = 0
    while len(text) - begin > most:
        white = _WHITE.search(text, begin + most)
        if white is None:
            break
        yield text[begin : white.start()]
        begin = white.end()
    yield text[begin:] if begin else text


class Digests:
    """Encodes texts and decodes their ids again, slice by slice; keeps counts and digests.

    The tokenizer has no decoder of its own, so the library's decoded text is its tokens' names joined by blanks: these bytes
    go through the state machine.
    """

    def __init__(self, path: str):
        self.coder = coder(path)
        self.known = Pieces(self.coder)
        most = max(self.coder.names) + 1
        self.decimal = [b"%d" % i for i in range(most)]
        self.names = [self.coder.names.get(i, "").encode() for i in range(most)]

    def forget(self) -> None:
        self.known.clear()
        self.coder.known_words.clear()
        self.coder.merges._pairs.clear()
        self.coder.merges.heads.clear()

    def ids(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, some at a time."""
        for part in slices(text, CHUNK):
            found = [*chain.from_iterable(map(self.known.__getitem__, self.coder.cut_text(part)))]
            if found:
                yield found

    def of(self, text: str | None, kept: list[int] | None = None) -> tuple[int, str, str]:
        """Number of tokens, digest of the ids, digest of the decoded text; the ids go to `kept`, if given."""
        rows.only("bpe", self.forget)
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for found in self.ids(text or ""):
            sep = b" " if n else b""
            n += len(found)
            ids.update(sep + b" ".join(map(self.decimal.__getitem__, found)))
            decoded.update(machine.decode(sep + b" ".join(map(self.names.__getitem__, found))).encode())
            if kept is not None:
                kept += found
        decoded.update(machine.decode(b"", True).encode())
        return n, ids.hexdigest(), decoded.hexdigest()


@lru_cache(maxsize=1)
def digests(path: str) -> Digests:
    return Digests(path)


def encode(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`documents` with `token_ids` (array<int>); null gives null, the empty text no tokens. Every row gives one row; an
    empty table gives an empty one. An input column with the name of a result column is replaced."""
    fields = [("token_ids", T.ArrayType(T.IntegerType()))]
    return rows.with_columns(documents, text, fields, lambda texts: ([None if t is None else coder(path).ids(t) for t in texts],))


def decode(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """`encoded` with `decoded` (the text that the ids stand for, a blank after each word); null ids give null."""
    fields = [("decoded", T.StringType())]
    process = lambda lists: ([None if x is None else Decoder(coder(path)).text(x) for x in lists],)
    return rows.with_columns(encoded, ids, fields, process)


def round_trip(documents: DataFrame, path: str, text: str = "text", ids: bool = False) -> DataFrame:
    """`documents` with `n_tokens`, `ids_sha256` (ids joined by blanks) and `decoded_sha256` (the library's decoded form), and with `token_ids` if asked for.

    Null counts as the empty text: no tokens, digests of the empty text. Every row gives one row, repeated rows
    included; an empty table gives an empty one. Input columns with the name of a result column are replaced. Long texts are encoded and
    decoded in slices; only `token_ids` holds all ids of a text.
    """
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    fields += [("token_ids", T.ArrayType(T.IntegerType()))] if ids else []

    def process(texts):
        worker, found = digests(path), []
        for t in texts:
            kept = [] if ids else None
            found.append((*worker.of(t, kept), *([kept] if ids else [])))
        return [*map(list, zip(*found))] or [[] for _ in fields]

    return rows.with_columns(documents, text, fields, process)
