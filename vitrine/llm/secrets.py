"""Secret scan: fixed patterns, and a guess-cost estimate of values that stand where credentials stand.

Three patterns find assignments, access keys and long hexadecimal runs. In addition, what follows a credential word
(`pwd: …`, `login = …`, `Authorization: Bearer …`) is judged by what it would cost to guess it: dynamic programming over its
characters finds the cheapest way to build the value from dictionary words (with changed letter case or digits for letters), parts of addresses,
separators, dates, repeats, keyboard walks and brute-force spans. A value as costly as a random one is reported as `guess`;
a placeholder, an address or an ordinary word is not. Values of any length are segmented whole: words, dates and walks are short, and for
brute-force spans and repeats only the beginnings that can still be the best ones are kept.
"""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vitrine.llm import rows

KINDS = ("assign", "access", "hex", "guess")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: A value is reported from this many decimal digits of guesses on, if they are this share of what a random value of its length and signs needs.
LEAST_COST, LEAST_SHARE = 12.0, 0.7

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
#: Where credentials stand: the words of the assignments above, which may end a longer name, and others; a value may have any sign.
_CONTEXT = re.compile(
    r"""(?:(?:password|passwd|secret|token|api[-_]?key|(?<![A-Za-z0-9])(?:pass|pwd|passphrase|passcode|pin|credentials?|auth|authorization|login|"""
    r"""(?:access|private|client|secret)[-_]?key))"""
    r"""["']?(?:\x20*[:=]\x20*|\x20+is\x20+)["']?(?:bearer\x20+|basic\x20+)?|(?<![A-Za-z0-9])bearer\x20+)(?=([!-~]{6,}))""",
    re.I | re.A,
)

# fixed values: common parts of passwords, most usual first
WORDS = (
    "password qwerty letmein admin welcome login monkey dragon master hello freedom whatever trustno ninja shadow sunshine "
    "princess football baseball superman batman michael jordan charlie daniel jessica thomas andrew secret token changeme default "
    "example test user guest root server system access public private key pass word summer winter spring autumn love money star "
    "black blue green red white orange purple silver golden tiger lion eagle wolf horse cat dog bird fish apple banana cherry "
    "coffee cookie computer internet samsung google iloveyou abc my the your none null true false placeholder xxxx todo sample demo"
).split()
# fixed values: rows of the keyboard
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp", "1qaz2wsx3edc4rfv")
# fixed values: digits and signs that stand for letters
_LEET = str.maketrans("013457@$!", "oleastasi")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0?[1-9]|1[0-2])(?:[-/._]?(?:0?[1-9]|[12]\d|3[01]))?)?$|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d$")
_LONGEST_DATE = 10
# fixed values: parts of addresses, and signs between words
ADDRESS_PARTS = "http:// https:// ftp:// mailto: www. .com .org .net .edu .io .de .fr .es .html .htm .php .json /login /index localhost 127.0.0.1".split()
SEPARATORS = "-_./:@,+=&?#"
_PARTS, _LONGEST_PART = frozenset(ADDRESS_PARTS), max(map(len, ADDRESS_PARTS))
_LONGEST_WALK = max(map(len, ROWS))
#: Lengths of the units that a repeat may have inside a value.
REPEATED = (1, 2, 3, 4)


@lru_cache(maxsize=1)
def dictionary() -> tuple[str, ...]:
    """Parts of passwords, then ordinary words (the whole words of a tokenizer's vocabulary), most usual first."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ordinary = (w.removesuffix("</w>") for w in sorted(vocabulary, key=vocabulary.get) if w.endswith("</w>"))
    return tuple(dict.fromkeys([*WORDS, *(w for w in ordinary if len(w) >= 3 and w.isalpha())]))


_ranked: dict[int, tuple[tuple[str, ...], dict[str, int], int]] = {}


def _ranks(words: tuple[str, ...]) -> tuple[dict[str, int], int]:
    found = _ranked.get(id(words))  # hashing a large dictionary for each value would cost more than the value
    if found is None:
        if len(_ranked) >= 8:
            _ranked.clear()
        found = _ranked[id(words)] = (words, {w: i for i, w in reversed(list(enumerate(words, 1)))}, max(map(len, words), default=0))
    return found[1:]


@lru_cache(maxsize=1)
def _walks() -> frozenset[str]:
    """All stretches of three or more keys along a row, forwards and backwards."""
    return frozenset(r[i:j] for row in ROWS for r in (row, row[::-1]) for i in range(len(r)) for j in range(i + 3, len(r) + 1))


def _alphabet(text: str) -> int:
    """How many characters a guesser has to try for each place."""
    kinds = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))
    return sum(n for test, n in kinds if any(map(test, text))) + 33 * (not text.isalnum()) or 1


def segment_cost(value: str, begin: int, end: int, brute: float, ranks: dict[str, int], longest: int) -> float:
    """Decimal digits of the guesses for a word, an address part, a separator, a walk or a date; infinite where it is none."""
    size, part, cost = end - begin, value[begin:end].lower(), math.inf
    if size <= longest:
        rank = ranks.get(part)
        if rank is None and (rank := ranks.get(part.translate(_LEET))) is not None:
            rank *= 4
        if rank is not None:
            cost = math.log10(rank * (1 if value[begin:end] == part else 2))
    if part in _PARTS:
        cost = min(cost, math.log10(len(_PARTS)))
    if size == 1 and part in SEPARATORS:
        cost = min(cost, math.log10(len(SEPARATORS)))
    if size >= 3 and part in _walks():
        cost = min(cost, math.log10(len(ROWS) * 20 * size))
    if 4 <= size <= _LONGEST_DATE and part[0].isdigit() and _DATE.match(part):
        cost = min(cost, math.log10(365 * 120))
    return cost


class _Repeats:
    """The cheapest way to end a repeat of three or more equal units of a length at each place.

    A beginning is dropped when an earlier one is as cheap: the digits that an earlier one needs more, for its larger number of units, only shrink.
    """

    def __init__(self, unit: int):
        self.unit = unit
        self.begins: list[list[int]] = [[] for _ in range(unit)]
        self.since = 0  # no repeat reaches back beyond this place

    def at(self, lower: str, end: int, best: list[float]) -> float:
        u = self.unit
        if end > u and lower[end - 1] != lower[end - 1 - u]:
            self.since = end - u
        begins = self.begins[end % u]
        if end >= 3 * u:
            begins.append(end - 3 * u)
        kept, least = [], math.inf
        for b in begins:
            if b >= self.since:
                cost = best[b] + _next(b) + math.log10((end - b) // u)
                if cost < least:
                    kept.append(b)
                    least = cost
        self.begins[end % u] = kept
        return least


def _next(begin: int) -> float:
    """What one more segment costs."""
    return 0.3 if begin else 0.0


def _period(value: str) -> int:
    """The shortest length after which the value goes on as it began."""
    fail, k = [0], 0
    for c in value[1:]:
        while k and value[k] != c:
            k = fail[k - 1]
        k += value[k] == c
        fail.append(k)
    return len(value) - fail[-1]


def guess_cost(value: str, words: tuple[str, ...] | None = None) -> float:
    """Decimal digits of the guesses that the cheapest segmentation of `value` needs.

    `best[i]` is the cost of the first i characters; each segment adds the digits of its own guesses and a little for being
    one more segment. A value that repeats from its beginning to its end costs its unit and the number of units, if that is less.
    """
    words = dictionary() if words is None else words
    ranks, longest = _ranks(words)
    lower, n = value.lower(), len(value)
    brute = math.log10(_alphabet(value))
    most = max(longest, _LONGEST_PART, _LONGEST_WALK, _LONGEST_DATE)
    repeats = [_Repeats(u) for u in REPEATED]
    best, run = [0.0] + [math.inf] * n, math.inf  # run: the cost with a brute-force span that ends here
    for end in range(1, n + 1):
        run = min(run, best[end - 1] + _next(end - 1)) + brute
        least = run
        for begin in range(max(0, end - most), end):
            cost = best[begin] + _next(begin)
            if cost < least:  # no segment costs less than nothing
                least = min(least, cost + segment_cost(value, begin, end, brute, ranks, longest))
        for repeat in repeats:
            least = min(least, repeat.at(lower, end, best) + brute * repeat.unit)
        best[end] = least
    period = _period(lower) if n > 1 else n
    if 2 * period <= n:
        best[n] = min(best[n], guess_cost(value[:period], words) + math.log10(-(-n // period)))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def guess_spans(text: str, taken: list[tuple[int, int, str]], least_cost: float, words: tuple[str, ...] | None) -> list[tuple[int, int, str]]:
    """Values in a credential's place that no base span covers as a whole and that are costly to guess."""
    found = []
    for m in _CONTEXT.finditer(text):
        begin, end = m.span(1)
        value = m[1]
        closing = re.search(r"(?<!\\)" + text[begin - 1], value) if text[begin - 1] in "\"'" else None
        value = value[: closing.start()] if closing else value.rstrip("\"'`,;:.!?)]}>")
        end = begin + len(value)
        if len(value) < LEAST_VALUE or any(a <= begin and end <= b for a, b, _ in taken):
            continue
        cost = guess_cost(value, words)
        if cost >= least_cost and cost >= LEAST_SHARE * math.log10(_alphabet(value)) * len(value):
            found.append((begin, end, "guess"))
    return found


def spans_of(text: str | None, least_cost: float = LEAST_COST, words: tuple[str, ...] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed in `KINDS`; code points, end exclusive."""
    if not text:
        return []
    found = base_spans(text)
    found += guess_spans(text, found, least_cost, words)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def scan(documents: DataFrame, text: str = "text", least_cost: float = LEAST_COST, words: tuple[str, ...] | None = None) -> DataFrame:
    """`documents` with `secrets`: array of (kind, start, end).

    Null and empty texts have none. Every row gives one row, repeated rows included; an empty table gives an empty one. Values of any length
    are judged whole. An input column named `secrets`, in any letter case, is replaced. `words`: the dictionary of the cost estimate, most usual word first
    (`dictionary()` unless given; an empty one has no words).
    """
    words = dictionary() if words is None else words  # read here, sent to the executors

    def process(texts):
        return ([[{"kind": k, "start": a, "end": b} for a, b, k in spans_of(t, least_cost, words)] for t in texts],)

    return rows.with_columns(documents, text, [("secrets", T.ArrayType(SPAN))], process)


def redact(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by `mark` (overlapping ones by one); null stays null, other columns as they are."""
    words = dictionary()

    def change(texts):
        out = []
        for t in texts:
            at, parts = 0, []
            for a, b, _ in spans_of(t, words=words):
                if b > at:
                    if a >= at:
                        parts += [t[at:a], mark]
                    at = b
            out.append("".join(parts) + t[at:] if parts else t)
        return out

    return rows.replaced(documents, text, change)
