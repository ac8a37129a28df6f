"""Quality by tokeniser fertility: how well public vocabularies, made from ordinary text, fit a text.

Measures of a text: characters per token in two vocabularies (junk, shouting and foreign codes fall apart into more tokens, padding and
stuck words into fewer), the share of tokens that are a fallback to single bytes, and the entropy of its tokens in bits.

Bands: documents are grouped by language (a column, where there is one), script (of most letters) and length (powers of two
of the tokens), since all measures depend on these. The band of a measure in a group reaches `REACH` times the distance between the quartiles
beyond either quartile; the distance is taken as `LEAST_SPREAD` at least. Quartiles are exact, over all documents that pass the base rules, with equal measures counted
once so that copies don't decide. A group of fewer than `LEAST_MEMBERS` takes the band of its language and script, else of its script; without any it has
none and rejects nothing. Measures are rounded to 1/`GRID`, so a group has a bounded number of values.

Base rules, before that: too few words, or too large a share of words in repeated three-word windows.

Defined cases: null counts as the empty text, which has no words and fails the base rules. Every row gives one row, repeated ones too. A null
language is a language of its own. Long texts are read whole. An empty table gives an empty one. Input columns named like a result column, in any letter case, are
replaced (the text and language columns may not be).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vitrine.llm.rows import importable
from vitrine.llm.units import Both, Encoded, both, slices
from vitrine.workspace import stage

LEAST_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
REACH, LEAST_MEMBERS, GRID = 3.0, 30, 1000
MEASURES = ["chars_per_token_a", "chars_per_token_b", "fallback_share", "token_entropy"]
LEAST_SPREAD = {"chars_per_token_a": 0.1, "chars_per_token_b": 0.1, "fallback_share": 0.01, "token_entropy": 0.15}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: First code points of Unicode blocks, each with the script from there on.
_BLOCKS = [
    (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"), (0x250, ""), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"),
    (0x590, "hebrew"), (0x600, "arabic"), (0x780, ""), (0x900, "indic"), (0xE00, "thai"), (0xE80, ""), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, ""),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, ""), (0x3400, "han"), (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""),
    (0xF900, "han"), (0xFB00, ""), (0x20000, "han"), (0x32000, ""),
]
_FIRST = np.array([0, *(at for at, _ in _BLOCKS)])
_SCRIPTS = ["", *(name for _, name in _BLOCKS)]


def script_of(text: str) -> str:
    """The script most letters belong to, of equally frequent ones the first in the alphabet; '' without letters."""
    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else ""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts: Counter = Counter()
    for name, n in zip(_SCRIPTS, np.bincount(np.searchsorted(_FIRST, points, "right") - 1, minlength=len(_FIRST)).tolist()):
        counts[name] += n
    del counts[""]
    return min(counts, key=lambda s: (-counts[s], s)) if any(counts.values()) else ""


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """`COUNTS` of one text."""
    words = _WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    often, repeated = Counter(windows), 0
    if len(often) < len(windows):
        end = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), again, repeated


def token_measures(tokens: Both, texts: list[str], encoded: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of B of each text, and its `MEASURES` on the grid (zeros for an empty text)."""
    (_, at_a), (b, at_b) = encoded
    chars = np.array([len(t) for t in texts], float)
    in_a, in_b = np.maximum(np.diff(at_a), 1), np.maximum(np.diff(at_b), 1)
    fallback = np.diff(np.r_[0, np.cumsum(tokens.fallback[b])][at_b])
    text = np.repeat(np.arange(len(texts)), np.diff(at_b))
    keys, often = np.unique((text << 32) + b, return_counts=True)
    of = keys >> 32
    share = often / in_b[of]
    entropy = np.bincount(of, -share * np.log2(share), minlength=len(texts))
    found = np.column_stack([chars / in_a, chars / in_b, fallback / in_b, entropy])
    return np.diff(at_b), np.round(found * GRID) / GRID


def measure(documents: DataFrame, path_a: str, path_b: str, text: str = "text", language: str | None = None) -> DataFrame:
    """`documents` with `COUNTS`, `MEASURES`, `script`, `size_class` and `base_failed`, without a shuffle."""
    importable(documents.sparkSession)
    results = [*COUNTS, *MEASURES, "script", "size_class", "base_failed", "kept"]
    if {text.lower(), (language or text).lower()} & set(results):
        raise ValueError("the text or language column has the name of a result column")
    kept = [c for c in documents.columns if c.lower() not in results]
    fields = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(m, T.DoubleType()) for m in MEASURES]
    fields += [T.StructField("script", T.StringType()), T.StructField("size_class", T.IntegerType())]
    source = documents.select(*kept)
    carried = [c for c in kept if c != text]
    schema = T.StructType([source.schema[c] for c in carried] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        tokens = both(path_a, path_b)
        encoded = Encoded(tokens)
        for batch in batches:
            for s, e in slices(pa.compute.utf8_length(batch.column(text)).fill_null(0).to_pylist()):
                part = batch.slice(s, e - s)
                texts = [t or "" for t in part.column(text).to_pylist()]
                counts = list(zip(*map(base_counts, texts)))
                sizes, found = token_measures(tokens, texts, _encoded(encoded, texts))
                classes = np.where(sizes > 0, np.floor(np.log2(np.maximum(sizes, 1))), -1).astype(np.int32)
                columns = [part.column(c) for c in carried]
                columns += [pa.array(c, pa.int64()) for c in counts] + [pa.array(np.ascontiguousarray(found[:, i])) for i in range(len(MEASURES))]
                columns += [pa.array([script_of(t) for t in texts]), pa.array(classes)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < LEAST_WORDS) | (100 * repeated > REPEAT_PERCENT * words)
    return source.mapInArrow(run, schema).withColumn("base_failed", failed)


def _encoded(encoded: Encoded, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """As `Encoded.of`, with no tokens for empty texts."""
    filled = [i for i, t in enumerate(texts) if t]
    found = encoded.of([texts[i] for i in filled])
    sizes = np.zeros((2, len(texts)), np.int64)
    for side, (_, at) in enumerate(found):
        sizes[side, filled] = np.diff(at)
    return [(ids, np.r_[0, np.cumsum(n)]) for (ids, _), n in zip(found, sizes)]


def bands(measured: DataFrame, language: str | None = None) -> DataFrame:
    """A written table (language, script, size_class, members, and low and high of every measure); a null language is ''.

    Rows of all size classes have the class null, rows of all languages the language null.
    """
    spoken = F.coalesce(F.col(language).cast("string"), F.lit("")) if language else F.lit("")
    once = measured.where("not base_failed").select(spoken.alias("language"), "script", "size_class", *MEASURES).distinct()
    long = once.select("language", "script", "size_class", F.posexplode(F.array(*MEASURES)).alias("measure", "value"))
    levels = F.array(
        F.struct("language", "script", "size_class"), F.struct("language", "script", F.lit(None).cast("int").alias("size_class")),
        F.struct(F.lit(None).cast("string").alias("language"), "script", F.lit(None).cast("int").alias("size_class")))
    counted = long.groupBy("language", "script", "size_class", "measure", "value").agg(F.count("*").alias("n"))
    counted = counted.select(F.explode(levels).alias("of"), "measure", "value", "n").groupBy("of", "measure", "value").agg(F.sum("n").alias("n"))
    # a measure on the grid has a bounded number of values, so one group's values are a bounded number of rows
    ends = counted.groupBy("of", "measure").agg(F.sum("n").alias("members"), F.percentile("value", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"))
    least = F.element_at(F.array(*[F.lit(LEAST_SPREAD[m]) for m in MEASURES]), F.col("measure") + 1)
    reach = REACH * F.greatest(F.col("q")[1] - F.col("q")[0], least)
    ends = ends.where(F.col("members") >= LEAST_MEMBERS).select("of", "members", "measure", (F.col("q")[0] - reach).alias("low"), (F.col("q")[1] + reach).alias("high"))
    by_name = [F.max(F.when(F.col("measure") == i, F.col(end))).alias(f"{end}_{m}") for i, m in enumerate(MEASURES) for end in ("low", "high")]
    return stage(ends.groupBy("of").agg(F.max("members").alias("members"), *by_name).select("of.*", "members", *[f"{e}_{m}" for m in MEASURES for e in ("low", "high")]), "bands")


def keep(documents: DataFrame, path_a: str, path_b: str, text: str = "text", language: str | None = None) -> DataFrame:
    """`documents` without the text, with counts, measures, `base_failed` and `kept`."""
    measured = stage(measure(documents, path_a, path_b, text, language), "measured")
    limits = bands(measured, language)
    spoken = F.coalesce(F.col(language).cast("string"), F.lit("")) if language else F.lit("")
    rows = measured.withColumn("__language", spoken)
    names = [f"{e}_{m}" for m in MEASURES for e in ("low", "high")]
    for level, (where, on) in enumerate((
        ("language is not null and size_class is not null", ["language", "script", "size_class"]),
        ("language is not null and size_class is null", ["language", "script"]), ("language is null", ["script"]),
    )):
        band = limits.where(where).select(*[F.col(c).alias(f"__{level}_{c}") for c in on], F.struct(*names).alias(f"__band{level}"))
        same = [F.col("__language" if c == "language" else c) == F.col(f"__{level}_{c}") for c in on]
        rows = rows.join(band, same, "left").drop(*[f"__{level}_{c}" for c in on])
    rows = rows.withColumn("__band", F.coalesce("__band0", "__band1", "__band2"))
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & F.coalesce(F.col(m).between(F.col(f"__band.low_{m}"), F.col(f"__band.high_{m}")), F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & inside).drop("__language", "__band", "__band0", "__band1", "__band2")
