"""Benchmark decontamination by multi-pattern search over words.

Windows of a fixed number of consecutive benchmark words are the patterns. They are searched in the manner of
Wu and Manber, with words as the alphabet: a table of word blocks tells how far the search may jump, the
block that ends a pattern selects a bucket of patterns, and the patterns of the bucket are compared word by word.
Patterns of one length share a table, so that short items do not shorten the jumps of the others.

The patterns are the only thing broadcast. They go out in blocks of at most about `PATTERNS_PER_BLOCK` patterns,
chosen by hash; a larger benchmark takes more than one pass over the documents, each written before the next.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm import rows
from vitrine.workspace import stage

WINDOW = 10
BLOCK = 3
PATTERNS_PER_BLOCK = 200_000

#: Bytes that belong to words stay (lower-cased), all others become blanks.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words: digits, letters and everything outside ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], window: int = WINDOW) -> Iterable[tuple[bytes, ...]]:
    if 0 < len(words) <= window:
        yield tuple(words)
    else:
        for i in range(len(words) - window + 1):
            yield tuple(words[i : i + window])


class WordSearch:
    """Search tables for patterns of one length in words."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]], block: int = BLOCK):
        self.length, self.block = length, min(block, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            # the first words of the pattern narrow the bucket before the comparison
            self.buckets[pattern[-self.block :]][pattern[: self.block]].append((pattern, items))

    def find(self, words: list[bytes]) -> Iterable[tuple[int, list[str]]]:
        """(start, items) of every occurrence, overlapping ones included."""
        length, block, shift, default = self.length, self.block, self.shift, self.default
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block : end])
            jump = shift.get(key, default)
            if jump:
                end += jump
                continue
            start = end - length
            for pattern, items in self.buckets[key].get(tuple(words[start : start + block]), ()):
                if tuple(words[start:end]) == pattern:
                    yield start, items
            end += 1


def _searches(patterns: list[tuple[list[bytes], list[str]]]) -> list[WordSearch]:
    by_length: dict[int, dict] = defaultdict(dict)
    for words, items in patterns:
        by_length[len(words)][tuple(words)] = items
    return [WordSearch(n, found) for n, found in sorted(by_length.items())]


def pattern_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each distinct window: its words joined by blanks, and the sorted ids (as text) of the items that hold it."""
    rows.importable(benchmark.sparkSession)
    import pyarrow as pa

    def explode(batches):
        for batch in batches:
            ids, found = [], []
            for item, value in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                for words in set(windows_of(words_of(value), window)):
                    ids.append(item)
                    found.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary())], ["id", "window"])

    source = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    return (
        source.where("id is not null")
        .mapInArrow(explode, "id string, window binary")
        .groupBy("window")
        .agg(F.array_sort(F.collect_set("id")).alias("items"))
    )


def _scan(found: DataFrame, text: str, patterns: list) -> DataFrame:
    """Add what one block of patterns finds to the columns __hits (packed word spans) and __items."""
    import pyarrow as pa

    shared = found.sparkSession.sparkContext.broadcast(patterns)
    built: list = []  # in each worker, for the tasks of one stage

    def process(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not built:
            built.append(_searches(shared.value))
        n_words, hits, items = [], [], []
        old_hits, old_items = batch.column("__hits").to_pylist(), batch.column("__items").to_pylist()
        for value, spans, seen in zip(batch.column(text).to_pylist(), old_hits, old_items):
            words = words_of(value)
            spans, seen = [tuple(s.values()) for s in spans], set(seen)
            for search in built[0]:
                for start, ids in search.find(words):
                    spans.append((start, start + search.length))
                    seen.update(ids)
            n_words.append(len(words))
            hits.append([{"start": a, "end": b} for a, b in merged(spans)])
            items.append(sorted(seen))
        for name, values in (("__words", n_words), ("__hits", hits), ("__items", items)):
            at = batch.schema.get_field_index(name)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(values, type=batch.schema.field(at).type))
        return batch

    return found.mapInArrow(lambda batches: map(process, batches), found.schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`documents` with `n_words`, `n_hit`, `hit_spans` (merged word spans, end exclusive), `items` (ids as text, sorted as
    text) and `contaminated`.

    Null or empty text has no words and no hits. Every input row gives one row, repeated rows included. Items without words or
    without id are no patterns; equal items are all named. An empty benchmark marks nothing. Input columns with the name of
    a result column are replaced.
    """
    spark = documents.sparkSession
    rows.importable(spark)
    results = ("n_words", "n_hit", "hit_spans", "items", "contaminated", "__words", "__hits", "__items")
    table = stage(pattern_table(benchmark, item_id, item_text, window), "patterns")
    blocks = max(1, -(-table.count() // PATTERNS_PER_BLOCK))
    found = documents.drop(*results).withColumns({
        "__words": F.lit(0).cast("long"),
        "__hits": F.lit([]).cast("array<struct<start:long,end:long>>"),
        "__items": F.lit([]).cast("array<string>"),
    })
    found = found.select(*[F.when(F.lit(True), F.col(c)).alias(c) if c.startswith("__") else F.col(c) for c in found.columns])
    for block in range(blocks):
        part = table.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block).collect()  # about PATTERNS_PER_BLOCK rows at most
        patterns = [(bytes(r["window"]).split(b" "), r["items"]) for r in part]
        found = _scan(found if block == 0 else stage(found, "contamination"), text, patterns)
    size = F.expr("aggregate(__hits, 0L, (n, s) -> n + s.end - s.start)")
    return found.withColumns({
        "n_words": F.col("__words"), "n_hit": size, "hit_spans": F.col("__hits"), "items": F.col("__items"),
        "contaminated": size > 0,
    }).drop("__words", "__hits", "__items")


def clean_documents(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a benchmark window, columns as they are."""
    marked = find_contamination(documents.select(F.struct("*").alias("__row"), F.col(text).alias("__text")), benchmark, "__text")
    return marked.where("not contaminated").select("__row.*")


def digest(items: T.ArrayType | str) -> F.Column:
    """SHA-256 of the ids joined by commas."""
    return F.sha2(F.concat_ws(",", items), 256)
