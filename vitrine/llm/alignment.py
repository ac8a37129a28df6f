"""How two tokenizers cut the same text: exact-text deduplication, one alignment for each distinct text, weighted counts.

The texts are shuffled whole, so that equal ones become one row with a multiplicity. Each distinct text is encoded by both
tokenizers and aligned once, in the task that has it, and written with its links (pairs of an A and a B token that share a group,
with how often they do). The pairs' counts over the corpus are sums of multiplicities. They come back to the texts
in blocks of at most `PAIRS_PER_BLOCK` pairs, each small enough to be broadcast, and the measures go to the documents by the SHA-256 of the text.

A group is what lies between two neighbouring byte offsets where a token of A and a token of B both end.

Defined cases: a null or empty text, and one that the tokens don't spell exactly (such as one that holds B's mark of a space), has
zeros and no groups. Repeated rows are rows like any other and count in the pairs' counts each. Ties for the best count are all best. An empty table gives an empty
one. Long texts are encoded whole, part by part; a group is never written out as pairs of occurrences. Input columns named like a result column, in any letter case,
are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vitrine.llm.rows import importable
from vitrine.llm.units import Both, Encoded, both, ranges, slices
from vitrine.workspace import stage

#: Pairs that are broadcast at a time: about 32 MB.
PAIRS_PER_BLOCK = 1_000_000
#: Bits of a pair in a key that holds the text's number above it.
KEY_BITS = 42
MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
RESULTS = [*MEASURES, "n_best", "count_sum", "groups_sha256"]

_SCHEMA = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("times", T.LongType())]
    + [T.StructField(name, T.LongType()) for name in MEASURES]
    + [T.StructField("groups_sha256", T.StringType()),
       T.StructField("links", T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])))])


#: A group with more links than this is counted by its distinct ids.
LARGE_GROUP = 1 << 12


class Alignment:
    """Groups and links of a run of texts, over the bytes of all of them: their ends are ends of tokens of both."""

    def __init__(self, tokens: Both, texts: list[str], encoded: list[tuple[np.ndarray, np.ndarray]]):
        self.tokens, self.size = tokens, len(texts)
        (a, at_a), (b, at_b) = encoded
        wrong = self._misspelt(texts, a, at_a, b, at_b)
        if wrong.any():
            a, at_a = _without(a, at_a, wrong)
            b, at_b = _without(b, at_b, wrong)
        self.a, self.b, self.at_a, self.at_b = a, b, at_a, at_b
        end_a, end_b = np.cumsum(tokens.length_a[a]), np.cumsum(tokens.length_b[b])
        #: whether a group ends with the token
        self.last_a = np.isin(end_a, end_b, assume_unique=True)
        self.last_b = np.isin(end_b, end_a, assume_unique=True)
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        self.groups_before = np.r_[0, np.cumsum(self.last_a)][at_a]
        self.in_a = np.bincount(self.group_a)
        self.in_b = np.bincount(self.group_b)

    def _misspelt(self, texts, a, at_a, b, at_b) -> np.ndarray:
        t = self.tokens
        whole = [(" " + text).encode("utf-8", "surrogatepass") for text in texts]
        joined = b"".join(whole)
        if b"".join(t.bytes_a[a].tolist()) == joined == b"".join(t.bytes_b[b].tolist()):
            size = np.cumsum([0, *map(len, whole)])
            ends = lambda ids, at, length: np.r_[0, np.cumsum(length[ids])][at]
            if (ends(a, at_a, t.length_a) == size).all() and (ends(b, at_b, t.length_b) == size).all():
                return np.zeros(len(texts), bool)
        return np.array([
            not (b"".join(t.bytes_a[a[at_a[i] : at_a[i + 1]]].tolist()) == x == b"".join(t.bytes_b[b[at_b[i] : at_b[i + 1]]].tolist()))
            for i, x in enumerate(whole)
        ])

    def measures(self) -> np.ndarray:
        links = np.r_[0, np.cumsum(self.in_a * self.in_b)]
        return np.column_stack([np.diff(self.at_a), np.diff(self.at_b), np.diff(self.groups_before), np.diff(links[self.groups_before])])

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups as a1,a2|b1;a3|b2,b3, or '' without tokens."""
        names = self.tokens.names
        shown = np.empty(len(self.a) + len(self.b), object)
        first_b = np.cumsum(self.in_b) - self.in_b
        shown[np.arange(len(self.a)) + first_b[self.group_a]] = names[3 * self.a + np.where(self.last_a, 1, 0)]
        shown[np.arange(len(self.b)) + np.cumsum(self.in_a)[self.group_b]] = names[3 * self.b + np.where(self.last_b, 2, 0)]
        shown, at = shown.tolist(), (self.at_a + self.at_b).tolist()
        return [hashlib.sha256(b"".join(shown[s:e])[:-1]).hexdigest() if e > s else "" for s, e in zip(at, at[1:])]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each text begins, its distinct pairs (a * size of B + b) in order, and how often each is linked."""
        size = self.tokens.size_b
        large = self.in_a * self.in_b > LARGE_GROUP
        text_of_group = np.repeat(np.arange(self.size), np.diff(self.groups_before))
        some = ~large[self.group_a]
        a, group = self.a[some].astype(np.int64), self.group_a[some]
        width = self.in_b[group]
        b = self.b[ranges((np.cumsum(self.in_b) - self.in_b)[group], width)]
        keys = np.repeat((text_of_group[group] << KEY_BITS) + a * size, width) + b
        keys, often = np.unique(keys, return_counts=True)
        more = [self._large(g, int(text_of_group[g])) for g in np.flatnonzero(large)]
        if more:
            keys, where = np.unique(np.concatenate([keys, *(k for k, _ in more)]), return_inverse=True)
            often = np.concatenate([often, *(n for _, n in more)])
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, where, often)
            often = total
        starts = np.searchsorted(keys, np.arange(self.size + 1) << KEY_BITS)
        return starts, keys & ((1 << KEY_BITS) - 1), often

    def _large(self, group: int, text: int) -> tuple[np.ndarray, np.ndarray]:
        a, n = np.unique(self.a[self.group_a == group].astype(np.int64), return_counts=True)
        b, m = np.unique(self.b[self.group_b == group], return_counts=True)
        keys = (text << KEY_BITS) + a[:, None] * self.tokens.size_b + b[None, :]
        return keys.ravel(), (n[:, None] * m[None, :]).ravel()

    def groups(self, text: int) -> list[tuple[list[int], list[int]]]:
        """The groups of one text."""
        first, last = self.groups_before[text], self.groups_before[text + 1]
        ends = lambda n: np.r_[0, np.cumsum(n)].tolist()
        at_a, at_b = ends(self.in_a), ends(self.in_b)
        return [(self.a[at_a[g] : at_a[g + 1]].tolist(), self.b[at_b[g] : at_b[g + 1]].tolist()) for g in range(first, last)]


def _without(ids: np.ndarray, at: np.ndarray, wrong: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(at)
    return ids[np.repeat(~wrong, sizes)], np.r_[0, np.cumsum(np.where(wrong, 0, sizes))]


def align_distinct(documents: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """A written table with one row for each distinct, non-empty text: `key` (SHA-256 of the text), `times`, the measures and `links`."""
    importable(documents.sparkSession)
    distinct = documents.select(F.col(text).alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("times"))
    arrow = to_arrow_schema(_SCHEMA)
    link = pa.struct([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches):
        tokens = both(path_a, path_b)
        encoded = Encoded(tokens)
        for batch in batches:
            for s, e in slices(pa.compute.utf8_length(batch.column("text")).to_pylist()):
                texts = batch.column("text").slice(s, e - s).to_pylist()
                found = Alignment(tokens, texts, encoded.of(texts))
                measures, digests, (starts, pairs, often) = found.measures(), found.digests(), found.links()
                keys = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
                links = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays([pa.array(pairs), pa.array(often)], fields=list(link)))
                columns = [pa.array(keys, pa.binary()), batch.column("times").slice(s, e - s), *(pa.array(measures[:, i]) for i in range(4)), pa.array(digests)]
                yield pa.RecordBatch.from_arrays([*columns, links.cast(arrow.field("links").type)], schema=arrow)

    return stage(distinct.mapInArrow(run, _SCHEMA), "aligned")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """A written table (pair, a, b, n, best): how many documents hold a pair linked, and whether no other pair of its A id is in more."""
    counts = aligned.select("times", F.inline("links")).groupBy("pair").agg(F.sum("times").alias("n"))
    counts = stage(counts.withColumn("a", F.floor(F.col("pair") / size_b)).withColumn("b", F.col("pair") % size_b), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return stage(counts.join(most, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _linked(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, n_best, count_sum) of the texts with links, one block of pairs after the other."""
    blocks = counts.count() // PAIRS_PER_BLOCK + 1
    links, found = aligned.select("key", F.inline("links").alias("pair", "often")), None
    for i in range(blocks):
        block = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == i).select("pair", "n", "best")
        some = links.join(F.broadcast(block), "pair")  # about PAIRS_PER_BLOCK rows
        found = some if found is None else found.unionByName(some)
    best = F.sum(F.when(F.col("best"), F.col("often")).otherwise(0))
    return found.groupBy("key").agg(best.alias("n_best"), F.sum(F.col("often") * F.col("n")).alias("count_sum"))


def align_tokens(documents: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """`documents` with the measures of the alignment of their texts (`RESULTS`)."""
    aligned = align_distinct(documents, path_a, path_b, text)
    counts = pair_counts(aligned, both(path_a, path_b).size_b)
    found = aligned.drop("links", "times").join(_linked(aligned, counts), "key", "left")
    found = stage(found.withColumnsRenamed({c: f"__{c}" for c in found.columns}), "measures")
    taken = {name.lower() for name in RESULTS}
    if text.lower() in taken:
        raise ValueError(f"the text column {text} has the name of a result column")
    kept = [c for c in documents.columns if c.lower() not in taken]
    keyed = documents.select(*kept, F.when(F.col(text) != "", F.unhex(F.sha2(text, 256))).alias("__of"))
    joined = keyed.join(found, keyed["__of"] == found["__key"], "left")
    values = [F.coalesce(f"__{name}", F.lit("" if name == "groups_sha256" else 0)).alias(name) for name in RESULTS]
    return joined.select(*kept, *values)
