"""Exact top-k search by inner product: postings of each block of candidates, term at a time.

A block of candidate vectors is turned round into postings: for each component, the rows that have a value there and the
values. Each query then scatters its weighted postings, component by component, into one dense array of scores
for the block, from which the k best are taken by partition selection. The best of all blocks are merged by rank.

The queries are broadcast in blocks of at most `QUERIES_PER_BLOCK` rows, one pass over the candidates for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm import rows

SCALE = 256
TOP = 5
QUERIES_PER_BLOCK = 4096
#: Candidates whose postings are held at a time.
CANDIDATES_PER_BLOCK = 8192
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v): integer vectors floor(scale * x); rows with a null id, a null vector or a null or non-finite component are left out.
    A component beyond the range of a long becomes the nearest long."""
    usable = f"v is not null and id is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    return (
        vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .where(usable)
        .select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
    )


class Postings:
    """For each component, the rows of a block that have a value there, and the values."""

    def __init__(self, vectors: list[np.ndarray]):
        self.rows = len(vectors)
        lengths = np.array([len(v) for v in vectors], dtype=np.int64)
        values = np.concatenate(vectors) if vectors else np.empty(0, np.int64)
        row = np.repeat(np.arange(self.rows), lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if self.rows else np.empty(0, np.int64)
        component = np.arange(len(values)) - np.repeat(starts, lengths)
        there = values != 0
        row, component, values = row[there], component[there], values[there]
        order = np.argsort(component, kind="stable")
        row, component, values = row[order], component[order], values[order]
        names, first = np.unique(component, return_index=True)
        ends = np.append(first[1:], len(component))
        self.postings = {int(c): (row[a:b], values[a:b]) for c, a, b in zip(names, first, ends)}
        self.largest = int(np.abs(values.astype(np.float64)).max()) if len(values) else 0

    def scores(self, query: np.ndarray) -> np.ndarray:
        terms = np.flatnonzero(query)
        bound = self.largest * sum(abs(int(query[c])) for c in terms)
        exact = object if bound > MOST else np.int64  # whole numbers of any size where a long could overflow
        out = np.zeros(self.rows, dtype=exact)
        for c in terms:
            if int(c) in self.postings:
                row, values = self.postings[int(c)]
                out[row] += values.astype(exact) * (int(query[c]) if exact is object else query[c])
        return np.clip(out, LEAST, MOST).astype(np.int64) if exact is object else out


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score first, smaller id first among equals."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        equal = np.flatnonzero(scores == least)
        equal = equal[np.argsort(ids[equal], kind="stable")[: k - len(above)]]
        chosen = np.concatenate([above, equal])
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen].astype(object) if len(scores) and scores.min() == LEAST else -scores[chosen]))]


def _search(candidates: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    shared = candidates.sparkSession.sparkContext.broadcast(queries)

    def answers(ids: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
        postings, own = Postings(vectors), np.array(ids, dtype=np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for query_id, query in shared.value:
            scores = postings.scores(query)
            others = own != query_id
            keep_ids, keep_scores = (own, scores) if others.all() else (own[others], scores[others])
            top = best(keep_ids, keep_scores, k)
            out.append((np.full(len(top), query_id), keep_ids[top], keep_scores[top]))
        columns = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else ([], [], []))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    def run(batches):
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            lists = batch.column("v")
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            ids += batch.column("id").to_pylist()
            vectors += [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            while len(ids) >= CANDIDATES_PER_BLOCK:
                yield answers(ids[:CANDIDATES_PER_BLOCK], vectors[:CANDIDATES_PER_BLOCK])
                ids, vectors = ids[CANDIDATES_PER_BLOCK:], vectors[CANDIDATES_PER_BLOCK:]
        if ids:
            yield answers(ids, vectors)

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = TOP,
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest integer inner products, ties to the smaller id.

    A candidate with the query's own id is not its answer. A repeated query row is answered once (of different
    vectors with one id the smallest, compared component by component); repeated candidate rows are candidates of their
    own and appear as often as they are there. Vectors of different lengths are compared over the shorter one. Scores beyond a long are cut to it.
    Rows that are null or not finite take no part; without queries or candidates the result is empty. Other columns are not read.
    """
    spark = candidates.sparkSession
    rows.importable(spark)
    searched = quantised(candidates, id_column, vector, scale)
    asked = quantised(queries, id_column, vector, scale).groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    found = None
    for i in range(blocks):
        part = [(r["id"], np.array(r["v"], dtype=np.int64)) for r in asked.where(block == i).collect()]  # about QUERIES_PER_BLOCK rows
        more = _search(searched, sorted(part, key=lambda q: q[0]), k)
        found = more if found is None else found.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
